"""Benchmark decontamination: prefix-filtered set join (operator 1), native.

An item's windows (``window`` consecutive words, or the whole item when it is
shorter) are sets of word shingles; a document holds a window only if it holds
all of them.  For full containment the prefix a join must look at is one
shingle, so each window picks its rarest by the counts over the whole corpus,
and only those prefix shingles are looked up in documents.  A match fixes the
alignment of document and item, hence the positional bound: the words around
the two positions are compared outwards, and a common run of the window's
length or more proves containment word for word (the length bound drops
shorter ones).  Hashes only nominate; the verdict is on the words.

Spark: two scans of the documents, DataFrame functions only.  The first counts
the items' shingles (aggregated map-side), the second explodes only positions
holding a prefix shingle, each with a fixed number of words around it, so no
row carries a whole text.  Prefix shingles are pushed into the scan's lambda as
a literal set and broadcast while there are at most ``push_limit`` of them;
beyond that the same join shuffles by shingle.  A shingle in a third of all
rows is counted map-side and, being frequent, is nobody's prefix unless a
window has nothing rarer.

Defined results: null and empty texts have no words and are clean; items
without words have no windows; repeated document rows come out as often as they
went in; repeated items count once by ``item_id``; null item ids are left out; of equally
rare shingles the first stands for its window, which changes no result; an empty table of
documents gives no rows, one of items leaves all clean; texts of any length are one row's
arrays; columns other than those named are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the contract.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only; the quick built-in serves where it does the same."""
    other = r"[[\p{IsUppercase}\p{IsTitlecase}]&&[^\x00-\x7F]]"
    return F.when(text.rlike(other), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def shingles(words: Column, size: int) -> Column:
    """Hash of the ``size`` words at every position that has them."""
    n = F.size(words) - (size - 1)
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(
        *[F.get(words, i + k) for k in range(size)]))).otherwise(F.array().cast("array<bigint>"))


def around(words: Column, i: Column, window: int) -> tuple[Column, Column]:
    """Words left of position ``i``, nearest first, and from ``i`` rightwards."""
    left = F.reverse(F.slice(words, F.greatest(i - (window - 1), F.lit(0)) + 1,
                             F.least(i, F.lit(window - 1))))
    return left, F.slice(words, i + 1, F.lit(window))


def common(a: Column, b: Column) -> Column:
    """Number of leading equal elements."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    stop = F.array_position(same, False)
    return F.when(stop > 0, stop - 1).otherwise(F.size(same)).cast("int")


def item_windows(items: DataFrame, item_id: str, text: str, window: int, size: int) -> DataFrame:
    """(item_id, words, need, start, at, size, token): every window's shingles."""
    w = F.col("words")
    rows = (items.where(F.col(item_id).isNotNull())
            .select(F.col(item_id).cast("string").alias("item_id"), words_of(F.col(text)).alias("words"))
            .where(F.size(w) > 0)
            .withColumn("need", F.least(F.size(w), F.lit(window)))
            .withColumn("size", F.least(F.size(w), F.lit(size))))
    tokens = F.when(F.col("size") == size, shingles(w, size))
    for k in range(1, size):
        tokens = tokens.when(F.col("size") == k, shingles(w, k))
    rows = rows.withColumn("token", tokens).withColumn(
        "start", F.explode(F.sequence(F.lit(0), F.size(w) - F.col("need"))))
    inside = F.slice(F.col("token"), F.col("start") + 1, F.col("need") - F.col("size") + 1)
    return rows.select("item_id", "words", "need", "start", "size",
                       F.posexplode(inside).alias("k", "token")).withColumn("at", F.col("start") + F.col("k"))


def positions(words: Column, size: int, wanted: list[int] | None) -> Column:
    """(size, pos, token) of the shingles of a text, those in ``wanted`` if given."""
    every = F.transform(shingles(words, size), lambda t, i: F.struct(
        F.lit(size).alias("size"), i.alias("pos"), t.alias("token")))
    return every if wanted is None else F.filter(every, lambda x: x["token"].isin(wanted))


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = 10,
                  shingle: int = 3, push_limit: int = 50_000) -> DataFrame:
    """One row per document row with its contaminated words.

    Columns: ``doc_id``, ``n_words``, ``n_hit`` (long), ``hit_spans`` (merged
    word spans, end exclusive), ``item_ids`` (sorted strings), ``contaminated``.
    """
    from ledgerlake.session import scratch_root

    scratch_root(docs.sparkSession)
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    wins = item_windows(items, item_id, item_text, window, shingle).checkpoint()
    few = wins.select("size", "token").distinct().limit(push_limit + 1).collect()
    pushed = len(few) <= push_limit

    def probe(rows):
        """Per document the (size, pos, token) array worth exploding."""
        if pushed:
            by_size = {k: [r.token for r in rows if r["size"] == k] for k in range(1, shingle + 1)}
        else:
            by_size = dict.fromkeys(range(1, shingle + 1))
        parts = [positions(F.col("words"), k, own) for k, own in by_size.items() if own != []]
        return F.concat(*parts) if parts else F.array().cast("array<struct<size:int,pos:int,token:bigint>>")

    worded = own.withColumn("words", words_of(F.col("text")))
    seen = (worded.select(F.explode(probe(few)).alias("p")).select("p.size", "p.token")
            .groupBy("size", "token").agg(F.count(F.lit(1)).alias("df")))
    small = (lambda df: F.broadcast(df)) if pushed else (lambda df: df)
    if not pushed:
        seen = seen.join(wins.select("size", "token").distinct(), ["size", "token"])
    ranked = (wins.join(small(seen), ["size", "token"], "left")
              .withColumn("df", F.coalesce("df", F.lit(0))))
    # Each window's rarest shingle; windows sharing one share the comparison.
    prefix = (ranked.groupBy("item_id", "words", "need", "size", "start")
              .agg(F.min(F.struct("df", "token", "at")).alias("best"))
              .select("item_id", "words", "need", "size", F.col("best.token").alias("token"),
                      F.col("best.at").alias("at")).distinct())
    left, right = around(F.col("words"), F.col("at"), window)
    prefix = prefix.select("item_id", "need", F.col("size").alias("p_size"), F.col("token").alias("p_token"),
                           left.alias("p_left"), right.alias("p_right")).checkpoint()
    keys = {(r["size"], r.token): r for r in prefix.select(
        F.col("p_size").alias("size"), F.col("p_token").alias("token")).collect()}.values() if pushed else []

    def with_words(x):
        a, b = around(F.col("words"), x["pos"], window)
        return F.struct(x["size"].alias("size"), x["pos"].alias("pos"), x["token"].alias("token"),
                        a.alias("left"), b.alias("right"))

    # One row says that the document is there; its token is its own hash, so
    # these rows spread in a shuffle, and the join condition keeps them apart.
    there = F.struct(F.lit(0).alias("size"), F.lit(-1).alias("pos"),
                     F.xxhash64("doc_id", "text").alias("token"),
                     F.lit(None).cast("array<string>").alias("left"),
                     F.lit(None).cast("array<string>").alias("right"))
    cand = (worded.withColumn("found", probe(keys))
            .select("doc_id", F.xxhash64("text").alias("text_key"), F.size("words").alias("n_words"),
                    F.explode(F.concat(F.array(there), F.transform("found", with_words))).alias("c"))
            .select("doc_id", "text_key", "n_words", "c.*"))
    met = cand.join(small(prefix), (F.col("pos") >= 0) & (F.col("size") == F.col("p_size"))
                    & (F.col("token") == F.col("p_token")), "left")
    met = (met.withColumn("before", common(F.col("left"), F.col("p_left")))
           .withColumn("after", common(F.col("right"), F.col("p_right")))
           .withColumn("hit", F.col("before") + F.col("after") >= F.col("need"))
           .where((F.col("pos") < 0) | F.col("hit")))
    span = F.when(F.col("hit"), F.struct((F.col("pos") - F.col("before")).alias("a"),
                                         (F.col("pos") + F.col("after")).alias("b")))
    per_doc = met.groupBy("doc_id", "text_key").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.count(F.when(F.col("pos") < 0, 1)).cast("int").alias("copies"),
        F.array_sort(F.collect_set(span)).alias("spans"),
        F.array_sort(F.collect_set(F.when(F.col("hit"), F.col("item_id")))).alias("item_ids"))
    # Spans sorted by start: a span adds what lies beyond the furthest end so far.
    merged = F.aggregate("spans", F.array().cast("array<struct<a:int,b:int>>"), lambda acc, s: F.when(
        (F.size(acc) > 0) & (s["a"] <= F.element_at(acc, -1)["b"]),
        F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(
            F.element_at(acc, -1)["a"].alias("a"),
            F.greatest(F.element_at(acc, -1)["b"], s["b"]).alias("b")))))
        .otherwise(F.concat(acc, F.array(s))))
    per_doc = per_doc.withColumn("hit_spans", F.when(F.size("spans") > 0, merged).otherwise(
        F.array().cast("array<struct<a:int,b:int>>")))
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s["b"] - s["a"])
    return (per_doc.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select("doc_id", "n_words", n_hit.alias("n_hit"), "hit_spans", "item_ids",
                    (F.size("hit_spans") > 0).alias("contaminated")))
