"""N-gram Jaccard join in metric space (operator 2).

Documents are sets of word shingles under Jaccard distance ``d``, a metric.
Two documents link when their similarity is ``threshold`` or more, that is when
``d <= r`` with ``r = 1 - threshold``.

In this space unrelated documents all lie at distance 1, where no pivot tells
them apart, so regions start where distances can be below 1: a document belongs
to the region of each of its rarest shingles that a link could need (for a set
of ``n`` any ``n - ceil(threshold * n) + 1`` shingles meet every possible
partner).  Inside a region:

* a few documents of its smallest components are pivots; their distances to the
  members are found and links within ``r`` recorded;
* members split by the nearest pivot into those within ``r`` of it and those
  beyond ``2 r``; by the triangle inequality no link joins the two, so the
  region becomes two, and the boundary documents between ``r`` and ``2 r``
  are replicated into both;
* a pivot has met everybody and leaves; documents already in one component
  need no comparison, so a region of one component is finished.

Those rounds run on cells, where each document stands once, in the largest of
its regions.  In a few turns more, each document, in one of its regions, is linked with
its nearest of another component.  Then all regions are settled: one component is
finished, up to ``leaf`` documents are joined directly, larger ones block by block.

The join is exact: a pair in a region ends compared or known to be connected;
the triangle inequality only saves the cells comparisons.  A distance is first bounded
from lengths and from parity bitmaps, one bit a shingle for single pairs, eight
for block joins (``|x ^ y|`` is at least the number of differing parity bits); pairs that the bound does not settle are counted on
their sets.

Spark: exact copies collapse into one class first (same set, hence same key).
Texts are read twice: once to find frequent shingles, once to write sets,
bitmaps and region shingles.  Frequency only orders shingles, so a bounded list
of the frequent ones (``frequent_limit``) is enough and any list gives the same
links.  Region membership is a grouped minimum and maximum plus a join, both
splittable, so a shingle in a third of all documents never has to fit a task;
pairs of a round are (member, pivot), linear in the region, and the block joins
give out only pairs that the bitmaps leave open.  Tables of a round are
written to the shared folder; links and components stay distributed.

Hashes: shingles are compared by 64-bit hashes cut to 48 bits in stored sets,
classes by a 64-bit hash of the set.

Defined results: null text and text without a word have an empty set and link
with nothing (``component_id`` is their own ``doc_id``); fewer words than a
shingle make one shingle of the whole sequence; a null ``doc_id`` takes part
but never names a component unless nothing else is in it; repeated rows share a
component and come out as often as they went in; the least id names a component, so
there are no ties; an empty table gives no rows; texts of any length are one row; columns
other than the two named are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.components import components
from ledgerlake.llm.tables import Tables
from ledgerlake.llm.textblocks import LOWER, blocks, mix, span_hashes, text_bytes, word_spans

COUNT_BLOCK = 2_000_000          # shingles counted together when looking for frequent ones
_MULT = np.uint64(0x9E3779B97F4A7C15)
PIVOTS = 8


def shingle_sets(raw: np.ndarray, off: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, lower-cased A-Z."""
    raw = LOWER[raw]
    starts, ends = word_spans(raw, off)
    words = span_hashes(raw, starts, ends)
    first = np.searchsorted(starts, off)             # first word of each row
    h = np.zeros(max(len(words) - size + 1, 0), np.uint64)
    for k in range(size):
        h = h * _MULT + words[k:len(words) - size + 1 + k]
    h = mix(h + np.uint64(size)) if len(h) else h
    for i in range(len(off) - 1):
        a, b = first[i], first[i + 1]
        if b - a >= size:
            yield np.unique(h[a:b - size + 1])
        elif b > a:
            one = np.zeros(1, np.uint64)
            for w in words[a:b]:
                one = one * _MULT + w
            yield mix(one + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def frequent_shingles(docs: DataFrame, size: int, limit: int, tables: Tables) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles (48 bits, sorted) and their counts, ``limit`` at most.

    A shingle counts in a block of ``COUNT_BLOCK`` when two of its documents
    have it; what is rarer than once per block may be missed and is then
    ordered among the rare ones.  The least count kept is the lowest that
    ``limit`` shingles or fewer reach, which bounds the list whatever the input.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def counted():
            t, c = np.unique(np.concatenate(held), return_counts=True)
            more = c > 1
            return pa.RecordBatch.from_arrays(
                [pa.array(t[more].astype(np.int64)), pa.array(c[more].astype(np.int64))], names=["t", "c"])

        for b in blocks(batches, "text"):
            for s in shingle_sets(*text_bytes(b.column("text")), size):
                held.append(s >> np.uint64(16))
                n += len(s)
                if n >= COUNT_BLOCK:
                    yield counted()
                    held, n = [], 0
        if n:
            yield counted()

    counts = tables.settle(docs.select("text").mapInArrow(run, "t long, c long")
                           .groupBy("t").agg(F.sum("c").alias("c")))
    # Counts of a power of two and more, so the list of these sums has 64 rows at most.
    steps = dict(counts.groupBy(F.floor(F.log2("c")).cast("int").alias("step")).count().collect())
    least, held = max(steps, default=0) + 1, 0
    while least > 1 and held + steps.get(least - 1, 0) <= limit:
        least, held = least - 1, held + steps.get(least - 1, 0)
    rows = counts.where(F.floor(F.log2("c")) >= least).select("t", "c").toArrow()
    t, c = rows.column(0).to_numpy(), rows.column(1).to_numpy()
    tables.drop(counts)
    order = np.argsort(t)
    return t[order].astype(np.uint64), c[order].astype(np.int64)


def parity_bitmap(tokens: np.ndarray, each: int) -> bytes:
    """Parities of the tokens by low bits; ``each`` or more bits a token, a power of two."""
    bits = max(64, each << max(len(tokens) - 1, 1).bit_length())
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def differing(a: bytes, b: bytes) -> int:
    """A lower bound of the symmetric difference from two parity bitmaps."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def pack48(tokens: np.ndarray) -> bytes:
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack48(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


SETS = ("row long, doc_id {id}, n long, key long, coarse binary, bitmap binary, region array<long>, "
        "tokens binary")


def write_sets(docs: DataFrame, size: int, percent: int, frequent, tables: Tables) -> DataFrame:
    """One row per document: key, length, bitmap, region shingles and set."""
    from pyspark import TaskContext

    shared = docs.sparkSession.sparkContext.broadcast(frequent)  # bounded by frequent_limit
    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    names = [x.strip().split(" ")[0] for x in SETS.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, count = shared.value
        row = TaskContext.get().partitionId() << 36
        for b in blocks(batches, "text"):
            n, key, coarse, bitmap, region, tokens = [], [], [], [], [], []
            for s in shingle_sets(*text_bytes(b.column("text")), size):
                t = s >> np.uint64(16)
                n.append(len(t))
                if not len(t):
                    key.append(None), region.append(None)
                    for empty in (coarse, bitmap, tokens):
                        empty.append(b"")
                    continue
                key.append(int((mix(s).sum() ^ mix(np.uint64([len(s)]))[0]).view(np.int64)))
                coarse.append(parity_bitmap(t, 1))
                bitmap.append(parity_bitmap(t, 8))
                tokens.append(pack48(t))
                least = len(t) - (percent * len(t) + 99) // 100 + 1
                rank = np.zeros(len(t), np.int64)
                if len(often):
                    at = np.minimum(np.searchsorted(often, t), len(often) - 1)
                    rank = np.where(often[at] == t, count[at], 0)
                region.append(t[np.lexsort((t, rank))[:least]].astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + len(n))), b.column("doc_id"), pa.array(n, pa.int64()),
                 pa.array(key, pa.int64()), pa.array(coarse, pa.binary()), pa.array(bitmap, pa.binary()),
                 pa.array(region, pa.list_(pa.int64())), pa.array(tokens, pa.binary())], names=names)
            row += len(n)

    made = tables.settle(docs.mapInArrow(run, SETS.format(id=kind)))
    shared.destroy()
    return made


class Distances:
    """Bounds and exact overlaps of class pairs, from the written sets."""

    def __init__(self, sets: DataFrame, classes: DataFrame, percent: int, small: int, tables: Tables):
        self.sets, self.classes, self.percent, self.small = sets, classes, percent, small
        self.tables = tables

    def of(self, keys: DataFrame, *columns: str) -> DataFrame:
        """(key, *columns) of the classes in ``keys``.

        The rows needed are found by key, then fetched by row number, so
        copies of a class are never read for it.
        """
        found = self.tables.settle(keys.distinct().join(self.classes.select("key", "row"), "key"))
        few = found.count() <= self.small
        side = F.broadcast(found) if few else found  # measured: 16 bytes a row
        return self.sets.select("row", *columns).join(side, "row").select("key", *columns)

    def _both(self, pairs: DataFrame, column: str) -> DataFrame:
        """``pairs`` (a, b, ...) with ``column`` of both classes."""
        got = self.of(pairs.select(F.col("a").alias("key")).union(pairs.select("b")), column)
        return (pairs.join(got.select(F.col("key").alias("a"), F.col(column).alias("x")), "a")
                .join(got.select(F.col("key").alias("b"), F.col(column).alias("y")), "b"))

    def bounded(self, pairs: DataFrame) -> DataFrame:
        """Distinct (a, b) with ``may`` (a link is possible) and ``far`` (beyond 2 r)."""
        c = self.classes
        p = self.percent
        pairs = (pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
                 .join(c.select(F.col("key").alias("a"), F.col("n").alias("na")), "a")
                 .join(c.select(F.col("key").alias("b"), F.col("n").alias("nb")), "b"))
        small, large = F.least("na", "nb"), F.greatest("na", "nb")
        told = self.tables.settle(pairs.withColumn("short", 100 * small < p * large).withColumn(
            "wide", 100 * small < (2 * p - 100) * large))
        todo = told.where(~F.col("short")).select("a", "b", "na", "nb")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for t in batches:
                may, far = [], []
                for na, nb, x, y in zip(*(t.column(k).to_pylist() for k in range(2, 6))):
                    most = (na + nb - differing(x, y)) // 2     # overlap at best
                    may.append(100 * most >= p * (na + nb - most))
                    far.append(100 * most < (2 * p - 100) * (na + nb - most))
                yield pa.RecordBatch.from_arrays(
                    [t.column(0), t.column(1), pa.array(may, pa.bool_()), pa.array(far, pa.bool_())],
                    names=["a", "b", "may", "far"])

        near = self._both(todo, "coarse").select("a", "b", "na", "nb", "x", "y").mapInArrow(
            run, "a long, b long, may boolean, far boolean")
        return self.tables.settle(near.union(told.where("short").select(
            "a", "b", F.lit(False).alias("may"), F.col("wide").alias("far"))))

    def links(self, pairs: DataFrame) -> DataFrame:
        """The (a, b) of ``pairs`` that link, counted on their sets."""
        p = self.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for t in batches:
                ok = []
                for x, y in zip(t.column(2), t.column(3)):
                    x, y = unpack48(x.as_py()), unpack48(y.as_py())
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(100 * both >= p * (len(x) + len(y) - both))
                yield t.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

        return self.tables.settle(self._both(pairs.select("a", "b"), "tokens").select("a", "b", "x", "y")
                                  .mapInArrow(run, "a long, b long"), batch_rows=256)


def initial_regions(sets: DataFrame, tables: Tables, small: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of two-document regions, and (rid, key) of the larger ones.

    Copies of a passage share many shingles, so many regions have the same
    members; one of these is kept, told by two hashes over its members.
    """
    posted = sets.where(F.col("key").isNotNull()).select(F.explode("region").alias("rid"), "key")
    groups = tables.settle(posted.groupBy("rid").agg(
        F.count(F.lit(1)).alias("m"), F.min("key").alias("a"), F.max("key").alias("b")).where("a <> b"))
    pairs = tables.settle(groups.where("m = 2").select("a", "b"))
    larger = groups.where("m > 2").select("rid")
    side = F.broadcast(larger) if larger.count() <= small else larger  # measured: 8 bytes a row
    every = tables.settle(posted.join(side, "rid").distinct())
    alike = every.groupBy("rid").agg(
        F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("key")).alias("h"),
        F.bit_xor(F.xxhash64("key", F.lit(1))).alias("i"))
    kept = tables.settle(alike.groupBy("m", "h", "i").agg(F.min("rid").alias("rid")).select("rid"))
    side = F.broadcast(kept) if kept.count() <= small else kept
    members = tables.settle(every.join(side, "rid"))
    tables.drop(groups, every, kept)
    return pairs, members


def live_members(members: DataFrame, labels: DataFrame, tables: Tables) -> DataFrame:
    """(rid, size, key, label) of the regions with two components or more."""
    m = (members.join(labels, "key", "left")
         .select("rid", "key", F.coalesce("label", "key").alias("label")))
    sizes = (m.groupBy("rid").agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("lo"),
                                  F.max("label").alias("hi"))
             .where("lo <> hi").select("rid", "size"))
    return tables.settle(m.join(sizes, "rid"))


def split_round(members: DataFrame, labels: DataFrame, leaf: int, turn: int, tables: Tables):
    """Live members with labels and region size, and (rid, pivot) of regions over ``leaf``."""
    m = (members.join(labels, "key", "left")
         .select("rid", "key", F.coalesce("label", "key").alias("label")))
    per_label = m.groupBy("rid", "label").agg(
        F.count(F.lit(1)).alias("m"), *[F.min(F.struct(F.xxhash64("key", F.lit(turn * PIVOTS + k)).alias("h"),
                                                       "key")).alias(f"p{k}") for k in range(PIVOTS)])
    stats = tables.settle(per_label.groupBy("rid").agg(
        F.sum("m").alias("size"), F.count(F.lit(1)).alias("labels"),
        *[F.min(F.struct("m", f"p{k}")).alias(f"p{k}") for k in range(PIVOTS)]).where("labels > 1"))
    pivots = (stats.where(F.col("size") > leaf)
              .select("rid", F.explode(F.array_distinct(F.array(
                  *[F.col(f"p{k}.p{k}.key") for k in range(PIVOTS)]))).alias("pivot")))
    return tables.settle(m.join(stats.select("rid", "size"), "rid")), tables.settle(pivots)


def leaf_pairs(members: DataFrame, leaf: int) -> DataFrame:
    """All pairs of different labels of the regions up to ``leaf`` documents."""
    small = members.where(F.col("size") <= leaf)
    return (small.alias("x").join(small.alias("y"), "rid")
            .where("x.key < y.key and x.label <> y.label")
            .select(F.col("x.key").alias("a"), F.col("y.key").alias("b")))


def recurse(members: DataFrame, pivots: DataFrame, bounds: DataFrame, linked: DataFrame,
            tables: Tables) -> DataFrame:
    """The regions after a round: split at the first pivot, pivots gone.

    Pivots have met all members and leave.  A region is split only where that
    pays, that is where the two windows together hold little more than it.
    """
    first = pivots.groupBy("rid").agg(F.min("pivot").alias("pivot"))
    rest = members.join(pivots.select("rid", F.col("pivot").alias("key")), ["rid", "key"], "left_anti")
    met = tables.settle(
        rest.join(first, "rid")
        .select("rid", "key", F.least("key", "pivot").alias("a"), F.greatest("key", "pivot").alias("b"))
        .join(bounds.where("far").select("a", "b", "far"), ["a", "b"], "left")
        .join(linked.select("a", "b", F.lit(True).alias("near")), ["a", "b"], "left")
        .select("rid", "key", "near", "far"))
    pays = (met.groupBy("rid").agg(F.count(F.lit(1)).alias("m"), F.count("near").alias("n"),
                                   F.count("far").alias("f"))
            .select("rid", ((F.col("n") > 0) & (4 * (F.col("m") - F.col("n") - F.col("f")) <= F.col("m")))
                    .alias("pays")))
    sides = (F.when(~F.col("pays"), F.array(F.lit(2))).when(F.col("near"), F.array(F.lit(0)))
             .when(F.col("far"), F.array(F.lit(1))).otherwise(F.array(F.lit(0), F.lit(1))))
    return tables.settle(met.join(pays, "rid").select("rid", "key", F.explode(sides).alias("side"))
                         .select(F.xxhash64("rid", "side").alias("rid"), "key"))


def possible(bitmaps: list[bytes], n: np.ndarray, labels: np.ndarray, blocks: np.ndarray,
             percent: int, closest: bool = False) -> Iterator[tuple[int, np.ndarray]]:
    """(i, js): members of another label (and block, if there are two) that may link with i.

    With ``closest`` only the nearest by the bitmaps: most such pairs link, and
    once they are known to, few others are left to name.

    Bitmaps stand in one matrix for each length, longer ones folded for a
    comparison; one member meets all others in a few vector operations.  The
    members of the most common label only meet the others.
    """
    size = np.array([len(x) for x in bitmaps])
    names, count = np.unique(labels, return_counts=True)
    main = names[count.argmax()]
    two = len(np.unique(blocks)) > 1
    rows = {w: np.flatnonzero(size == w) for w in np.unique(size)}
    full = {w: np.frombuffer(b"".join(bitmaps[i] for i in at), np.uint8).reshape(len(at), w)
            for w, at in rows.items()}
    place = np.empty(len(n), np.int64)
    for at in rows.values():
        place[at] = np.arange(len(at))
    for i in np.flatnonzero(labels != main):
        best, least = None, 2.0
        for w, at in rows.items():
            if w not in (size[i] // 2, size[i], size[i] * 2):
                continue                         # lengths differ too much to link
            x, y = full[size[i]][place[i]], full[w]
            if w < size[i]:
                x = x[:w] ^ x[w:]
            ok = (labels[at] != labels[i]) & (100 * np.minimum(n[at], n[i]) >= percent * np.maximum(n[at], n[i]))
            if not closest:
                ok &= (labels[at] == main) | (at > i)
            if two:
                ok &= blocks[at] != blocks[i]
            at, y = at[ok], y[ok]
            if not len(at):
                continue
            if w > size[i]:
                y = y[:, :size[i]] ^ y[:, size[i]:]
            apart = np.bitwise_count(y ^ x).sum(1, dtype=np.int64)
            most = (n[at] + n[i] - apart) // 2
            fits = 100 * most >= percent * (n[at] + n[i] - most)
            if closest and fits.any():
                gap = np.where(fits, apart / (n[at] + n[i]), 2.0)
                if gap.min() < least:
                    best, least = at[gap.argmin():gap.argmin() + 1], gap.min()
            elif fits.any():
                yield i, at[fits]
        if best is not None:
            yield i, best


def block_pairs(members: DataFrame, measure: Distances, block: int, closest: bool = False) -> DataFrame:
    """(a, b) of the members of large regions that bitmaps do not rule out.

    A region is dealt into blocks of about ``block`` members and every pair of
    blocks meets in a task of its own, so no region has to fit one; only what
    may link comes out.
    """
    nb = F.greatest(F.ceil(F.col("size") / block), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("key", F.lit(99)), nb).cast("int")
    dealt = (members.withColumn("own", own).withColumn("nb", nb)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
             .select("rid", "key", "label", "own", F.least("own", "other").alias("i"),
                     F.greatest("own", "other").alias("j")))
    maps = measure.of(members.select("key"), "bitmap", "n")
    percent = measure.percent

    def run(t: pa.Table) -> pa.Table:
        key = t.column("key").to_numpy()
        a, b = [], []
        for i, js in possible(t.column("bitmap").to_pylist(), t.column("n").to_numpy(),
                              t.column("label").to_numpy(), t.column("own").to_numpy(), percent, closest):
            a.append(np.full(len(js), key[i]))
            b.append(key[js])
        a = np.concatenate(a) if a else np.zeros(0, np.int64)
        b = np.concatenate(b) if b else np.zeros(0, np.int64)
        return pa.table({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})

    return (dealt.join(maps, "key").groupBy("rid", "i", "j")
            .applyInArrow(run, "a long, b long").distinct())


def relabel(labels: DataFrame, linked: DataFrame, tables: Tables) -> DataFrame:
    """Every linked class takes the least label among its links and its own.

    Equal labels mean connected, which is all that the regions prune by; the
    components themselves are found once, at the end.
    """
    def of(side):
        return F.coalesce(F.col(f"l{side}"), F.col(side))

    def known(side):
        return labels.select(F.col("key").alias(side), F.col("label").alias(f"l{side}"))

    least = (linked.join(known("a"), "a", "left").join(known("b"), "b", "left")
             .withColumn("label", F.least(of("a"), of("b"))))
    rows = least.select(F.col("a").alias("key"), "label").union(
        least.select(F.col("b").alias("key"), "label")).union(labels)
    return tables.settle(rows.groupBy("key").agg(F.min("label").alias("label")))


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5,
                       percent: int = 75, leaf: int = 16, rounds: int = 2, block: int = 2048,
                       frequent_limit: int = 1 << 20, small: int = 2_000_000,
                       near_turns: int = 3) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    ``percent`` is the similarity of a link in whole percents, above 50;
    ``rounds`` the depth of the recursion on cells (any depth gives the same
    components);
    ``small`` the rows of 16 bytes up to which a side may be broadcast.
    """
    spark = docs.sparkSession
    tables = Tables(spark, "jaccard")
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sets = write_sets(own, size, percent, frequent_shingles(own, size, frequent_limit, tables), tables)
    classes = tables.settle(sets.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("row").alias("row"), F.first("n").alias("n"), F.min("doc_id").alias("least")))
    measure = Distances(sets, classes, percent, small, tables)
    pairs, members = initial_regions(sets, tables, small)
    links = []
    labels = spark.createDataFrame([], "key long, label long")
    # Cells: every document in the largest of its regions.  Rounds of pivots
    # connect them; what they have not connected is settled in all regions.
    sized = members.join(members.groupBy("rid").agg(F.count(F.lit(1)).alias("m")), "rid")
    cells = tables.settle(sized.groupBy("key").agg(F.max(F.struct("m", "rid")).alias("r"))
                          .select("r.rid", "key"))
    for turn in range(rounds):
        live, pivots = split_round(cells, labels, leaf, turn, tables)
        if pivots.isEmpty():
            break
        live = live.where(F.col("size") > leaf)
        bounds = measure.bounded(live.join(pivots, "rid").where("key <> pivot")
                                 .select(F.col("key").alias("a"), F.col("pivot").alias("b")))
        linked = measure.links(bounds.where("may"))
        links.append(linked)
        for _ in range(3):        # member to pivot to member: labels spread over a cell
            labels = relabel(labels, linked, tables)
        cells = recurse(live, pivots, bounds, linked, tables)
        tables.only(sets, classes, pairs, members, cells, labels, *links)
    # Nearest first, every document in one region a turn (the largest, then others by a
    # hash): what they connect needs naming no more, and bitmaps move once a turn.
    for turn in range(near_turns):
        live = live_members(members, labels, tables)
        order = F.col("size") if turn == 0 else F.xxhash64("rid", F.lit(turn))
        one = (live.where(F.col("size") > leaf).groupBy("key")
               .agg(F.max(F.struct(order.alias("order"), "rid", "size", "label")).alias("r"))
               .select("r.rid", "key", "r.label", "r.size"))
        near = block_pairs(tables.settle(one), measure, block, closest=True)
        linked = measure.links(measure.bounded(near).where("may"))
        if linked.isEmpty():
            break
        links.append(linked)
        for _ in range(3):
            labels = relabel(labels, linked, tables)
        tables.only(sets, classes, pairs, members, labels, *links)
    live = live_members(members, labels, tables)
    tables.drop(members, labels)
    pairs = pairs.union(leaf_pairs(live, leaf)).union(
        block_pairs(live.where(F.col("size") > leaf), measure, block))
    links.append(measure.links(measure.bounded(pairs).where("may")))
    tables.only(sets, classes, *links)
    every = links[0]
    for more in links[1:]:
        every = every.union(more)
    labels = components(every, tables).select(F.col("node").alias("key"), F.col("root").alias("label"))
    named = classes.join(labels, "key", "left").select("key", F.coalesce("label", "key").alias("label"), "least")
    component = (named.join(named.groupBy("label").agg(F.min("least").alias("component_id")), "label")
                 .select("key", "component_id"))
    out = sets.select("doc_id", "n", "key").join(component, "key", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("key").isNull(), F.col("doc_id"))
                      .otherwise(F.col("component_id")).alias("component_id"))
