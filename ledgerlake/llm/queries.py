"""Registered queries of the subpackage: thin digests of each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import oracles
from ledgerlake.session import apply_result_conf

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_result_conf(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run
    return deco


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


@register("op4_quality_rules", oracles.QUALITY_RULES)
def op4(spark, sf_dir):
    """Counts and verdict of every document."""
    from ledgerlake.llm.quality_rules import quality_rules
    out = quality_rules(table(spark, sf_dir, "documents", "doc_id", "text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "base_failed", "kept", "lost_words"]
    return out.select("doc_id", *[F.col(f"qr_{c}").alias(c) for c in names])


def _vocabulary(name: str) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


@register("op7_secret_scan")
def op7(spark, sf_dir):
    """Spans of every document."""
    import public_tokenizers
    from ledgerlake.llm.secret_scan import secret_scan
    out = secret_scan(table(spark, sf_dir, "documents", "doc_id", "text"),
                      _vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, masked=False)
    return out.select("doc_id", *[F.col(f"ss_{c}").alias(c) for c in (
        "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans")])


@register("op8_packing")
def op8(spark, sf_dir):
    """Pieces of every document."""
    from ledgerlake.llm.packing import pack
    return pack(table(spark, sf_dir, "documents", "doc_id", "text"),
                _vocabulary("word_bpe_49k.json"))


@register("op3_quality_classifier")
def op3(spark, sf_dir):
    """Quality score of every document."""
    from ledgerlake.llm import quality_classifier as Q
    from ledgerlake.session import scratch_root
    scratch_root(spark)
    stats = Q.with_statistics(table(spark, sf_dir, "documents", "doc_id", "text")).checkpoint()
    model = Q.fit(Q.labelled(stats, table(spark, sf_dir, "labels", "doc_id", "quality")))
    out = Q.score(stats, model)
    return out.select("doc_id", (~Q.learnable("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.7).cast("int").alias("predicted"))


@register("op6_language_id")
def op6(spark, sf_dir):
    """Predicted language of every document."""
    from ledgerlake.llm import language_id as L
    from ledgerlake.llm.quality_classifier import learnable
    from ledgerlake.session import scratch_root
    scratch_root(spark)
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    codes = L.fit(docs.where(learnable("doc_id")))
    margins = L.with_margins(docs, codes).checkpoint()
    codes = L.weigh(codes, margins.where(learnable("doc_id")))
    out = L.decode(margins.drop("lang"), codes)
    return out.select("doc_id", (~learnable("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")


@register("op9_token_rollups")
def op9(spark, sf_dir):
    """Totals after three batches over all documents, one of them sent twice.

    Documents come in with the estimate their ``n_chars`` gives, are revised to
    the tokenizer's counts, and those labelled toxic are withdrawn.
    """
    from ledgerlake.llm import token_rollups as R
    from ledgerlake.session import scratch_path
    store = scratch_path(spark, "token-rollups", unique=True)
    docs = table(spark, sf_dir, "documents")
    exact = R.count_tokens(docs, "word_bpe_49k", _vocabulary("word_bpe_49k.json"), "1").checkpoint()
    rough = docs.select("doc_id", "source", "lang", F.lit("word_bpe_49k").alias("tokenizer"),
                        F.lit("1").alias("version"), F.expr("n_chars div 4").alias("tokens"))
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id").distinct()
    feed = [("load", R.changes(None, rough)), ("count", R.changes(rough, exact)),
            ("count", R.changes(rough, exact)),
            ("withdraw", R.changes(exact.join(toxic, "doc_id", "left_semi"), None))]
    for batch_id, rows in feed:
        R.commit(spark, store, batch_id, rows)
    return R.totals(spark, store)


@register("op10_html_extraction")
def op10(spark, sf_dir):
    """Main text of every page."""
    from ledgerlake.llm.html_extract import extract
    out = extract(table(spark, sf_dir, "pages", "page_id", "url", "html"), to="text")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@register("op1_decontamination", oracles.DECONTAMINATION)
def op1(spark, sf_dir):
    """Contaminated words of every document."""
    from ledgerlake.llm.decontaminate import decontaminate
    out = decontaminate(table(spark, sf_dir, "documents", "doc_id", "text"),
                        table(spark, sf_dir, "benchmark", "item_id", "text"))
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                      F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


@register("op2_jaccard_join", oracles.JACCARD_JOIN)
def op2(spark, sf_dir):
    """Shingle count and component of every document."""
    from ledgerlake.llm.jaccard_join import jaccard_components
    return jaccard_components(table(spark, sf_dir, "documents", "doc_id", "text"))


@register("op5_suffix_dedup")
def op5(spark, sf_dir):
    """Bytes of every document that repeated strings cover."""
    from ledgerlake.llm.suffix_dedup import suffix_dedup
    out = suffix_dedup(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@register("op11_byte_bpe")
def op11(spark, sf_dir):
    """Ids of every document and the bytes they decode to."""
    import public_tokenizers
    from ledgerlake.llm import byte_bpe as B
    vocabulary = _vocabulary("byte_bpe_multi_50k.tiktoken")
    out = B.decode(B.encode(table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary,
                            public_tokenizers.PATTERN), vocabulary)
    return out.select("doc_id", "n_tokens",
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op12_conversation_repair")
def op12(spark, sf_dir):
    """Faults, cheapest edits and repaired text of every conversation, after damage by rule."""
    from ledgerlake.llm import conversation_repair as C
    from ledgerlake.llm.tables import Tables
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    hurt = C.damage(rows)
    found = Tables(spark, "conversation-repair").settle(C.audits(hurt))
    texts = C.replay(hurt, found, digest=True)
    every = rows.select(F.col("conv_id").alias("c")).distinct()
    out = (every.join(found, F.col("c").eqNullSafe(found.conv_id), "left").drop("conv_id")
           .join(texts, F.col("c").eqNullSafe(texts.conv_id), "left").drop("conv_id"))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(F.col("c").alias("conv_id"), *[F.coalesce(n, F.lit(0)).alias(n) for n in counts],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


@register("op13_hard_negatives", oracles.HARD_NEGATIVES)
def op13(spark, sf_dir):
    """Hard negatives of every hundredth row, some labels moved on."""
    from ledgerlake.llm.hard_negatives import mine
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label").withColumn("label", label)
    return mine(rows, F.col("vec_id") % 100 == 0)
