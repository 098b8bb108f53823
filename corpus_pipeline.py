"""The training-data pipeline: five operators over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.  All but the last keep
the columns of ``documents``.  Stages judge their own input only:

1. quality: documents that the quality classifier rejects go;
2. near_duplicates: of every group of near-duplicates one document stays, the
   one with the least ``doc_id``, null last; documents without a word link with
   nothing, rows are told apart by id and text, and rows equal in both are one
   document;
3. decontamination: documents holding a benchmark passage go;
4. secrets: secrets are masked in the text, ``n_chars`` follows;
5. packing: the texts become token sequences.

Scores and token ids have no SQL form, so ``ORACLE_SQL`` is None and
the stages are tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm import decontaminate as D
from ledgerlake.llm import jaccard_join as J
from ledgerlake.llm import packing as P
from ledgerlake.llm import quality_classifier as Q
from ledgerlake.llm import secret_scan as S
from ledgerlake.session import apply_result_conf, scratch_path, scratch_root

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
KEEP_FROM = 0.3

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose quality score is ``KEEP_FROM`` or more.

    A filter must not lose clean documents, so it asks for less than the 0.7 at
    which the classifier calls a document good.
    """
    scratch_root(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    stats = Q.with_statistics(docs.select("doc_id", "text")).checkpoint()
    model = Q.fit(Q.labelled(stats, labels))
    kept = Q.with_statistics(docs.select(*COLUMNS, F.col("text").alias("qc_text")), text="qc_text")
    return Q.score(kept, model, "qc_score").where(F.col("qc_score") >= KEEP_FROM).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every near-duplicate group: the one that names it."""
    # Rows with an id go before those without, so one of these names a group if any can.
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.xxhash64("text").alias("text_key"))
    own = docs.select(*COLUMNS).withColumn("row_key", key)
    found = J.jaccard_components(own.select("row_key", "text"), doc_id="row_key")
    losers = (found.where((F.col("n_shingles") > 0) & ~F.col("component_id").eqNullSafe(F.col("doc_id")))
              .select(F.col("doc_id").alias("lost_key")).distinct())
    rest = own.join(losers, own.row_key.eqNullSafe(F.col("lost_key")), "left_anti").select(*COLUMNS)
    # An id on several rows: equal texts are one document.  Only such rows move.
    shared = rest.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("many"))
    several = rest.join(shared, rest.doc_id.eqNullSafe(F.col("many")), "left_semi")
    one = several.groupBy("doc_id", "text").agg(
        F.min(F.struct("lang", "source", "n_chars")).alias("r")).select(
        "doc_id", "text", "r.lang", "r.source", "r.n_chars")
    return rest.join(shared, rest.doc_id.eqNullSafe(F.col("many")), "left_anti").union(one)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a benchmark passage."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    key = F.struct(F.col("doc_id"), F.xxhash64("text").alias("text_key"))
    own = docs.select(*COLUMNS).withColumn("row_key", key)
    bad = (D.decontaminate(own.select("row_key", "text"), items, doc_id="row_key").where("contaminated")
           .select(F.col("doc_id").alias("bad_key")).distinct())
    return own.join(bad, own.row_key.eqNullSafe(F.col("bad_key")), "left_anti").select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, secrets masked."""
    import public_tokenizers
    out = S.secret_scan(docs.select(*COLUMNS), str(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")),
                        public_tokenizers.PATTERN)
    text = F.when(F.col("text").isNotNull(), F.col("ss_masked_text"))
    return out.select("doc_id", text.alias("text"), "lang", "source",
                      F.when(F.col("ss_spans") == "", F.col("n_chars"))
                      .otherwise(F.length(text).cast("long")).alias("n_chars"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    import public_tokenizers
    return P.pack(docs, str(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("secrets", secrets), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's result written and read again."""
    apply_result_conf(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch_path(spark, f"pipeline-{name}", unique=True)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
