"""Token counts as delta-maintained rollups (operator 9).

Totals by source, language, tokenizer and version are kept as a log of batches.
A batch holds signed sums only: a new document adds, a deleted one subtracts, a
revised count or a moved document does both (``changes`` derives the signed rows
from the counts before and after).  Sums are additive, so batches may arrive in
any order and the totals are one small aggregate over the log, however large
the corpus: an update costs its changed documents, never a recount.

``commit`` is idempotent: a batch is a folder named by its id, complete once
Spark's ``_SUCCESS`` marker stands in it.  Committing a complete batch again is
a no-op; one whose job died is written anew.  ``compact`` folds the log into one
batch that remembers the ids it holds, so even those cannot be counted twice.

Defined results: null text counts as empty (0 tokens); null source or language
is a group of its own; repeated rows count each; empty inputs commit an empty
batch; groups that fall back to no documents and no tokens leave the totals;
columns of the inputs other than those named are ignored, whatever their names; texts
of any length are counted whole, one at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer", "version")
DELTAS = "source string, lang string, tokenizer string, version string, docs long, tokens long"


def count_tokens(df: DataFrame, tokenizer: str, path: str, version: str, doc_id: str = "doc_id",
                 text: str = "text", source: str = "source", lang: str = "lang") -> DataFrame:
    """(doc_id, source, lang, tokenizer, version, tokens) of every row."""
    from ledgerlake.llm.packing import _KEPT_ENTRIES, chunk_encoder

    kind = df.select(doc_id).schema[0].dataType.simpleString()
    names = ["doc_id", "source", "lang", "tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = chunk_encoder(path)
        for b in batches:
            n = []
            for t in b.column(3):
                n.append(len(enc.encode(t.as_py() or "")) // 4)
                enc.trim()
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(n, pa.int64())], names=names)
        enc.trim(_KEPT_ENTRIES)  # the worker process lives on

    return (df.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                      F.col(lang).alias("lang"), F.col(text).alias("text"))
            .mapInArrow(run, f"doc_id {kind}, source string, lang string, tokens long")
            .select("doc_id", "source", "lang", F.lit(tokenizer).alias("tokenizer"),
                    F.lit(version).alias("version"), "tokens"))


def signed(counts: DataFrame, sign: int) -> DataFrame:
    """Counts as signed rows: +1 inserts them, -1 deletes them."""
    return counts.select(*KEYS, F.lit(sign).cast("long").alias("docs"),
                         (F.coalesce("tokens", F.lit(0)) * sign).cast("long").alias("tokens"))


def changes(before: DataFrame | None, after: DataFrame | None) -> DataFrame:
    """Signed rows that turn the totals of ``before`` into those of ``after``.

    Either side may be missing: only ``after`` inserts, only ``before`` deletes,
    both revise.  No join: what did not change cancels in the sums.
    """
    sides = [signed(x, s) for x, s in ((after, 1), (before, -1)) if x is not None]
    return sides[0].unionByName(sides[1]) if len(sides) == 2 else sides[0]


def _folder(store: str, batch_id: str) -> str:
    name = "".join(c if c.isalnum() or c in "-_" else "_" for c in batch_id)[:60]
    return f"{store.rstrip('/')}/{name}-{hashlib.sha256(batch_id.encode()).hexdigest()[:16]}"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def batches(spark: SparkSession, store: str) -> list[str]:
    """Folders of the complete batches."""
    fs, p = _fs(spark, store)
    if not fs.exists(p):
        return []
    found = [s.getPath().toString() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(x for x in found if _exists(spark, f"{x}/_SUCCESS"))


def live(spark: SparkSession, store: str) -> dict[str, set[str]]:
    """Folders that count, with the batch ids they hold.

    A folder whose ids all stand in a larger one was folded and not yet removed.
    """
    done = batches(spark, store)
    if not done:
        return {}
    rows = (spark.read.parquet(*done)
            .where("batch_ids is not null")
            .select(F.col("_metadata.file_path").alias("f"), "batch_ids").distinct().collect())
    ids = {}
    for r in rows:
        ids.setdefault(next(x for x in done if x.rsplit("/", 1)[1] in r.f), set()).update(r.batch_ids)
    return {f: own for f, own in ids.items() if not any(own < other for other in ids.values())}


def _write(log: DataFrame, ids: list[str], to: str) -> None:
    """Sums of ``log`` with the ids they hold; one row of zeros keeps the ids."""
    sums = (log.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
            .where("docs <> 0 or tokens <> 0"))
    mark = log.sparkSession.range(1).select(*[F.lit(None).cast("string").alias(k) for k in KEYS],
                                            F.lit(0).cast("long").alias("docs"),
                                            F.lit(0).cast("long").alias("tokens"))
    held = F.array(*[F.lit(x) for x in ids])
    (sums.withColumn("batch_ids", F.lit(None).cast("array<string>"))
     .unionByName(mark.withColumn("batch_ids", held)).coalesce(1).write.mode("overwrite").parquet(to))


def commit(spark: SparkSession, store: str, batch_id: str, deltas: DataFrame) -> bool:
    """Add a batch of signed rows once; False if it was there already."""
    to = _folder(store, batch_id)
    if _exists(spark, f"{to}/_SUCCESS") or any(batch_id in x for x in live(spark, store).values()):
        return False
    _write(deltas, [batch_id], to)
    return True


def totals(spark: SparkSession, store: str) -> DataFrame:
    """Documents and tokens by source, language, tokenizer and version."""
    done = live(spark, store)
    log = (spark.read.parquet(*done) if done
           else spark.createDataFrame([], DELTAS + ", batch_ids array<string>"))
    return (log.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
            .where("docs <> 0 or tokens <> 0"))


def compact(spark: SparkSession, store: str, batch_id: str) -> bool:
    """Fold all complete batches into one; their folders go once it stands.

    Until they are gone ``live`` leaves them out, so a crash in between counts
    nothing twice.  Run it alone: it must see every batch that it replaces.
    """
    done = live(spark, store)
    to = _folder(store, batch_id)
    if not done or _exists(spark, f"{to}/_SUCCESS"):
        return False
    _write(spark.read.parquet(*done), sorted({batch_id}.union(*done.values())), to)
    for x in batches(spark, store):
        fs, p = _fs(spark, x)
        if p.getName() != to.rsplit("/", 1)[1]:
            fs.delete(p, True)
    return True
