"""Quality classifier: regularised quadratic discriminant (operator 3).

Each document becomes a short vector of transformed statistics of its text
(``STATISTICS``).  Per class the mean and covariance are summed over all
labelled training rows; the covariance is shrunk towards the pooled one and
towards its own diagonal, and its Cholesky factor is cached in the model, so a
score costs one triangular product: the difference of the two classes' log
densities, through a logistic link with slope ``slope``.

Spark: statistics are one pass of ``mapInArrow`` over the texts, checkpointed
as small vectors; moments are partial sums per task, added up by a grouped
aggregate (2 classes times a few hundred numbers reach the driver, whatever the
input); scoring is another map over the vectors.  No text is shuffled.

Defined results: null and empty texts have the vector of an empty text and get
a score like any other.  Labels null or other than 0 and 1 are ignored; a
document labelled twice the same way counts once, one labelled both ways is
left out.  With no training rows of a class the score is 0.5.  Repeated
documents are scored each on their own, and each teaches with its label.  An empty table
gives no rows; texts of any length are read whole, a block or one text at a time; a
column that has the name of an added one raises an error where it is used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.textblocks import blocks, row_sums, span_hashes, spans, text_bytes, word_spans

STATISTICS = (
    "log_words", "log_word_bytes", "symbol_share", "mark_share", "upper_share", "digit_share",
    "bar_share", "log_lines", "log_line_bytes", "same_word_share", "same_line_share",
    "worst_line_marks", "worst_line_upper", "other_bytes_share")


def _table(chars: str) -> np.ndarray:
    t = np.zeros(256, np.uint8)
    t[list(chars.encode())] = 1
    return t


_SYMBOL = _table("#*$%&<>@^~")
_MARK = _table("!?\"'()[]{}+=/\\\\:;_-") | _SYMBOL | _table("|")
_UPPER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _UPPER | _table("abcdefghijklmnopqrstuvwxyz")
_DIGIT = _table("0123456789")
_BAR = _table("|")
_HIGH = np.zeros(256, np.uint8)
_HIGH[0x80:] = 1


def statistics(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Rows of ``STATISTICS`` for the texts ``raw[off[i]:off[i + 1]]``."""
    n = len(off) - 1
    out = np.zeros((n, len(STATISTICS)))
    starts, ends = word_spans(raw, off)
    word_row = np.searchsorted(off, starts, "right") - 1
    words = np.bincount(word_row, minlength=n)
    solid = np.bincount(word_row, ends - starts, minlength=n)
    # Pseudo-counts: a text of three words is no evidence of anything.
    per_word, per_byte = words + 10, solid + 40
    marks, upper, letters = _MARK[raw], _UPPER[raw], _LETTER[raw]
    n_letters = row_sums(letters, off) + 40

    def share(flags, of):
        return np.sqrt(row_sums(flags, off) / of)

    same = np.zeros(len(starts), bool)
    if len(starts) > 1:
        h = span_hashes(raw, starts, ends)
        same[1:] = (h[1:] == h[:-1]) & (word_row[1:] == word_row[:-1])
    line_s, line_e = spans(raw != 10, off)
    line_row = np.searchsorted(off, line_s, "right") - 1
    lines = np.bincount(line_row, minlength=n)
    size = line_e - line_s
    again = np.zeros(len(line_s), bool)
    if len(line_s) > 1:
        h = span_hashes(raw, line_s, line_e)
        again[1:] = (h[1:] == h[:-1]) & (line_row[1:] == line_row[:-1])

    def worst(flags, least):
        """Largest share in a line, lines under 40 bytes counted as if of 40."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        got = (total[line_e] - total[line_s]) / np.maximum(least, 40)
        top = np.zeros(n)
        np.maximum.at(top, line_row, got)
        return np.sqrt(top)

    total = np.diff(off) + 40
    for k, col in enumerate((
            np.log(words + 20), np.log((solid + 50) / per_word),
            share(_SYMBOL[raw], per_byte), share(marks, per_byte), share(upper, n_letters),
            share(_DIGIT[raw], per_byte), share(_BAR[raw], per_byte),
            np.log(lines + 5), np.log((total + 200) / (lines + 5)),
            np.sqrt(np.bincount(word_row, same, minlength=n) / per_word),
            np.sqrt(np.bincount(line_row, again * size, minlength=n) / total),
            worst(marks, size), worst(upper, size), share(_HIGH[raw], per_byte))):
        out[:, k] = col
    return out


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with its text replaced by ``qc_stats`` (array of double)."""
    from pyspark.sql import types as T

    if "qc_stats" in (c.lower() for c in df.columns):
        raise ValueError("column qc_stats exists")
    at = df.columns.index(text)
    rest = [k for k in range(len(df.columns)) if k != at]
    schema = T.StructType([df.schema.fields[k] for k in rest] + [
        T.StructField("qc_stats", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, at):
            x = statistics(*text_bytes(b.column(at)))
            col = pa.ListArray.from_arrays(
                pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in rest], col], names=schema.names)

    return df.mapInArrow(run, schema)


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and log determinants of both classes."""

    means: tuple
    factors: tuple
    offsets: tuple
    slope: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), 0.5)
        logs = [-0.5 * np.square((x - m) @ f.T).sum(1) + o
                for m, f, o in zip(self.means, self.factors, self.offsets)]
        z = np.clip(self.slope * (logs[1] - logs[0]), -500, 500)
        return 1 / (1 + np.exp(-z))


def discriminant(sums: dict[int, tuple], pooled: float = 0.3, diagonal: float = 0.1,
                 ridge: float = 1e-3, slope: float = 0.5, prior: float = 0.5) -> Discriminant:
    """The model from (count, sum of x, sum of x x') of the classes 0 and 1."""
    if any(sums.get(c, (0,))[0] < 2 for c in (0, 1)):
        return Discriminant((), (), (), slope)
    mean, cov = {}, {}
    for c, (n, s, ss) in sums.items():
        mean[c] = s / n
        cov[c] = ss / n - np.outer(mean[c], mean[c])
    both = sum(sums[c][0] for c in (0, 1))
    shared = sum(sums[c][0] * cov[c] for c in (0, 1)) / both
    factors, offsets = [], []
    for c in (0, 1):
        m = (1 - pooled) * cov[c] + pooled * shared
        m = (1 - diagonal) * m + diagonal * np.diag(np.diag(m)) + ridge * np.eye(len(m))
        low = np.linalg.cholesky(m)
        factors.append(np.linalg.inv(low))
        p = prior if c else 1 - prior
        offsets.append(float(np.log(p) - np.log(np.diag(low)).sum()))
    return Discriminant((mean[0], mean[1]), tuple(factors), tuple(offsets), slope)


def fit(stats: DataFrame, label: str = "label", **settings) -> Discriminant:
    """Fit on every row of ``stats`` whose ``label`` is 0 or 1."""
    d = len(STATISTICS)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, 1 + d + d * d))
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            y = b.column(1).to_numpy(zero_copy_only=False)
            for c in (0, 1):
                own = x[y == c]
                held[c] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([0, 1], held.shape[1])),
             pa.array(np.tile(np.arange(held.shape[1]), 2)), pa.array(held.ravel())],
            names=["c", "k", "v"])

    rows = (stats.where(F.col(label).isin(0, 1))
            .select("qc_stats", F.col(label).cast("int").alias("y"))
            .mapInArrow(moments, "c long, k long, v double")
            .groupBy("c", "k").agg(F.sum("v").alias("v")).collect())
    sums = {}
    for c in (0, 1):
        v = np.zeros(1 + d + d * d)
        for r in rows:
            if r.c == c:
                v[r.k] = r.v
        sums[c] = (v[0], v[1:1 + d], v[1 + d:].reshape(d, d))
    return discriminant(sums, **settings)


def score(stats: DataFrame, model: Discriminant, to: str = "score") -> DataFrame:
    """``stats`` with its vectors replaced by the score column ``to``."""
    from pyspark.sql import types as T

    at = stats.columns.index("qc_stats")
    rest = [k for k in range(len(stats.columns)) if k != at]
    schema = T.StructType([stats.schema.fields[k] for k in rest] + [T.StructField(to, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(k) for k in rest], pa.array(model.scores(x))], names=schema.names)

    return stats.mapInArrow(run, schema)


def learnable(doc_id) -> "F.Column":
    """False for the held-out quarter; a null id is learnable."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4, F.lit(0)) != 2


def labelled(stats: DataFrame, labels: DataFrame, doc_id: str = "doc_id",
             label: str = "quality") -> DataFrame:
    """Vectors of the learnable documents with an undisputed label."""
    one = (labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
           .groupBy(F.col(doc_id).alias("qc_id"))
           .agg(F.min(label).alias("label"), F.max(label).alias("qc_most"))
           .where(F.col("label") == F.col("qc_most")))
    return (stats.where(learnable(doc_id))
            .join(one, F.col(doc_id) == F.col("qc_id")).select("qc_stats", "label"))
