"""Language identification by error-correcting output codes (operator 6).

Every language gets a codeword of +1/-1 bits (``codebook``: all splits of the
languages while there are few, seeded well-separated random words beyond).  One
binary n-gram classifier per bit predicts on which side of its split a text
stands: log odds of hashed byte trigrams (lower-cased letters, everything else
one blank, so word edges count), languages weighted alike.  Decoding is loss
weighted: each bit's exponential loss counts by how often that classifier was
right for that language on the training rows; the word with the least loss
wins, and a near tie between the two best is flagged.

Spark: one ``mapInArrow`` pass sums trigram counts per language in each task
(at most languages x ``BUCKETS`` rows a task, added up by an aggregate; the
model's size is fixed by those two), a second computes each text's bit margins,
checkpointed as short arrays for the reliability counts and the decoding.  No
text is shuffled.

Defined results: null text, and text without a letter, is ``und`` with score 0;
with nothing learned every text is.  Rows with a null language teach nothing.
Ties go to the language first in text order.  Repeated rows count each; an empty
table teaches nothing and gives no rows; texts of any length are read whole, a block
or one text at a time; a column named ``li_margins`` in any case is refused with
ValueError, others pass through by position.

However many values ``lang`` has: a task counts ``HELD`` of them at once, and what the
driver holds is a codeword and a total for each, and the weights of the bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.textblocks import LOWER, blocks, text_bytes

BUCKETS = 1 << 15
UNKNOWN = "und"
HELD = 64

_FOLD = LOWER.copy()
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 0x20


def trigram_buckets(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A bucket for the trigram at each byte; BUCKETS where it leaves its row."""
    n = len(raw)
    out = np.full(n, BUCKETS, np.int64)
    if n < 3:
        return out
    b = _FOLD[raw].astype(np.uint32)
    h = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(0x9E3779B1)
    out[:-2] = h >> np.uint32(17)
    for back in (1, 2):
        at = off[1:] - back
        out[at[at >= 0]] = BUCKETS
    blank = (b[:-2] == 0x20) & (b[1:-1] == 0x20)
    out[:-2][blank] = BUCKETS
    return out


def codebook(k: int, seed: int = 7) -> np.ndarray:
    """Codewords of k languages, one row each, bits +1 and -1."""
    if k < 2:
        return np.ones((k, 1))
    if k <= 6:
        splits = [s for s in range(1, 1 << k) if s & 1 and s != (1 << k) - 1]
        return np.array([[1.0 if s >> i & 1 else -1.0 for s in splits] for i in range(k)])
    bits = int(np.ceil(10 * np.log2(k)))
    rng = np.random.Generator(np.random.PCG64(seed))
    best, most = None, -1
    for _ in range(200):
        c = rng.choice([-1.0, 1.0], (k, bits))
        apart = (bits - (c @ c.T - 2 * bits * np.eye(k)).max()) / 2
        if apart > most and (abs(c.sum(0)) < k).all():
            best, most = c, apart
    return best


@dataclass(frozen=True)
class Codes:
    languages: tuple
    book: np.ndarray
    weights: np.ndarray      # [BUCKETS + 1, bits], the last row 0
    reliability: np.ndarray | None = None

    def margins(self, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Mean log odds of each text for each bit."""
        at = trigram_buckets(raw, off)
        n = np.concatenate([[0], np.cumsum(at < BUCKETS)])
        count = np.maximum(n[off[1:]] - n[off[:-1]], 1)
        out = np.empty((len(off) - 1, self.weights.shape[1]))
        for k in range(self.weights.shape[1]):
            total = np.concatenate([[0], np.cumsum(self.weights[:, k][at])])
            out[:, k] = (total[off[1:]] - total[off[:-1]]) / count
        return out

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Weighted loss of every codeword, [texts, languages]."""
        z = np.clip(4 * margins, -30, 30)
        w = self.reliability if self.reliability is not None else np.ones_like(self.book)
        w = w / w.sum(1, keepdims=True)
        return np.exp(-z) @ np.where(self.book > 0, w, 0).T + np.exp(z) @ np.where(self.book < 0, w, 0).T

    def decode(self, margins: np.ndarray, near: float = 0.6):
        """Language numbers, scores and near-tie flags."""
        loss = self.losses(margins)
        p = np.exp(-np.log(loss) * 2)
        p /= p.sum(1, keepdims=True)
        best = p.argmax(1)
        top = p[np.arange(len(p)), best]
        return best, top, top < near


def letters(raw: np.ndarray, off: np.ndarray, texts: pa.Array) -> np.ndarray:
    """Whether each text holds a letter of any script."""
    ascii_letter = np.concatenate([[0], np.cumsum((_FOLD[raw] != 0x20) & (raw < 128))])
    has = ascii_letter[off[1:]] > ascii_letter[off[:-1]]
    for i in np.flatnonzero(~has):
        if off[i + 1] > off[i]:
            has[i] = any(c.isalpha() for c in texts[int(i)].as_py())
    return has


def by_languages(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with ``HELD`` languages at most."""
    start, seen = 0, set()
    for i, name in enumerate(b.column(1).to_pylist()):
        if name not in seen and len(seen) == HELD:
            yield b.slice(start, i - start)
            start, seen = i, set()
        seen.add(name)
    yield b.slice(start)


def count_trigrams(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, bucket, n) over all rows with a language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for b in (few for b in blocks(batches, 0) for few in by_languages(b)):
            raw, off = text_bytes(b.column(0))
            at = trigram_buckets(raw, off)
            names = b.column(1).dictionary_encode()
            code = np.repeat(names.indices.to_numpy(), np.diff(off))
            k = len(names.dictionary)
            n = np.bincount(code * (BUCKETS + 1) + at, minlength=k * (BUCKETS + 1))
            for i, name in enumerate(names.dictionary.to_pylist()):
                own = n[i * (BUCKETS + 1):(i + 1) * (BUCKETS + 1) - 1]
                held[name] = held[name] + own if name in held else own
            if len(held) > HELD:
                yield from counted(held)
                held = {}
        yield from counted(held)

    def counted(held):
        for name, n in held.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(n[at])],
                names=["lang", "bucket", "n"])

    rows = df.where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    return (rows.mapInArrow(run, "lang string, bucket long, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))


def fit(df: DataFrame, text: str = "text", lang: str = "lang", smooth: float = 0.5) -> Codes:
    """Bit classifiers from all rows of ``df`` that name a language."""
    counts = count_trigrams(df, text, lang).checkpoint()
    total = {r.lang: r.n + smooth * BUCKETS for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    names = sorted(total)
    book = codebook(len(names))
    if not names:
        return Codes((), book, np.zeros((BUCKETS + 1, 1)))
    size = np.array([total[x] for x in names])
    plus = book > 0
    # A bucket's mean rate over the languages on either side of a bit: what smoothing
    # gives to all, and the counts of the languages that have it.
    least = np.array([smooth / size @ plus, smooth / size @ ~plus])
    sides = np.array([plus.sum(0), (~plus).sum(0)])
    shared = df.sparkSession.sparkContext.broadcast(({x: i for i, x in enumerate(names)}, size, plus))

    def sums(rows: pa.Table) -> pa.Table:
        place, size, plus = shared.value
        i = np.array([place[x] for x in rows.column("lang").to_pylist()])
        rate = rows.column("n").to_numpy() / size[i]
        both = np.array([rate @ plus[i], rate @ ~plus[i]]).ravel()
        return pa.table({"bucket": rows.column("bucket").slice(0, 1), "v": pa.array([both], pa.list_(pa.float64()))})

    with np.errstate(divide="ignore", invalid="ignore"):
        rates = np.repeat(least[None], BUCKETS, 0)
        for r in counts.groupBy("bucket").applyInArrow(sums, "bucket long, v array<double>").toLocalIterator():
            rates[r.bucket] += np.array(r.v).reshape(2, -1)
        rates /= sides
        weights = np.zeros((BUCKETS + 1, book.shape[1]))
        weights[:-1] = np.where((sides > 0).all(0), np.log(rates[:, 0]) - np.log(rates[:, 1]), 0)
    shared.destroy()
    return Codes(tuple(names), book, weights)


def with_margins(df: DataFrame, codes: Codes, text: str = "text") -> DataFrame:
    """``df`` with its text replaced by ``li_margins``, null without a letter."""
    at = df.columns.index(text)
    rest = [k for k in range(len(df.columns)) if k != at]
    if "li_margins" in (df.columns[k].lower() for k in rest):
        raise ValueError("column li_margins exists")
    schema = T.StructType([df.schema.fields[k] for k in rest] + [
        T.StructField("li_margins", T.ArrayType(T.DoubleType()))])

    shared = df.sparkSession.sparkContext.broadcast(codes)  # fixed size: BUCKETS x bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in blocks(batches, at):
            raw, off = text_bytes(b.column(at))
            m = model.margins(raw, off)
            has = letters(raw, off, b.column(at))
            ends = np.concatenate([[0], np.cumsum(np.where(has, m.shape[1], 0))]).astype(np.int32)
            col = pa.ListArray.from_arrays(pa.array(ends, mask=np.append(~has, False)),
                                           pa.array(m[has].ravel()))
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in rest], col], names=schema.names)

    return df.mapInArrow(run, schema)


def weigh(codes: Codes, margins: DataFrame, lang: str = "lang") -> Codes:
    """The codes with each bit's hit rate per language as decoding weight."""
    if len(codes.languages) < 2:
        return codes
    rows = (margins.where(F.col(lang).isNotNull() & F.col("li_margins").isNotNull())
            .select(F.col(lang).alias("lang"), F.posexplode("li_margins").alias("k", "m"))
            .groupBy("lang", "k").agg(F.avg((F.col("m") > 0).cast("double")).alias("up")).collect())
    w = np.full_like(codes.book, 0.5)
    for r in rows:
        i = codes.languages.index(r.lang)
        w[i, r.k] = max(r.up if codes.book[i, r.k] > 0 else 1 - r.up, 1e-3)
    return Codes(codes.languages, codes.book, codes.weights, w)


def decode(margins: DataFrame, codes: Codes) -> DataFrame:
    """Margins replaced by ``lang_pred``, ``score`` and ``ambiguous``."""
    at = margins.columns.index("li_margins")
    rest = [k for k in range(len(margins.columns)) if k != at]
    schema = T.StructType([margins.schema.fields[k] for k in rest] + [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("ambiguous", T.BooleanType())])
    light = Codes(codes.languages, codes.book, codes.weights[:0], codes.reliability)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*light.languages, UNKNOWN], object)
        for b in batches:
            col = b.column(at)
            has = ~np.array(col.is_null()) & bool(light.languages)
            best = np.full(len(col), len(light.languages))
            top, near = np.zeros(len(col)), np.zeros(len(col), bool)
            if has.any():
                m = col.flatten().to_numpy(zero_copy_only=False).reshape(has.sum(), -1)
                best[has], top[has], near[has] = light.decode(m)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(k) for k in rest], pa.array(names[best], pa.string()), pa.array(top),
                 pa.array(near)], names=schema.names)

    return margins.mapInArrow(run, schema)
