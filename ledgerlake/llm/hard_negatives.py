"""Hard-negative mining with rotated one-bit codes and residual intervals (operator 13).

Vectors become integers (``floor(scale * x)``) and are turned by a fixed random rotation
(signs and Hadamard steps).  A row keeps the signs of its turned vector, one bit a
component, and the alignment ``x.c`` with the unit vector ``c`` that these signs stand
for, so ``x = (x.c) c + r`` with a residual ``r`` of known length across ``c``.  An anchor
``q`` is turned too and cut to 8 bit planes; popcounts of planes and code give ``q.c`` up
to the length of what was cut, and Cauchy-Schwarz bounds the rest:

    q.x = (q.c)(x.c) + q.r,   |q.r| <= sqrt(|q|^2 - (q.c)^2) |r|

The interval is certain, not likely.  Candidates whose interval cannot reach the result
are passed over, all others are scored by integers, so results are exact.

Anchors are a stated query set against all rows: rows are dealt evenly into blocks
of ``block_rows`` and anchors into blocks of ``anchor_rows``, and each pair of
blocks is one group.  A group returns the best few rows of each anchor, which a window
merges.  Positives are found first, then negatives in each positive's score range.  Labels
decide nothing about placing, so a hot label makes no hot group.

Defined results: rows take no part if label or vector is null, or a component null, not
finite or of ``scale * x`` beyond 2^26 (more than 1,000 such could exceed a long).  Missing
components of shorter vectors count as 0.  Repeated rows are rows of their own, for
each other "other rows" with equal ids; a null id takes part as candidate and comes
after all ids in ties.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.tables import Tables

LIMIT = 1 << 26
PLANES = 8
ANCHORS_AT_ONCE = 64
PAIRS_AT_ONCE = 1 << 15
_ROW = "key long, vec_id long, label long, block long, ints binary, code binary, align double, norm2 double"


# ------------------------------------------------------------------- codes
@lru_cache(maxsize=4)
def _signs(size: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).choice(np.array([-1.0, 1.0]), (3, size))


def rotate(x: np.ndarray, seed: int) -> np.ndarray:
    """Rows turned by an orthogonal map; their length must be a power of two."""
    n, size = x.shape
    for signs in _signs(size, seed):
        x = x * signs
        step = 1
        while step < size:
            y = x.reshape(n, size // (2 * step), 2, step)
            x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(n, size)
            step *= 2
        x = x / np.sqrt(size)
    return x


def encode(ints: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes as uint64 words, alignments and squared lengths of integer rows."""
    turned = rotate(ints.astype(np.float64), seed)
    up = turned >= 0
    align = np.abs(turned).sum(1) / np.sqrt(ints.shape[1])
    return np.packbits(up, axis=1, bitorder="little").view("<u8"), align, (ints.astype(np.float64) ** 2).sum(1)


def intervals(anchors: np.ndarray, codes: np.ndarray, align: np.ndarray, norm2: np.ndarray,
              seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest possible inner product of each anchor with each coded row."""
    size = anchors.shape[1]
    q = rotate(anchors.astype(np.float64), seed)
    low = q.min(1)
    step = np.maximum((q.max(1) - low) / ((1 << PLANES) - 1), 1e-12)
    u = np.rint((q - low[:, None]) / step[:, None]).astype(np.uint16)
    cut = np.sqrt(((low[:, None] + step[:, None] * u - q) ** 2).sum(1))
    ones = np.bitwise_count(codes).sum(1, dtype=np.int64)
    weighed = np.zeros((len(q), len(codes)))
    for p in range(PLANES):
        plane = np.packbits((u >> p & 1).astype(bool), axis=1, bitorder="little").view("<u8")
        both = np.zeros(weighed.shape, np.int64)
        for w in range(codes.shape[1]):
            both += np.bitwise_count(plane[:, w, None] & codes[None, :, w])
        weighed += both * float(1 << p)
    total = size * low + step * u.sum(1)
    dot = (2 * (low[:, None] * ones + step[:, None] * weighed) - total[:, None]) / np.sqrt(size)
    length2 = (anchors.astype(np.float64) ** 2).sum(1)
    across = np.sqrt(np.maximum(length2[:, None] - np.maximum(np.abs(dot) - cut[:, None], 0) ** 2, 0))
    rest = np.sqrt(np.maximum(norm2 - align ** 2, 0))
    # Rounding of the float steps stays far below this.
    slack = 1e-6 + 1e-9 * np.sqrt(length2)[:, None] * np.sqrt(norm2)
    half = align * cut[:, None] + across * rest + slack
    return dot * align - half, dot * align + half


def scores(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact inner products of rows ``x[i]`` and ``y[j]``."""
    out = np.empty(len(i), np.int64)
    for a in range(0, len(i), PAIRS_AT_ONCE):
        s = slice(a, a + PAIRS_AT_ONCE)
        out[s] = np.einsum("ij,ij->i", x[i[s]], y[j[s]])
    return out


def kth_largest(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, minus infinity where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


def first_few(group: np.ndarray, score: np.ndarray, ids: np.ndarray, key: np.ndarray, k: int) -> np.ndarray:
    """Places of each group's first ``k``: by score descending, then id, then row."""
    order = np.lexsort((key, ids, -score, group))
    g = group[order]
    starts = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
    place = np.arange(len(g)) - np.repeat(starts, np.diff(np.r_[starts, len(g)]))
    return order[place < k]


# ------------------------------------------------------------------ blocks
class _Side:
    """Arrays of one side of a group of blocks."""

    def __init__(self, t: pa.Table, size: int):
        self.key, self.label = (t.column(c).to_numpy() for c in ("key", "label"))
        self.null_id = t.column("vec_id").is_null().to_numpy(zero_copy_only=False)
        self.vec_id = t.column("vec_id").fill_null(0).to_numpy()
        self.order_id = np.where(self.null_id, np.iinfo(np.int64).max, self.vec_id)
        self.ints = np.frombuffer(b"".join(t.column("ints").to_pylist()), "<i4").reshape(-1, size).astype(np.int64)
        self.codes = np.frombuffer(b"".join(t.column("code").to_pylist()), "<u8").reshape(-1, size // 64)
        self.align, self.norm2 = (t.column(c).to_numpy() for c in ("align", "norm2"))

    def ids(self, which: np.ndarray) -> pa.Array:
        return pa.array(self.vec_id[which], pa.int64(), mask=self.null_id[which])


def _positives(size: int, seed: int, k: int):
    """Rows (anchor_key, anchor_id, vec_id, key, score): best others of the anchor's label."""
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        r, q = _Side(rows, size), _Side(anchors, size)
        for label in np.unique(q.label):
            mine, theirs = np.flatnonzero(q.label == label), np.flatnonzero(r.label == label)
            for a in range(0, len(mine), ANCHORS_AT_ONCE):
                some = mine[a:a + ANCHORS_AT_ONCE]
                low, high = intervals(q.ints[some], r.codes[theirs], r.align[theirs], r.norm2[theirs], seed)
                itself = q.key[some][:, None] == r.key[theirs][None, :]
                low[itself], high[itself] = -np.inf, -np.inf
                i, j = np.nonzero((high >= kth_largest(low, k)[:, None]) & ~itself)
                out.append(_best(q, r, some[i], theirs[j], None, k))
        return pa.concat_tables(out) if out else _NO_POSITIVES.empty_table()
    return run


def _best(q: _Side, r: _Side, i: np.ndarray, j: np.ndarray, score: np.ndarray | None, k: int) -> pa.Table:
    score = scores(q.ints, r.ints, i, j) if score is None else score
    top = first_few(i, score, r.order_id[j], r.key[j], k)
    i, j = i[top], j[top]
    return pa.Table.from_arrays([pa.array(q.key[i]), q.ids(i), r.ids(j), pa.array(r.key[j]), pa.array(score[top])],
                                schema=_NO_POSITIVES)


_NO_POSITIVES = pa.schema([("anchor_key", pa.int64()), ("anchor_id", pa.int64()), ("vec_id", pa.int64()),
                           ("key", pa.int64()), ("score", pa.int64())])
_NO_NEGATIVES = pa.schema([*_NO_POSITIVES, ("positive", pa.int64())])


def _negatives(size: int, seed: int, k: int, least: int, most: int):
    """Best rows of other labels in the range of each of the anchors' positives."""
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        r, q = _Side(rows, size), _Side(anchors, size)
        wanted = anchors.column("scores").to_pylist()
        for a in range(0, len(q.key), ANCHORS_AT_ONCE):
            some = np.arange(a, min(a + ANCHORS_AT_ONCE, len(q.key)))
            low, high = intervals(q.ints[some], r.codes, r.align, r.norm2, seed)
            own = q.label[some][:, None] == r.label[None, :]
            n = max(len(wanted[x]) for x in some)
            pos = np.full((len(some), n), -1, np.int64)  # no row fits a negative positive
            for x, y in enumerate(some):
                pos[x, :len(wanted[y])] = wanted[y]
            may = np.zeros(own.shape, bool)
            for p in range(n):
                top, bottom = pos[:, p, None], least * pos[:, p, None] / most
                sure = np.where((low >= bottom) & (high <= top) & ~own, low, -np.inf)
                floor = np.maximum(bottom - 1e-6 * np.abs(bottom), kth_largest(sure, k)[:, None])
                may |= (high >= floor) & (low <= top) & (pos[:, p, None] >= 0)
            i, j = np.nonzero(may & ~own)
            score = scores(q.ints, r.ints, some[i], j)
            for p in range(n):
                ps = pos[i, p]
                fits = (ps >= 0) & (least * ps <= most * score) & (score <= ps)
                found = _best(q, r, some[i[fits]], j[fits], score[fits], k)
                out.append(found.append_column("positive", pa.array(np.full(len(found), p + 1, np.int64))))
        return pa.concat_tables(out) if out else _NO_NEGATIVES.empty_table()
    return run


def _over(df: DataFrame, n: int, name: str) -> DataFrame:
    """Every row once for each block number under ``n``."""
    side = int(np.ceil(np.sqrt(n)))
    each = F.sequence(F.lit(0), F.lit(side - 1))
    return (df.withColumn("_hi", F.explode(each)).withColumn("_lo", F.explode(each))
            .withColumn(name, (F.col("_hi") * side + F.col("_lo")).cast("long")).where(F.col(name) < n)
            .drop("_hi", "_lo"))


def mine(df: DataFrame, anchors: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
         n_positives: int = 5, n_negatives: int = 5, least: int = 80, most: int = 100, scale: float = 256,
         block_rows: int = 4096, anchor_rows: int = 2048, seed: int = 20260) -> DataFrame:
    """Negatives of every anchor and positive, best first.

    ``anchors`` is a condition on column ``vec_id``.  A negative has another label and
    ``least * positive_score <= most * negative_score <= most * positive_score``.  Columns
    anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    spark = df.sparkSession
    x = F.col(vector)
    own = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
                    x.cast("array<double>").alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & (F.abs(c) * scale < LIMIT))
    own = own.where(F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(fine, F.lit(False)))
    total, longest = own.agg(F.count("*"), F.max(F.size("v"))).first()
    size = 64
    while size < (longest or 0):
        size *= 2
    workers = spark.sparkContext.defaultParallelism
    blocks = max(1, -(-total // block_rows), min(2 * workers, total // 512))
    tables = Tables(spark, "hard-negatives")
    coded = tables.settle(own.mapInArrow(_coder(size, seed, blocks, scale), _ROW))
    chosen = tables.settle(coded.where(anchors))
    parts = max(1, -(-chosen.count() // anchor_rows))
    rows = _over(coded, parts, "part").groupBy("block", "part")
    asked = chosen.drop("block").withColumn("part", F.col("key") % parts)

    found = "anchor_key long, anchor_id long, vec_id long, key long, score long"
    best = rows.cogroup(_over(asked, blocks, "block").groupBy("block", "part")).applyInArrow(
        _positives(size, seed, n_positives), found)
    order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "key"]
    place = F.row_number().over(Window.partitionBy("anchor_key").orderBy(*order))
    positives = tables.settle(best.withColumn("positive", place).where(F.col("positive") <= n_positives))

    wanted = positives.groupBy("anchor_key").agg(
        F.array_sort(F.collect_list(F.struct("positive", "score"))).alias("p")).select(
        F.col("anchor_key").alias("key"), F.col("p.score").alias("scores"))
    ranged = _over(asked.join(wanted, "key"), blocks, "block")
    near = rows.cogroup(ranged.groupBy("block", "part")).applyInArrow(
        _negatives(size, seed, n_negatives, least, most), found + ", positive long")
    place = F.row_number().over(Window.partitionBy("anchor_key", "positive").orderBy(*order))
    last = near.withColumn("rank", place).where(F.col("rank") <= n_negatives).alias("n")
    return (last.join(positives.alias("p"), ["anchor_key", "positive"])
            .select(F.col("n.anchor_id"), F.col("p.vec_id").alias("positive_id"), "rank",
                    F.col("n.vec_id").alias("negative_id"), F.col("p.score").alias("positive_score"),
                    F.col("n.score").alias("negative_score")))


def _coder(size: int, seed: int, blocks: int, scale: float):
    """Map of vectors to integers, codes and a row key; blocks are dealt round."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        first = TaskContext.get().partitionId() << 40
        # Partitions start at different blocks, so short ones don't all fill the first.
        turn = first % blocks + TaskContext.get().partitionId() * 7919
        done = 0
        for batch in batches:
            for a in range(0, batch.num_rows, 8192):
                part = batch.slice(a, 8192)
                n = part.num_rows
                v = part.column(2)
                lengths = v.value_lengths().to_numpy()
                ints = np.zeros((n, size), np.int64)
                at = np.arange(size) < lengths[:, None]
                ints[at] = np.floor(v.flatten().to_numpy() * scale).astype(np.int64)
                codes, align, norm2 = encode(ints, seed)
                count = done + np.arange(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first + count), part.column(0), part.column(1), pa.array((turn + count) % blocks),
                     pa.array([x.tobytes() for x in ints.astype("<i4")], pa.binary()),
                     pa.array([x.tobytes() for x in codes], pa.binary()), pa.array(align), pa.array(norm2)],
                    ["key", "vec_id", "label", "block", "ints", "code", "align", "norm2"])
                done += n
    return run
