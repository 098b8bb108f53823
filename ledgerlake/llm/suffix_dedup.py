"""Exact substring deduplication by external induced sorting (operator 5).

Every byte covered by a ``length``-byte string that also starts elsewhere is
removed.  The corpus is cut into shards in which equal strings must meet, and
each shard's suffixes are sorted by induction:

1. every ``length``-byte window is named by its anchor, the ``gram`` bytes in it
   with the least hash; neighbouring windows with one anchor form a fragment.
   Equal windows have equal anchors, so an anchor that occurs once names no
   repeated window;
2. fragments equal byte for byte are counted, not repeated: with two or more
   occurrences all their windows repeat;
3. one copy of each fragment of an anchor with several different fragments goes
   to the shard of that anchor, where ``induced_order`` sorts all suffixes and
   neighbours that share ``length`` bytes are marked;
4. an anchor with more than ``hold`` bytes of different fragments would fill one
   shard, so its windows go, each by its 64-bit hash, to all shards, where equal
   ones are neighbours.  They are not sorted by suffixes.

Induction: suffixes that start a descent-to-ascent turn (LMS) are ranked by
their substrings, the ranks of following substrings doubling the depth; queues
by leading byte then carry the others into place, first the descending ones
from small to large, then the ascending ones from large to small.  Queues are
read block by block and lie in files of the task's temporary folder (removed at
its end) beyond ``memory`` bytes.  A shard may be far larger than memory: Spark
sorts it by anchor, spilling, and as equal windows share an anchor, whole
anchors are induced ``hold`` bytes at a time, one anchor at least.  In memory
are such a group's text, its prefix hashes, types and the ranks of its turning
points, whatever the size of the shard.  The order is carried to ``length``
bytes and a little beyond, all that the question needs, and shared prefixes are
read off for final neighbours instead of being carried along.

Spark: anchors move as four numbers; counting is a windowed aggregate that
spills; texts are shuffled twice (to cut fragments, to cut the result), by a
hash of the row, so neither sources nor copies are hot.

Defined results: null text counts as empty (0 bytes, nothing removed); texts
under ``length`` bytes cannot match; matches never cross texts; repeated rows
are each other's copies and come out as often as they went in; rows are told
apart by a 64-bit hash of id and text; there are no ties, since every occurrence goes; an
empty table gives no rows; texts of any length are one row; columns other than the two
named are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.textblocks import _BYTE, _INVERSE, _POWER, _powers, blocks, mix, span_hashes, text_bytes

LENGTH, GRAM = 200, 32
HOLD = 4 << 20            # bytes of fragments sorted at once
_POS = np.uint64((1 << 28) - 1)
# What becomes of a fragment: counted only, sorted with its anchor's, or its windows counted.
ALONE, SORTED, HOT = 0, 1, 2


def fragments(raw: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(row, lo, hi, anchor, hash): runs of windows with one anchor, lo..hi their starts."""
    n, w = len(raw), length - gram + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, none
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _powers(_POWER, n), out=total[1:])
    h = mix((total[gram:] - total[:-gram]) * _powers(_INVERSE, n + 1)[:n - gram + 1])
    # Least hash of w neighbours, leftmost if equal: blocks of w, minima from both ends.
    v = (h & ~_POS) | np.arange(len(h), dtype=np.uint64)
    m = len(v) - w + 1
    pad = -len(v) % w
    grid = np.concatenate([v, np.full(pad, ~np.uint64(0))]).reshape(-1, w)
    fore = np.minimum.accumulate(grid, 1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    at = (np.minimum(back[:m], fore[w - 1:w - 1 + m]) & _POS).astype(np.int64)
    row = np.searchsorted(off, np.arange(m), "right") - 1
    ok = np.arange(m) + length <= off[row + 1]
    start = np.flatnonzero(ok & np.concatenate([[True], (at[1:] != at[:-1]) | (row[1:] != row[:-1])]))
    stop = np.flatnonzero(ok & np.concatenate([(at[1:] != at[:-1]) | ~ok[1:] | (row[1:] != row[:-1]), [True]]))
    r = row[start]
    return (r, start - off[r], stop - off[r], h[at[start]].view(np.int64),
            span_hashes(raw, start, stop + length).view(np.int64))


# ------------------------------------------------------- external induction
class Queues:
    """First-in first-out queues of positions by leading byte, on disk beyond ``memory``."""

    def __init__(self, folder: str, name: str, memory: int):
        self.path, self.memory, self.held = f"{folder}/{name}", memory, 0
        self.parts: list[list[np.ndarray]] = [[] for _ in range(256)]
        self.filed, self.turn = [False] * 256, [0] * 256

    def push(self, c: int, at: np.ndarray) -> None:
        self.parts[c].append(at)
        self.held += at.nbytes
        if self.held > self.memory:
            for k, own in enumerate(self.parts):
                if own:
                    with open(f"{self.path}-{k}-{self.turn[k]}", "ab") as f:
                        for x in own:
                            x.tofile(f)
                    self.filed[k] = True
                    self.parts[k] = []
            self.held = 0

    def push_by(self, text: np.ndarray, at: np.ndarray) -> None:
        """Each position to the queue of its byte, order kept."""
        if len(at):
            c = text[at]
            order = np.argsort(c, kind="stable")
            c, at = c[order], at[order]
            cuts = np.flatnonzero(np.diff(c)) + 1
            for own in np.split(at, cuts):
                self.push(int(text[own[0]]), own)

    def read(self, c: int, back: bool = False, block: int = 1 << 17) -> Iterator[np.ndarray]:
        """The queue's content block by block, from its end if ``back``; it stays."""
        own = self.parts[c]
        if back:
            yield from (x[::-1] for x in reversed(own))
        if self.filed[c]:
            name = f"{self.path}-{c}-{self.turn[c]}"
            starts = range(0, os.path.getsize(name) // 8, block)
            for at in reversed(starts) if back else starts:
                x = np.fromfile(name, np.int64, block, offset=8 * at)
                yield x[::-1] if back else x
        if not back:
            yield from own

    def pop(self, c: int) -> Iterator[np.ndarray]:
        """The queue's content in order, also what is pushed meanwhile."""
        while self.parts[c] or self.filed[c]:
            was = Queues.__new__(Queues)
            was.path, was.turn, was.filed, was.parts = self.path, self.turn[:], self.filed[:], self.parts[:]
            self.held -= sum(x.nbytes for x in self.parts[c])
            self.parts[c], self.filed[c] = [], False
            self.turn[c] += 1
            yield from was.read(c)
            if was.filed[c]:
                os.truncate(f"{was.path}-{c}-{was.turn[c]}", 0)


def substring_ranks(text: np.ndarray, lms: np.ndarray, depth: int) -> np.ndarray:
    """Order of the LMS suffixes by ``depth`` bytes or more, equal ones together."""
    m = len(lms)
    end = np.append(lms[1:], len(text) - 1)
    size = end - lms + 1
    rank = np.zeros(m, np.int64)
    live, at = np.arange(m), 0
    while len(live) and at < depth:
        key = np.zeros(len(live), np.uint64)
        for k in range(8):
            i = at + k
            inside = i < size[live]
            b = np.where(inside, text[np.minimum(lms[live] + i, len(text) - 1)], 255).astype(np.uint64)
            key = key << np.uint64(8) | b
        order = np.lexsort((key, rank[live]))
        a, b = rank[live][order], key[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        first = np.concatenate([[True], a[1:] != a[:-1]])
        place = np.arange(len(live))
        group = np.maximum.accumulate(np.where(first, place, 0))
        inner = np.maximum.accumulate(np.where(new, place, 0))
        rank[live[order]] = a + (inner - group)      # ranks leave room for their group
        at += 8
        # Still tied, and not yet ended inside the substring.
        tied = np.zeros(len(live), bool)
        tied[order[:-1]] |= ~new[1:]
        tied[order[1:]] |= ~new[1:]
        live = live[tied]
        longer = np.zeros(m, bool)
        longer[live] = size[live] > at
        keep = np.isin(rank[live], rank[np.flatnonzero(longer)])
        live = live[keep]
    step = 1
    while 2 * step <= depth:
        order = np.argsort(rank, kind="stable")
        tie = np.flatnonzero(np.diff(rank[order]) == 0)
        if not len(tie):
            break
        live = order[np.unique(np.concatenate([tie, tie + 1]))]
        after = np.where(live + step < m, rank[np.minimum(live + step, m - 1)], -1)
        o = np.lexsort((after, rank[live]))
        a, b = rank[live][o], after[o]
        place = np.arange(len(o))
        first = np.concatenate([[True], a[1:] != a[:-1]])
        new = first | np.concatenate([[True], b[1:] != b[:-1]])
        group = np.maximum.accumulate(np.where(first, place, 0))
        inner = np.maximum.accumulate(np.where(new, place, 0))
        rank[live[o]] = a + (inner - group)
        step *= 2
    return np.argsort(rank, kind="stable")


def induced_order(text: np.ndarray, folder: str, memory: int, depth: int) -> Iterator[np.ndarray]:
    """All positions by their suffixes, compared to ``depth`` bytes; ``text`` ends in 0."""
    n = len(text)
    step = np.sign(np.diff(text.astype(np.int16))).astype(np.int8)     # next minus own
    turn = np.flatnonzero(step)
    nearest = np.searchsorted(turn, np.arange(n - 1))
    falls = np.append(np.where(nearest < len(turn), step[turn[np.minimum(nearest, len(turn) - 1)]] < 0, True)
                      if len(turn) else np.ones(n - 1, bool), False)    # L type
    del nearest, turn, step
    lms = np.flatnonzero(~falls[1:-1] & falls[:-2]) + 1     # the end is the least of all
    lms = lms[substring_ranks(text, lms, depth)]
    waiting, fallen = Queues(folder, "l", memory), Queues(folder, "L", memory)
    ranked = Queues(folder, "m", memory)
    ranked.push_by(text, lms)
    if n > 1:
        waiting.push_by(text, np.array([n - 2]))
    for c in range(256):
        for at in waiting.pop(c):
            fallen.push(c, at)
            before = at[at > 0] - 1
            waiting.push_by(text, before[falls[before]])
        for at in ranked.pop(c):
            before = at[at > 0] - 1
            waiting.push_by(text, before[falls[before]])
    rising, risen = Queues(folder, "s", memory), Queues(folder, "S", memory)
    for c in range(255, -1, -1):
        for at in rising.pop(c):
            risen.push(c, at)
            before = at[at > 0] - 1
            rising.push_by(text, before[~falls[before]])
        for at in fallen.read(c, back=True):
            before = at[at > 0] - 1
            rising.push_by(text, before[~falls[before]])
    yield np.array([n - 1])
    for c in range(256):
        yield from fallen.pop(c)
        yield from risen.read(c, back=True)


def repeated_windows(parts: list[bytes], folder: str, length: int = LENGTH,
                     memory: int = 64 << 20) -> list[np.ndarray]:
    """For each byte string, the starts of its windows that occur twice in all of them."""
    size = np.array([len(p) for p in parts])
    begin = np.concatenate([[0], np.cumsum(size + 1)])
    n = int(begin[-1])
    text = (np.memmap(f"{folder}/text", np.uint8, "w+", shape=(n,)) if n > memory else np.empty(n, np.uint8))
    for p, at in zip(parts, begin):
        text[at:at + len(p)] = np.frombuffer(p, np.uint8) + 1          # UTF-8 has no byte 255
        text[at + len(p)] = 0
    end = np.repeat(begin[1:] - 1, size + 1)                            # of the part at each byte
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[text] * _powers(_POWER, n), out=total[1:])
    inverse = _powers(_INVERSE, n + 1)
    hit = np.zeros(n, bool)
    last, last_hash = None, None
    for at in induced_order(text, folder, memory, length):
        at = at[at + length <= end[at]]
        if not len(at):
            continue
        h = mix((total[at + length] - total[at]) * inverse[at])
        if last is not None:
            at, h = np.append(last, at), np.append(last_hash, h)
        same = h[1:] == h[:-1]
        hit[at[1:][same]] = True
        hit[at[:-1][same]] = True
        last, last_hash = at[-1], h[-1]
    return [np.flatnonzero(hit[a:a + s]) for a, s in zip(begin, size)]


def _runs(at: np.ndarray) -> list[tuple[int, int]]:
    """Runs of consecutive numbers as (first, last)."""
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > 1)
    return list(zip(at[np.append(0, cut + 1)].tolist(), at[np.append(cut, len(at) - 1)].tolist()))


def suffix_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                 gram: int = GRAM, shards: int | None = None, with_text: bool = False,
                 hold: int = HOLD) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``,
    ``kept_sha256``, ``spans`` (removed byte spans, end exclusive), and ``kept``
    (binary) if ``with_text``, else null.  A task sorts about ``hold`` bytes at once.
    """
    from ledgerlake.session import scratch_root

    spark = docs.sparkSession
    scratch_root(spark)
    kind = docs.select(doc_id).schema[0].dataType.simpleString()
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn(
        "row", F.xxhash64("doc_id", "text"))
    width = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, 1):
            r, lo, hi, anchor, frag = fragments(*text_bytes(b.column(1)), length, gram)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(r)), pa.array(lo << 8 | (hi - lo)), pa.array(anchor), pa.array(frag)],
                names=["row", "span", "anchor", "frag"])

    seen = own.select("row", "text").mapInArrow(cut, "row long, span long, anchor long, frag long")
    by_anchor = Window.partitionBy("anchor")
    by_frag = Window.partitionBy("anchor", "frag")
    met = (seen.repartition(width, "anchor")
           .withColumn("copies", F.count(F.lit(1)).over(by_frag))
           .withColumn("nth", F.row_number().over(by_frag.orderBy("row", "span")))
           .withColumn("least", F.min("frag").over(by_anchor))
           .withColumn("most", F.max("frag").over(by_anchor))
           .withColumn("bytes", F.sum(F.when(F.col("nth") == 1, F.col("span").bitwiseAND(255) + length))
                       .over(by_anchor))
           .where("copies > 1 or least <> most")
           .select("row", "span", "anchor", "copies", F.when(F.expr("least = most or nth > 1"), ALONE)
                   .when(F.col("bytes") <= hold, SORTED).otherwise(HOT).alias("way")).checkpoint())
    wanted = (met.where(F.col("way") != ALONE).groupBy("row")
              .agg(F.collect_list(F.struct("span", "anchor", "copies", "way")).alias("cuts")))
    # Rows that are repeated share a hash; one of them stands for all.
    texts = own.select("row", "text").join(wanted, "row").dropDuplicates(["row"])

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "span", "key", "copies", "part"]
        kinds = [pa.int64()] * 4 + [pa.binary()]
        for b in blocks(batches, 1):
            out = []
            for row, t, cuts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                t = t.encode()
                for c in cuts:
                    lo, more = c["span"] >> 8, c["span"] & 255
                    part = t[lo:lo + more + length]
                    if c["way"] == SORTED:
                        out.append((row, c["span"], c["anchor"], c["copies"], part))
                    else:
                        at = np.arange(more + 1)
                        h = span_hashes(np.frombuffer(part, np.uint8), at, at + length).view(np.int64)
                        out += [(row, lo + i << 8, k, c["copies"], None) for i, k in enumerate(h.tolist())]
                    if len(out) >= 1 << 14:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(list(x), k) for x, k in zip(zip(*out), kinds)], names=names)
                        out = []
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(x), k) for x, k in zip(zip(*out), kinds)], names=names)

    def spans_of(rows, lo, hi) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (rows, lo, hi)],
                                          names=["row", "lo", "hi"])

    def sort(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        with tempfile.TemporaryDirectory() as folder:
            found = repeated_windows(t.column("part").to_pylist(), folder, length)
        rows, lo, hi = [], [], []
        for row, span, copies, at in zip(t.column("row").to_pylist(), t.column("span").to_pylist(),
                                         t.column("copies").to_pylist(), found):
            if copies == 1:                       # others repeat as a whole anyway
                for a, b in _runs(at):
                    rows.append(row), lo.append((span >> 8) + a), hi.append((span >> 8) + b)
        return spans_of(rows, lo, hi)

    def induce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorts whole anchors, ``hold`` bytes or one anchor at once; compares the keys of single windows."""
        held, size, key = [], 0, None
        last = np.zeros((4, 0), np.int64)
        for b in batches:
            single = b.column(4).is_null()
            if single.true_count:
                now = np.array([b.filter(single).column(k).to_numpy() for k in range(4)])
                own = np.concatenate([last, now], 1)
                same = own[2, 1:] == own[2, :-1]
                hit = np.append(same, False) | np.append(False, same)
                hit[:max(last.shape[1] - 1, 0)] = False       # given out before
                hit &= own[3] == 1
                yield spans_of(own[0, hit], own[1, hit] >> 8, own[1, hit] >> 8)
                last = own[:, -2:]
                b = b.filter(pa.array(~single.to_numpy(zero_copy_only=False)))
            if not b.num_rows:
                continue
            keys = b.column(2).to_numpy()
            bytes_to = np.cumsum(pc.binary_length(b.column(4)).to_numpy())
            cuts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])).tolist() + [len(keys)]
            start = 0
            for a, z in zip(cuts, cuts[1:]):
                more = int(bytes_to[z - 1] - (bytes_to[a - 1] if a else 0))
                if keys[a] != key and size and size + more > hold:
                    if a > start:
                        held.append(b.slice(start, a - start))
                    yield sort(held)
                    held, size, start = [], 0, a
                size, key = size + more, keys[a]
            held.append(b.slice(start))
        if held:
            yield sort(held)

    partly = (texts.mapInArrow(take, "row long, span long, key long, copies long, part binary")
              .repartition(width, "key").sortWithinPartitions("key").mapInArrow(induce, "row long, lo long, hi long"))
    whole = met.where("copies > 1").select("row", F.shiftright("span", 8).alias("lo"),
                                           (F.shiftright("span", 8) + F.col("span").bitwiseAND(255)).alias("hi"))
    marks = whole.union(partly).groupBy("row").agg(
        F.collect_set(F.struct("lo", "hi")).alias("marks"))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [[] for _ in names[1:]]
            for t, marked in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                t = (t or "").encode()
                gone: list[list[int]] = []
                for m in sorted((m["lo"], m["hi"] + length) for m in marked or ()):
                    if gone and m[0] <= gone[-1][1]:
                        gone[-1][1] = max(gone[-1][1], m[1])
                    else:
                        gone.append([m[0], m[1]])
                at, keep = 0, []
                for a, z in gone:
                    keep.append(t[at:a])
                    at = z
                kept = b"".join([*keep, t[at:]])
                for col, v in zip(out, (len(t), len(t) - len(kept), len(gone),
                                        hashlib.sha256(kept).hexdigest(),
                                        [{"a": a, "b": z} for a, z in gone], kept if with_text else None)):
                    col.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(),
                     pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, k) for c, k in zip(out, kinds)]], names=names)

    return (own.join(marks, "row", "left").select("doc_id", "text", "marks")
            .mapInArrow(remove, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, "
                        "kept_sha256 string, spans array<struct<a:long,b:long>>, kept binary"))
