"""Entries of one huge JSON object, read by many tasks.

A published lookup is a single object of hundreds of MB on one line.  Cutting it at a
guessed separator fails on other spacing, nested objects or commas in strings.  Whether
a byte stands inside a string, and how deep, depends on everything before it, but the
effect of a stretch of text on that state is a small summary:

    (quote parity, depth change if it starts outside a string, the same if inside)

Summaries compose associatively.  So the file is read as text cut at every comma (the
text source splits it by byte ranges anywhere), each split is summarised in parallel, a
prefix scan over the summaries (three numbers a split) gives every split's state at
its start, and a second read joins the pieces between commas of depth 1 to entries.
Entries that run over a split's end come as parts, joined by a group of their own.

Memory is one Arrow batch and the entry under way.  A gzip file is one split, streamed
the same way.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ESCAPED = re.compile(rb"\\.", re.DOTALL)
_QUOTE = ord('"')
_DEPTH = np.zeros(256, np.int64)
_DEPTH[[ord("{"), ord("[")]] = 1
_DEPTH[[ord("}"), ord("]")]] = -1
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\r\n")] = True
_MARK = b"\xef\xbb\xbf"
# Parts of an entry in one split: all of it, its end, its start, neither.
WHOLE, HEAD, TAIL, THROUGH = range(4)

Summary = tuple[int, int, int]
IDENTITY: Summary = (0, 0, 0)


def summarise(text: bytes) -> Summary:
    """What ``text`` does to the state; it must not begin within an escape."""
    raw = np.frombuffer(_ESCAPED.sub(b"  ", text) if b"\\" in text else text, np.uint8)
    inside = np.cumsum(raw == _QUOTE) & 1
    step = _DEPTH[raw]
    within = int(step[inside == 1].sum())
    return int(inside[-1]) if len(raw) else 0, int(step.sum()) - within, within


def compose(first: Summary, then: Summary) -> Summary:
    """The summary of one text after another."""
    p, outside, within = first
    q, a, b = then
    return p ^ q, outside + (b if p else a), within + (a if p else b)


def at_commas(texts: list[bytes], inside: int, depth: int, first: bool) -> tuple[np.ndarray, np.ndarray]:
    """The state (inside a string, depth) after each of the texts.

    Raises where text stands outside the object, but for a byte-order mark at
    the ``first`` of all texts.
    """
    joined = b",".join(texts)
    raw = np.frombuffer(_ESCAPED.sub(b"  ", joined) if b"\\" in joined else joined, np.uint8)
    within = (np.cumsum(raw == _QUOTE) + inside) & 1
    level = np.cumsum(np.where(within == 0, _DEPTH[raw], 0)) + depth
    out = np.flatnonzero((level <= 0) & (within == 0) & ~_SPACE[raw])
    if first and joined.startswith(_MARK):
        out = out[len(_MARK):]
    if len(out) > 1 or (len(out) == 1 and (_DEPTH[raw[out[0]]] != -1 or level[out[0]] < 0)):
        raise ValueError("text outside the JSON object")
    # The state after a text is that of its last byte, which may belong to an earlier one.
    last = np.cumsum([len(t) + 1 for t in texts]) - 2
    within, level = np.r_[inside, within], np.r_[depth, level]
    return within[last + 1], level[last + 1]


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The file cut at every comma, with the split that each piece begins in."""
    return (spark.read.option("lineSep", ",").text(path)
            .select(F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("value")))


def _runs(batches: Iterator[pa.RecordBatch]):
    """(split, pieces) in file order; a task may hold several splits."""
    for batch in batches:
        splits = batch.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(splits)) + 1).tolist(), len(splits)]
        for a, b in zip(edges, edges[1:]):
            if a < b:
                yield int(splits[a]), batch.column(1).slice(a, b - a).to_pylist()


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each split: its summary, how many pieces it has."""
    found: dict[int, tuple[Summary, int]] = {}
    for split, texts in _runs(batches):
        now, n = found.get(split, (IDENTITY, 0))
        found[split] = compose(now, summarise(b",".join(texts))), n + len(texts)
    rows = [(s, *x, n) for s, (x, n) in found.items()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                         ["split", "parity", "outside", "within", "pieces"])


def _parts(starts: dict[int, tuple[int, int]]):
    """Map of pieces to entries and parts of entries, given every split's first state."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, held, begun = None, [], False
        for now, texts in _runs(batches):
            out = []
            first = now != split and now == min(starts)
            if now != split:
                if split is not None:
                    out.append((split, TAIL if begun else THROUGH, b",".join(held) if held else None))
                split, held, begun = now, [], False
                inside, depth = starts[now]
            within, level = at_commas(texts, inside, depth, first)
            inside, depth = int(within[-1]), int(level[-1])
            a = 0
            for b in (np.flatnonzero((within == 0) & (level <= 1)) + 1).tolist():
                held.extend(texts[a:b])
                entry = b",".join(held)
                if level[b - 1] == 0:
                    entry = entry.rstrip(b" \t\r\n").removesuffix(b"}")
                out.append((split, WHOLE if begun else HEAD, entry))
                held, begun, a = [], True, b
            held.extend(texts[a:])
            if out:
                yield _batch(out)
        if split is not None:
            yield _batch([(split, TAIL if begun else THROUGH, b",".join(held) if held else None)])
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    split, part, text = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(split, pa.int64()), pa.array(part, pa.int32()),
                                       pa.array(text, pa.binary())], ["split", "part", "text"])


def object_entries(spark: SparkSession, path: str) -> DataFrame:
    """Texts ``"key": value`` of the entries of the JSON object in ``path``.

    One column, ``entry``; an empty object gives none.  A file that is not one whole
    object (cut off, or more text after it) raises ``ValueError``.
    """
    pieces = _pieces(spark, path)
    rows = pieces.mapInArrow(_summaries, "split long, parity long, outside long, within long, pieces long").collect()
    starts, state, depth = {}, 0, 0
    for r in sorted(rows):  # the prefix scan: three numbers a split
        starts[r["split"]] = (state, depth)
        depth += r["within"] if state else r["outside"]
        state ^= r["parity"]
    if not rows or state or depth:
        raise ValueError(f"lookup file is not a whole JSON object: {path}")
    parts = pieces.mapInArrow(_parts(starts), "split long, part int, text binary")
    # What is open at a split's start belongs to the last split before that began an entry.
    began = {r["split"] for r in parts.where(F.col("part") == TAIL).select("split").collect()}
    owners, now = [], -1
    for split in sorted(starts):
        owners.append((split, now))
        now = split if split in began else now
    broken = (parts.where(F.col("part") != WHOLE)
              .join(F.broadcast(spark.createDataFrame(owners, "split long, owner long")), "split"))
    group = F.when(F.col("part") == TAIL, F.col("split")).otherwise(F.col("owner"))
    joined = (broken.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("split", "text"))).alias("p"))
              .select(F.array_join(F.transform("p", lambda x: x["text"].cast("string")), ",").alias("entry")))
    whole = parts.where(F.col("part") == WHOLE).select(F.col("text").cast("string").alias("entry"))
    entry = F.regexp_replace("entry", r"^\s*\x{FEFF}?\s*\{", "")
    return whole.union(joined).select(entry.alias("entry")).where(F.trim("entry") != "")
