"""Best-fit-decreasing packing of token sequences (operator 8).

Texts are encoded with a public tokenizer; documents longer than the window
are cut into full windows first, and what remains is packed best-fit
decreasing: pieces from long to short, each into the open window with the least
room that still takes it.  A segment tree over remaining capacities finds that
window in O(log window).

Packing needs no global order to be tight: a few thousand windows packed
together waste next to nothing.  So each task packs its own rows in groups of
``group_tokens`` tokens (a bound on memory, not on data: every token of every
row is packed) and no row is shuffled, whatever its source.  A group's last
windows, when less than ``min_fill`` full, are cut into sequences of power-of-two
length, which need no padding.  A recomputed task repeats its own ids, since
they depend on its partition number and its rows only.

Encoding is cached by white-space-separated chunk, exact because the
tokenizer's splitting never looks across white space; texts holding anything
but Latin letters and plain punctuation in a chunk take the tokenizer itself.

Defined results: null text counts as empty and gives one token, the end id; a
null ``doc_id`` stays null; repeated rows are packed each on their own; an empty
table gives no rows; columns other than the two named are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECES = ("doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")

_CHUNK = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)")
_CACHE_ENTRIES, _KEPT_ENTRIES = 400_000, 100_000
_ENCODERS: dict = {}


class ChunkEncoder:
    """Texts to ids as little-endian bytes, chunk by chunk; known chunks are kept."""

    def __init__(self, path: str):
        self.chunks: dict[str, bytes] = {"": b""}
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        suffix = self.tokenizer.model.end_of_word_suffix
        self.last = None
        if suffix:
            vocab = self.tokenizer.get_vocab()
            self.last = np.zeros(max(vocab.values()) + 1, bool)
            self.last[[i for t, i in vocab.items() if t.endswith(suffix)]] = True

    def _ids(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        """Ids of many parts from one text, cut behind the tokens that end a word.

        A part gives one end of word at least, so if there are as many as parts, each
        gave one; else they are encoded one by one.
        """
        ids = np.array(self.tokenizer.encode(" ".join(words), add_special_tokens=False).ids, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1 if self.last is not None else []
        if len(ends) == len(words) and ends[-1] == len(ids):
            raw = ids.tobytes()
            a = 0
            for word, b in zip(words, (4 * ends).tolist()):
                self.chunks[word] = raw[a:b]
                a = b
        else:
            self.chunks.update((w, self._ids(w)) for w in words)

    def _add(self, new: set[str]) -> None:
        chunks, split = self.chunks, []
        for chunk in new:
            if chunk.isascii() and chunk.isalpha():
                split.append((chunk, chunk.lower(), ""))
            elif m := _CHUNK.fullmatch(chunk):
                split.append((chunk, m[1].lower(), m[2]))
            else:
                chunks[chunk] = self._ids(chunk)
        words = [word for word in {word for _, word, _ in split} if word not in chunks]
        if len(words) > 1:
            self._learn(words)
        for chunk, word, tail in split:
            for part in (word, tail):
                if part not in chunks:
                    chunks[part] = self._ids(part)
            chunks[chunk] = chunks[word] + chunks[tail] if tail else chunks[word]

    def trim(self, limit: int | None = None) -> None:
        """Called between texts and at a task's end: the cache stays under a fixed size.

        What came first stays: frequent chunks come early.
        """
        if len(self.chunks) > (_CACHE_ENTRIES if limit is None else limit):
            self.chunks = dict(islice(self.chunks.items(), _KEPT_ENTRIES))

    def encode(self, text: str) -> bytes:
        chunks = text.replace("\n", " ").split(" ")
        ids = list(map(self.chunks.get, chunks))
        if None in ids:
            new = [i for i, b in enumerate(ids) if b is None]
            self._add({chunks[i] for i in new})
            for i in new:
                ids[i] = self.chunks[chunks[i]]
        return b"".join(ids)


def chunk_encoder(path: str) -> ChunkEncoder:
    """One per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


class RoomTree:
    """Segment tree over capacities 0..window: open windows by room left."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, room: int, by: int) -> None:
        i = room + self.size
        while i:
            self.count[i] += by
            i >>= 1

    def put(self, room: int, window_id: int) -> None:
        self.open[room].append(window_id)
        self._add(room, 1)

    def tightest(self, need: int) -> int | None:
        """The least room of ``need`` or more that an open window has."""
        i = need + self.size
        if self.count[i]:
            return need
        while i > 1:
            if not i & 1 and self.count[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None

    def take(self, room: int) -> int:
        self._add(room, -1)
        return self.open[room].pop()


def best_fit_decreasing(lengths: list[int], window: int) -> list[list[int]]:
    """Piece numbers of each window; every length is 1..window."""
    tree, bins = RoomTree(window), []
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        room = tree.tightest(lengths[k])
        if room is None:
            room, b = window, len(bins)
            bins.append([])
        else:
            b = tree.take(room)
        bins[b].append(k)
        if room > lengths[k]:
            tree.put(room - lengths[k], b)
    return bins


def pack_group(docs: list[tuple[int, int]], window: int, min_fill: float):
    """Sequences of one group: lists of (doc, start, length).

    ``docs`` has (number, tokens).  Full windows first, then the remainders
    best-fit decreasing, then thin windows cut to powers of two.
    """
    rest = []
    for d, n in docs:
        full = n - n % window
        for start in range(0, full, window):
            yield [(d, start, window)]
        if n > full:
            rest.append((d, full, n - full))
    for bin_ in best_fit_decreasing([r[2] for r in rest], window):
        pieces = [rest[k] for k in bin_]
        fill = sum(p[2] for p in pieces)
        if fill >= min_fill * window or fill & (fill - 1) == 0:
            yield pieces
        else:
            yield from cut_to_powers(pieces, fill)


def cut_to_powers(pieces, fill: int):
    """The pieces in order, cut into sequences of the lengths of ``fill``'s bits."""
    pieces = list(pieces)[::-1]
    for bit in range(fill.bit_length() - 1, -1, -1):
        room = fill & (1 << bit)
        out = []
        while room:
            d, start, n = pieces.pop()
            out.append((d, start, min(n, room)))
            if n > room:
                pieces.append((d, start + room, n - room))
            room -= out[-1][2]
        if out:
            yield out


def pack(df: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
         window: int = 2048, end_id: int = 1, group_tokens: int = 1_000_000,
         min_fill: float = 0.97, with_ids: bool = False) -> DataFrame:
    """One row per piece: where its ids stand in the document and the sequence.

    Columns of ``PIECES``; ``with_ids`` adds ``ids`` (array of int), the tokens
    themselves, for a writer of training shards.
    """
    from pyspark import TaskContext

    kind = df.select(doc_id).schema[0].dataType
    schema = PIECES.format(id=kind.simpleString()) + (", ids array<int>" if with_ids else "")
    own = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = chunk_encoder(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 36
        ids: list = []
        docs: list[bytes] = []
        held = 0

        def flush():
            nonlocal sequence, ids, docs, held
            rows = []
            sizes = [(k, len(b) // 4) for k, b in enumerate(docs)]
            for pieces in pack_group(sizes, window, min_fill):
                at = 0
                for d, start, n in pieces:
                    own = docs[d][4 * start:4 * (start + n)]
                    rows.append((d, start, n, zlib.crc32(own), len(docs[d]) // 4, sequence, at)
                                + ((np.frombuffer(own, "<i4"),) if with_ids else ()))
                    at += n
                sequence += 1
            cols = list(zip(*rows))
            out = [pa.concat_arrays(ids).take(pa.array(cols[0], pa.int64()))]
            out += [pa.array(c, pa.int64()) for c in cols[1:7]]
            if with_ids:
                out.append(pa.array(list(cols[7]), pa.list_(pa.int32())))
            ids, docs, held = [], [], 0
            return pa.RecordBatch.from_arrays(out, names=names)

        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        names += ["ids"] * with_ids
        for batch in batches:
            start = 0
            for k, t in enumerate(batch.column(1)):
                b = enc.encode(t.as_py() or "") + end
                docs.append(b)
                held += len(b) // 4
                enc.trim()
                if held >= group_tokens:
                    ids.append(batch.column(0).slice(start, k + 1 - start))
                    start = k + 1
                    yield flush()
            ids.append(batch.column(0).slice(start))
        enc.trim(_KEPT_ENTRIES)  # the worker process lives on
        if docs:
            yield flush()

    return own.mapInArrow(run, schema)
