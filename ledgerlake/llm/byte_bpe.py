"""Byte-level BPE encoding and decoding by a global distinct-word shuffle (operator 11).

Every text is split into pre-tokens by the vocabulary's pattern, and each distinct
pre-token of the corpus is merged into ids once:

1. a map gathers the distinct pre-tokens of a block of texts (``BLOCK_TEXT`` characters,
   one text at least), numbers them by frequency there and writes every text as
   the sequence of these numbers: its exploded pre-tokens in position order;
2. the blocks' words are shuffled by a hash of the word, unpacked and sorted; each run
   of one word is encoded once, and its ids go to all blocks that asked for it;
3. ids go back to their block, where sequences of numbers become ids by position.

A word is sent once a block however often it occurs, so the hottest word has one
row a block and no partition of the word shuffle is hot.  Words, numbers and ids travel
packed, many to a row.  Texts are never shuffled, nor are sequences: their table is
bucketed by block, so only ids move to it.  A task holds one block at a time; runs are
sorted by Spark, which spills.

Decoding joins ids with the token-byte table.  That table has one row a vocabulary
entry, a bound known before any data is read, so every task holds it and joins
by gathering.

Defined results: null text counts as empty; empty text gives no ids and decodes to no
bytes; a text longer than a block is a block of its own; repeated rows and null
ids are encoded each on their own; an empty table gives no rows; columns
other than the two named are ignored, whatever their names.  An id outside the
table, or a null among the ids, decodes to no bytes; null ``ids`` decode to null.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from ledgerlake.llm.tables import Tables

BLOCK_TEXT = 32 << 20
#: Blocks of one partition are numbered in so many bits.
BLOCK_BITS = 24
#: Parts of a block's words for each shuffle partition.
BUCKETS = 2
#: Pre-tokens turned into ids at a time.
GATHER = 1 << 18
_LOADED: dict = {}


def _vocabulary(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def word_encoder(path: str):
    """Encoder of one pre-token: its pattern takes any string as one piece."""
    key = ("words", path)
    if key not in _LOADED:
        import tiktoken
        _LOADED[key] = tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=_vocabulary(path),
                                         special_tokens={})
    return _LOADED[key]


def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The token-byte table: all bytes, and each id's place among them."""
    key = ("bytes", path)
    if key not in _LOADED:
        by_id = {i: b for b, i in _vocabulary(path).items()}
        size = max(by_id) + 1
        off = np.zeros(size + 1, np.int64)
        np.cumsum([len(by_id.get(i, b"")) for i in range(size)], out=off[1:])
        _LOADED[key] = np.frombuffer(b"".join(by_id.get(i, b"") for i in range(size)), np.uint8), off
    return _LOADED[key]


def gather(values: np.ndarray, start: np.ndarray, size: np.ndarray,
           which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs ``values[start[w]:start[w] + size[w]]`` one after the other, and their lengths."""
    n = size[which]
    total = np.cumsum(n)
    at = np.arange(total[-1] if len(total) else 0) + np.repeat(start[which] - total + n, n)
    return values[at], n


# Number code: a lead byte each, then the tails of those that need one, by length.
_ONE = 192
_TWO = _ONE + 60 * 256
_THREE = _TWO + 3 * 65536


def squeeze(numbers: np.ndarray) -> bytes:
    """uint32 numbers as bytes, small ones in one, compressed."""
    import zstandard
    x = numbers.astype(np.uint32)
    lead = np.minimum(x, _ONE - 1).astype(np.uint8)
    two, three, five = (x >= _ONE) & (x < _TWO), (x >= _TWO) & (x < _THREE), x >= _THREE
    a, b = x[two] - np.uint32(_ONE), x[three] - np.uint32(_TWO)
    lead[two], lead[three], lead[five] = _ONE + (a >> 8), 252 + (b >> 16), 255
    tails = (a & 255).astype(np.uint8), (b >> 8 & 255).astype(np.uint8), (b & 255).astype(np.uint8), x[five].astype("<u4")
    return zstandard.ZstdCompressor(1).compress(b"".join(t.tobytes() for t in (lead, *tails)))


def expand(data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of ``squeeze``."""
    import zstandard
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    lead = raw[:n]
    x = lead.astype(np.uint32)
    two, three, five = (lead >= _ONE) & (lead < 252), (lead >= 252) & (lead < 255), lead == 255
    n2, n3 = int(two.sum()), int(three.sum())
    tail = raw[n:].astype(np.uint32)
    x[two] = ((x[two] - _ONE) << 8) + tail[:n2] + _ONE
    x[three] = ((x[three] - 252) << 16) + (tail[n2:n2 + n3] << 8) + tail[n2 + n3:n2 + 2 * n3] + _TWO
    x[five] = raw[n + n2 + 2 * n3:].view("<u4") if five.any() else 0
    return x


def _record(schema: pa.Schema, *cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


class _Block:
    """Texts of one block: numbers of their pre-tokens as they come, and the words."""

    def __init__(self):
        self.words: dict[str, int] = defaultdict()
        self.words.default_factory = self.words.__len__
        self.ids: list[pa.Array] = []
        self.seqs: list[np.ndarray] = []
        self.size = 0

    def add(self, text: str, found: list[str]) -> None:
        self.seqs.append(np.fromiter(map(self.words.__getitem__, found), np.uint32, len(found)))
        self.size += len(text)

    def rows(self, block: int, buckets: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """Texts as ranks, words by bucket, and the ranks of the words in that order."""
        total = np.zeros(len(self.words), np.int64)
        for s in self.seqs:
            np.add.at(total, s, 1)
        rank = np.empty(len(total), np.uint32)
        rank[np.argsort(-total, kind="stable")] = np.arange(len(total))
        no_id, start = pa.nulls(1, schema.field("doc_id").type), 0
        for ids in self.ids:
            for at in range(0, len(ids), 1000):
                own = self.seqs[start + at:start + min(at + 1000, len(ids))]
                n = [None] * len(own)
                yield _record(schema, [block] * len(own), n, n, ids.slice(at, 1000), [len(s) for s in own],
                              [squeeze(rank[s]) for s in own], n)
            start += len(ids)
        self.seqs.clear()
        words = sorted(self.words)
        came = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        self.words.clear()
        bucket = np.fromiter((zlib.crc32(w.encode()) % buckets for w in words), np.int64, len(words))
        order = np.argsort(bucket, kind="stable")
        edge = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
        for k, (a, b) in enumerate(zip(edge, edge[1:])):
            if a < b:
                yield _record(schema, [block], [k], [a], no_id, [b - a], [None], [[words[j] for j in order[a:b]]])
        yield _record(schema, [block], [None], [0], no_id, [len(words)], [squeeze(rank[came[order]])], [None])


def _number(pattern: str, limit: int, buckets: int, schema: pa.Schema):
    """Map of texts to sequences of word numbers, and the words by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        from pyspark import TaskContext
        find = regex.compile(pattern).findall
        number, block = TaskContext.get().partitionId() << BLOCK_BITS, _Block()
        for batch in batches:
            start = 0
            for k, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                block.add(text, find(text))
                if block.size >= limit:
                    block.ids.append(batch.column(0).slice(start, k + 1 - start))
                    yield from block.rows(number, buckets, schema)
                    number, block, start = number + 1, _Block(), k + 1
            if start < batch.num_rows:
                block.ids.append(batch.column(0).slice(start))
        if block.ids:
            yield from block.rows(number, buckets, schema)
    return run


def _encode_runs(vocabulary: str, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(vocabulary).encode_ordinary
        last, found = None, b""
        for batch in batches:
            out = []
            for word in batch.column(0).to_pylist():
                if word != last:
                    last, found = word, np.array(encode(word), "<u4").tobytes()
                out.append(found)
            yield _record(schema, batch.column(1), batch.column(2), out)
    return run


def _pack(schema: pa.Schema):
    """Rows sorted by block and slot; runs of slots within a batch become one row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks, slots = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            ids = batch.column(2).to_pylist()
            breaks = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(slots) != 1)) + 1
            edges = [0, *breaks.tolist(), len(ids)] if ids else []
            for a, b in zip(edges, edges[1:]):
                raw = np.frombuffer(b"".join(ids[a:b]), "<u4")
                sizes = np.array([len(x) // 4 for x in ids[a:b]], np.uint32)
                yield _record(schema, [blocks[a]], [slots[a]], [b - a], [squeeze(sizes)], [squeeze(raw)])
    return run


def _assemble(schema: pa.Schema):
    """A block's ids by slot, the ranks of the slots and texts as ranks to the texts' ids."""
    def run(words: pa.Table, docs: pa.Table) -> pa.Table:
        slot = docs.column("slot")
        [[of, data]] = zip(*(docs.filter(slot.is_valid()).column(c).to_pylist() for c in ("n", "data")))
        docs = docs.filter(slot.is_null())
        start, length = np.zeros(of, np.int64), np.zeros(of, np.int64)
        ranks, values, held = expand(data, of), [np.zeros(0, np.uint32)], 0
        for at, n, size, ids in zip(*(words.column(c).to_pylist() for c in ("slot", "n", "sizes", "ids"))):
            size = expand(size, n).astype(np.int64)
            edge = np.cumsum(size)
            mine = ranks[at:at + n]
            start[mine], length[mine] = held + edge - size, size
            values.append(expand(ids, int(edge[-1])))
            held += len(values[-1])
        values = np.concatenate(values).astype(np.int32)
        ids, counts, seqs = (docs.column(c) for c in ("doc_id", "n", "data"))
        counts, total = counts.to_numpy(), np.cumsum(counts.to_numpy())
        parts, a = [schema.empty_table()], 0
        while a < len(counts):
            # About GATHER pre-tokens at a time, one text at least.
            before = total[a] - counts[a]
            b = max(a + 1, int(np.searchsorted(total, before + GATHER, "right")))
            which = np.concatenate([expand(s.as_py(), n) for s, n in zip(seqs.slice(a, b - a), counts[a:b])])
            got, n = gather(values, start, length, which)
            edge = np.zeros(len(n) + 1, np.int64)
            np.cumsum(n, out=edge[1:])
            bounds = edge[np.concatenate([[0], total[a:b] - before])]
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(got))
            parts.append(pa.Table.from_arrays(
                [ids.slice(a, b - a).combine_chunks(), pa.array(np.diff(bounds), pa.int64()), lists], schema=schema))
            a = b
        return pa.concat_tables(parts)
    return run


def encode(df: DataFrame, vocabulary: str, pattern: str, doc_id: str = "doc_id", text: str = "text",
           block_text: int = BLOCK_TEXT) -> DataFrame:
    """Rows (doc_id, n_tokens, ids): every text's ids under ``vocabulary``.

    ``vocabulary`` is a file of base64 tokens and ranks that every worker can
    read, ``pattern`` the pre-token pattern in the syntax of ``regex``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = df.sparkSession
    own = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = own.schema[0].dataType.simpleString()
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ddl = {"numbered": f"block long, bucket long, slot long, doc_id {kind}, n long, data binary, words array<string>",
           "run": "block long, slot long, ids binary",
           "packed": "block long, slot long, n long, sizes binary, ids binary",
           "result": f"doc_id {kind}, n_tokens long, ids array<int>"}
    arrow = {k: to_arrow_schema(spark.createDataFrame([], s).schema) for k, s in ddl.items()}
    blocks = Tables(spark, "byte-bpe").bucketed(
        own.mapInArrow(_number(pattern, block_text, BUCKETS * width, arrow["numbered"]), ddl["numbered"]),
        width, "block", batch_rows=2000)
    asked = blocks.where("bucket is not null").select("bucket", "block", "slot", "words").repartition(width, "bucket")
    place = asked.select("block", "slot", F.posexplode("words").alias("k", "word"))
    found = (place.select("word", "block", (F.col("slot") + F.col("k")).alias("slot"))
             .sortWithinPartitions("word").mapInArrow(_encode_runs(vocabulary, arrow["run"]), ddl["run"])
             .sortWithinPartitions("block", "slot").mapInArrow(_pack(arrow["packed"]), ddl["packed"]))
    docs = blocks.where("bucket is null").select("block", "slot", "doc_id", "n", "data")
    return (found.groupBy("block").cogroup(docs.groupBy("block"))
            .applyInArrow(_assemble(arrow["result"]), ddl["result"]))


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``df`` with the bytes of its ``ids`` as binary column ``to``, which must be new."""
    if to.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"column {to} is there already")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, off = token_bytes(vocabulary)
        off, size = off[:-1], np.diff(off)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part, out = batch.slice(at, 1000), []
                for row in part.column(names.index(ids)):
                    if not row.is_valid:
                        out.append(None)
                        continue
                    which = row.values.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
                    which = which[(which >= 0) & (which < len(size))]
                    out.append(gather(values, off, size, which)[0].tobytes())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], [*names, to])

    names = df.columns
    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(to, BinaryType())]))
