"""A streaming source of manifest entries, format ``ledgerlake_manifest``.

``path`` is a folder of manifest snapshots (each a new file, in name order) or one
manifest file.  A row is an entry that a snapshot brings or changes against the snapshot
before it; every snapshot is diffed, in order, whether or not a trigger saw it.  Offsets
are places in that sequence, ``{"snapshot": i, "entry": k}``.  A read goes on for one
snapshot at most, and no further than ``maxBytes`` of declared sizes or ``maxFiles`` (one
entry at least), so micro-batches are bounded by what they will read.

Rows are catalog rows: the data files themselves are read by Spark.  ``superseded`` marks
an entry whose day and kind a later snapshot changes again: its file may be gone, and
the later entry stands for it.  A cut-off or invalid snapshot stops the query.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from ledgerlake.sources import fsio

NAME = "ledgerlake_manifest"
ENTRY_DDL = ("snapshot string, chain_id long, seq long, date string, kind string, key string, size long, "
             "md5 string, schema_version string, superseded boolean")
FIELDS = ("date", "kind", "key", "size", "md5", "schema_version")


def load(path: str) -> dict:
    with fsio.open_read(path) as f:
        doc = json.loads(f.read())
    if not isinstance(doc, dict) or not isinstance(doc.get("files", []), list):
        raise ValueError(f"not a manifest: {path}")
    return doc


def winners(doc: dict) -> dict[tuple, tuple]:
    """The entry of each day and kind; the first one listed wins."""
    out: dict[tuple, tuple] = {}
    for e in doc.get("files") or []:
        out.setdefault((e.get("date"), e.get("kind")), tuple(e.get(f) for f in FIELDS))
    return out


class Reader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.max_bytes = int(options.get("maxbytes", options.get("maxBytes", 1 << 62)))
        self.max_files = int(options.get("maxfiles", options.get("maxFiles", 1 << 62)))
        self.kinds = {k for k in options.get("kinds", "").split(",") if k}
        self.seen: dict[str, dict] = {}

    def _snapshots(self) -> list[str]:
        return [self.path] if self.path.endswith(".json") else fsio.list_files(self.path, ".json")

    def _entries(self, path: str) -> dict[tuple, tuple]:
        if path not in self.seen:  # a snapshot never changes
            doc = load(path)
            self.seen[path] = {"entries": winners(doc), "chain": doc.get("chain_id")}
        return self.seen[path]["entries"]

    def _changes(self, paths: list[str], i: int) -> list[tuple]:
        before = self._entries(paths[i - 1]) if i else {}
        now = self._entries(paths[i])
        later = [self._entries(p) for p in paths[i + 1:]]
        out = []
        for seq, (k, e) in enumerate(now.items()):
            if before.get(k) == e or (self.kinds and k[1] not in self.kinds):
                continue
            gone = any(x.get(k, e)[2:5] != e[2:5] for x in later)
            out.append((paths[i].rsplit("/", 1)[-1], self.seen[paths[i]]["chain"], seq, *e, gone))
        return out

    def initialOffset(self) -> dict:
        return {"snapshot": 0, "entry": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        paths, i, k = self._snapshots(), start["snapshot"], start["entry"]
        while i < len(paths):
            todo = self._changes(paths, i)[k:]
            n = size = 0
            for row in todo:
                size += row[6] or 0
                if n and (size > self.max_bytes or n >= self.max_files):
                    break
                n += 1
            if n < len(todo):
                return iter(todo[:n]), {"snapshot": i, "entry": k + n}
            i, k = i + 1, 0
            if todo:
                return iter(todo), {"snapshot": i, "entry": 0}
        return iter(()), {"snapshot": i, "entry": k}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        paths = self._snapshots()
        for i in range(start["snapshot"], min(end["snapshot"] + 1, len(paths))):
            rows = self._changes(paths, i)
            last = end["entry"] if i == end["snapshot"] else len(rows)
            yield from rows[start["entry"] if i == start["snapshot"] else 0:last]


class ManifestSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return ENTRY_DDL

    def simpleStreamReader(self, schema) -> Reader:
        return Reader(self.options)


def entry_stream(spark, path: str, max_bytes: int | None = None, max_files: int | None = None, kinds=()):
    """The stream of entries of ``path``, a snapshot folder or a manifest."""
    spark.dataSource.register(ManifestSource)
    r = spark.readStream.format(NAME).option("path", fsio.qualify(spark, path)).option("kinds", ",".join(kinds))
    for name, value in (("maxBytes", max_bytes), ("maxFiles", max_files)):
        if value is not None:
            r = r.option(name, str(value))
    return r.load()
