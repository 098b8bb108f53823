"""File access for code that runs inside tasks (hashing, copying, footers).

Paths are full URIs, as :func:`qualify` makes them on the driver from the session's
Hadoop settings, so a path without a scheme means the same file system in a task as in
Spark.  ``file:`` URIs use the OS; any other goes through ``pyarrow.fs`` (HDFS, S3,
GCS, ABFS where pyarrow has them).  An absolute path without a scheme is taken for a
local one only here, by code that names local files on purpose; a relative one
is refused.
"""

from __future__ import annotations

import os
import re

CHUNK = 1 << 20  # 1 MiB hashing and copy chunks
_SCHEME = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]*):")


def qualify(spark, path: str) -> str:
    """``path`` as a full URI of the file system that Spark would use for it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(p).toString().rstrip("/")


def _split(path: str):
    scheme = _SCHEME.match(path)
    if scheme is None:
        if not path.startswith("/"):
            raise ValueError(f"relative path: {path}")
        return None, path
    if scheme[1] == "file":
        p = path[len("file:"):]
        while p.startswith("//"):
            p = p[1:]
        return None, p
    import pyarrow.fs as pafs
    # Hadoop's S3 connectors name the scheme s3a / s3n; pyarrow knows it as s3.
    if scheme[1] in HADOOP_S3:
        path = f"s3:{path[scheme.end():]}"
    fs, p = pafs.FileSystem.from_uri(path)
    return fs, p


# Hadoop scheme names for S3.
HADOOP_S3 = ("s3a", "s3n")


def size_of(path: str) -> int | None:
    """Bytes of a file, or None when it does not exist."""
    fs, p = _split(path)
    if fs is None:
        return os.path.getsize(p) if os.path.isfile(p) else None
    import pyarrow.fs as pafs
    info = fs.get_file_info(p)
    return info.size if info.type == pafs.FileType.File else None


def stat(path: str) -> tuple[int, int] | None:
    """(bytes, time of change in ns) of a file, or None when it does not exist."""
    fs, p = _split(path)
    if fs is None:
        if not os.path.isfile(p):
            return None
        st = os.stat(p)
        return st.st_size, st.st_mtime_ns
    import pyarrow.fs as pafs
    info = fs.get_file_info(p)
    return (info.size, info.mtime_ns or 0) if info.type == pafs.FileType.File else None


def list_files(folder: str, suffix: str = "") -> list[str]:
    """Paths of the visible files in a folder, in name order; none if it is not there."""
    fs, p = _split(folder)
    if fs is None:
        names = [e.name for e in os.scandir(p) if e.is_file()] if os.path.isdir(p) else []
    else:
        import pyarrow.fs as pafs
        found = fs.get_file_info(pafs.FileSelector(p, allow_not_found=True))
        names = [i.base_name for i in found if i.type == pafs.FileType.File]
    return [f"{folder.rstrip('/')}/{n}" for n in sorted(names) if n[0] not in "._" and n.endswith(suffix)]


def open_read(path: str):
    fs, p = _split(path)
    return open(p, "rb") if fs is None else fs.open_input_stream(p)


def open_random(path: str):
    """A file to read from anywhere, as footers are."""
    fs, p = _split(path)
    return open(p, "rb") if fs is None else fs.open_input_file(p)


def read_range(path: str, start: int, length: int):
    """The bytes ``start .. start + length`` of a file, in pieces of at most 1 MiB."""
    with open_random(path) as f:
        f.seek(start)
        while length > 0:
            b = f.read(min(CHUNK, length))
            if not b:
                return
            yield b
            length -= len(b)


def open_write(path: str):
    fs, p = _split(path)
    if fs is None:
        os.makedirs(os.path.dirname(p) or ".", exist_ok=True)
        return open(p, "wb")
    fs.create_dir(os.path.dirname(p), recursive=True)
    return fs.open_output_stream(p)


def rename(src: str, dst: str) -> None:
    fs, s = _split(src)
    _, d = _split(dst)
    if fs is None:
        os.replace(s, d)
    else:
        fs.move(s, d)


def remove(path: str) -> None:
    fs, p = _split(path)
    if fs is None:
        if os.path.exists(p):
            os.remove(p)
    else:
        fs.delete_file(p)


def md5_of(path: str, limit: int | None = None) -> tuple[int, str]:
    """(bytes read, md5 hex) of a file, streamed in 1 MiB chunks; stops after
    ``limit`` bytes + 1 so an oversized object is caught without reading it all."""
    import hashlib
    h, n = hashlib.md5(), 0
    with open_read(path) as f:
        while True:
            want = CHUNK if limit is None else min(CHUNK, limit + 1 - n)
            if want <= 0:
                break
            b = f.read(want)
            if not b:
                break
            h.update(b)
            n += len(b)
    return n, h.hexdigest()


def local_path(path: str) -> str:
    return _split(path)[1]


def is_local(root: str) -> bool:
    """A local or mounted path (no scheme, or ``file:``)."""
    scheme = _SCHEME.match(root)
    return scheme is None or scheme[1] == "file"


class driver_listing:
    """Context manager: list files on the driver for a local root.

    Spark lists many paths with a distributed job (above
    ``spark.sql.sources.parallelPartitionDiscovery.threshold``).  On an object
    store that pays off; on a local or mounted disk the job costs more than
    the listing, so the threshold is raised for the duration of the read.
    """

    KEY = "spark.sql.sources.parallelPartitionDiscovery.threshold"

    def __init__(self, spark, root: str, paths: int = 1 << 30):
        self.spark, self.active, self.paths = spark, is_local(root), paths
        self.old = None

    def __enter__(self):
        if self.active:
            self.old = self.spark.conf.get(self.KEY, None)
            self.spark.conf.set(self.KEY, str(max(self.paths + 1, 32)))
        return self

    def __exit__(self, *exc):
        if self.active:
            if self.old is None:
                self.spark.conf.unset(self.KEY)
            else:
                self.spark.conf.set(self.KEY, self.old)
        return False
