"""Session helpers: a configured SparkSession and the shared scratch folder.

The library never picks a machine-local folder on its own when a cluster names
one: every written table goes under ``spark.checkpoint.dir``.  Only when the
session leaves that unset (local tests, the bench) do we create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the results depend on (see README "Spark settings").
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

PERF_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ledgerlake", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings this library assumes.

    The shuffle width is the cluster's unless given: adaptive execution merges
    partitions but never makes more.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(PERF_CONF)
    conf.update(RESULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    conf["spark.driver.memory"] = os.environ.get("LEDGERLAKE_DRIVER_MEMORY", "16g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    ship_package(spark)
    return spark


def apply_result_conf(spark: SparkSession) -> None:
    """Set the runtime options results depend on, on a session we did not build."""
    for k, v in RESULT_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    ship_package(spark)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written tables: ``spark.checkpoint.dir``.

    Read from the session; only when unset (as in tests) do we create a
    folder and register it, so ``DataFrame.checkpoint()`` works too.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        except Exception:  # pragma: no cover - Spark Connect has no context
            d = None
    if not d:
        master = spark.sparkContext.master if hasattr(spark, "sparkContext") else ""
        if not str(master).startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="ledgerlake-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # static conf on some builds
            pass
    try:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(d)
    except Exception:  # pragma: no cover
        pass
    from ledgerlake.sources import fsio
    return fsio.qualify(spark, d)


def scratch_path(spark: SparkSession, name: str, unique: bool = False) -> str:
    """A path under the shared scratch root; ``unique`` adds a fresh suffix."""
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if unique else name
    return f"{scratch_root(spark)}/{leaf}"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of a frame made and run in this block go when its run ends.

    Else they stay until the driver's next garbage collection, which may be never.  For
    frames that run once: a second run would shuffle again.
    """
    old = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, old)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``ledgerlake`` importable in Python workers on every executor.

    Functions run by ``mapInPandas`` import this package on the worker; a
    worker started elsewhere than the repository has no path to it.  The
    package's ``.py`` files are zipped into the shared scratch folder and
    registered with ``addPyFile`` once per application.
    """
    import hashlib
    import io
    import zipfile

    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # noqa: BLE001 - Spark Connect: ship with addArtifacts instead
        return
    if app in _SHIPPED:
        return
    import ledgerlake
    pkg = os.path.dirname(os.path.abspath(ledgerlake.__file__))
    base = os.path.dirname(pkg)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, names in sorted(os.walk(pkg)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(dirpath, name)
                    z.write(full, os.path.relpath(full, base))
    body = buf.getvalue()
    path = f"{scratch_root(spark)}/pyfiles/ledgerlake-{hashlib.md5(body).hexdigest()[:12]}.zip"
    from ledgerlake.sources import fsio
    if fsio.size_of(path) != len(body):
        tmp = f"{path}.tmp-{uuid.uuid4().hex[:8]}"
        with fsio.open_write(tmp) as out:
            out.write(body)
        fsio.rename(tmp, path)
    sc.addPyFile(path)
    _SHIPPED.add(app)
