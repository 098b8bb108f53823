"""Python workers import the package even when the job does not start in
the repository (as on a cluster): the package is shipped with addPyFile."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_workers_import_package_outside_repo(tmp_path):
    code = textwrap.dedent(f"""
        import sys, tempfile
        sys.path.insert(0, {REPO!r})
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]")
                 .config("spark.ui.enabled", "false")
                 .config("spark.checkpoint.dir", {str(tmp_path / 'ckpt')!r})
                 .getOrCreate())
        from ledgerlake.sources import fixtures as fx
        from ledgerlake.sources.writer import write_days
        rows = write_days(fx.raw(spark, "/root/testdata/sf0.001", "blocks"),
                          tempfile.mkdtemp(), "blocks").count()
        print("ROWS", rows)
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd="/", env=env,
                         capture_output=True, text=True, timeout=600)
    assert "ROWS" in out.stdout, out.stderr[-2000:]
    assert int(out.stdout.split("ROWS")[1].split()[0]) > 0
