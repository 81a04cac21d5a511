"""The driver may load __spark_entry__.py from any working directory."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spec = importlib.util.spec_from_file_location("__spark_entry__", {os.path.join(REPO, '__spark_entry__.py')!r})
E = importlib.util.module_from_spec(spec)
spec.loader.exec_module(E)
assert E.entry(spark).count() > 0
assert set(E.oracle_sql()) <= set(E.queries())
print("signatures", E.queries()["minhash_signatures"](spark, "/root/testdata/sf0.001").count())
"""


def test_entry_loads_from_another_directory():
    cwd = tempfile.mkdtemp(prefix="warband-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                         timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "signatures" in out.stdout
