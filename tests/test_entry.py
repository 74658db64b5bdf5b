"""The driver contract from a foreign working directory and a plain session."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
import __spark_entry__ as E
assert E.entry(spark).count() > 0
print("ROWS", E.queries()["workbook_scan"](spark, "/root/testdata/sf0.001").count())
"""


def test_pandas_steps_run_from_any_directory(tmp):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp, env=env, capture_output=True,
                         text=True, timeout=600)
    assert "ROWS 1500" in out.stdout, out.stderr[-2000:]
