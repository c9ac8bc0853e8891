"""Every query where each task has a Python worker of its own, as after a lost executor: nothing may
be loaded only because an earlier task of the same worker loaded it."""

import pathlib
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parents[2]
SCRIPT = """
from pyspark.sql import SparkSession
from threadloom.session import SETTINGS, drop_stages
from threadloom.llm.queries import QUERIES

builder = SparkSession.builder.master("local[4]").config(map=SETTINGS)
spark = builder.config("spark.python.worker.reuse", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
for name, query in QUERIES.items():
    query(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    print("ran", name, flush=True)
drop_stages(spark)
"""


def test_all_queries_on_fresh_workers():
    from threadloom.llm.queries import QUERIES

    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=ROOT, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    assert [line.split()[1] for line in done.stdout.splitlines() if line.startswith("ran")] == list(QUERIES)
