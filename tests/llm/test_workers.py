"""The queries from a folder of their own, without the package on any path of the workers."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
from furlong.llm.bindings import QUERIES
for name, query in QUERIES.items():
    try:
        print("rows", name, query(spark, sys.argv[2]).count(), flush=True)
    except Exception as problem:
        print("failed", name, str(problem)[-500:], flush=True)
"""


def test_workers_need_no_installed_copy(sf_dir, folder):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT, REPO, sf_dir], cwd=folder, env=env, capture_output=True, text=True, timeout=900)
    lines = [line.split(" ", 2) for line in done.stdout.splitlines() if line.startswith(("rows", "failed"))]
    assert not [line for line in lines if line[0] == "failed"], done.stdout
    assert len({name for _, name, _ in lines}) == 13 and all(int(n) > 0 for _, _, n in lines)
