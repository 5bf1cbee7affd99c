"""Python workers find the package when the job starts from another folder."""

import os
import subprocess
import sys

from conftest import ROOT

JOB = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
from clickflow.session import workers_find_package

def uses_package(batches):
    from clickflow.streaming import state
    for b in batches:
        yield b.assign(id=len(state.NUMBER_COL))

workers_find_package(spark)
print("SUM", spark.range(5).mapInPandas(uses_package, "id long").groupBy().sum("id").first()[0])
"""


def test_workers_import_the_package_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", JOB, ROOT], cwd=tmp_path, env=env, timeout=200,
                         capture_output=True, text=True)
    assert "SUM 10" in out.stdout, out.stderr[-2000:]
