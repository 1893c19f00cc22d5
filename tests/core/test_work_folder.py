import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
from pyspark.sql import SparkSession
from lectern.sources import writers
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://" + sys.argv[1]).getOrCreate()
at = writers.work_folder(spark, "x")
spark.range(3).write.parquet(at)
assert spark.read.parquet(at).count() == 3 and at.startswith("file://" + sys.argv[1])
"""


def test_what_a_driver_wrote_goes_when_it_ends(tmp_path):
    root = Path(__file__).resolve().parent.parent.parent
    subprocess.run([sys.executable, "-c", SCRIPT, str(tmp_path)], cwd=root, check=True, timeout=300, capture_output=True)
    assert not list(tmp_path.rglob("*lectern*")) and not list(tmp_path.rglob("*.parquet"))
