"""The Parquet sink: partitions are written without a sort of their rows."""

import json
import subprocess
import sys
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from panelwright.sources import objects

OPEN = "spark.sql.maxConcurrentOutputFileWriters"

# a session of its own: what a sort spills is in the event log, and a sort of over 1,000 rows spills
WRITE = """
import sys
from pyspark.sql import SparkSession
from panelwright.sources.objects import write_parquet
builder = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.driver.memory", "1g")
spark = (
    builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.compress", "false").config("spark.eventLog.dir", sys.argv[1])
    .config("spark.shuffle.spill.numElementsForceSpillThreshold", "1000").getOrCreate()
)
write_parquet(spark.range(0, 60_000, 1, 2).selectExpr("id", "if(id % 10 = 3, null, id % 10) AS label"), sys.argv[2], "label")
spark.stop()
"""


def test_partitions_are_written_without_spilling(spark, tmp_path):
    (tmp_path / "log").mkdir()
    root = str(Path(__file__).resolve().parents[1])
    run = [sys.executable, "-c", WRITE, (tmp_path / "log").as_uri(), str(tmp_path / "out")]
    subprocess.run(run, cwd=root, check=True, timeout=180)
    lines = [line for f in (tmp_path / "log").rglob("*") if f.is_file() for line in f.read_text(errors="ignore").splitlines()]
    ended = [json.loads(line)["Task Metrics"] for line in lines if line.startswith('{"Event":"SparkListenerTaskEnd"')]
    assert sum(t["Output Metrics"]["Records Written"] for t in ended) == 60_000
    assert sum(t["Disk Bytes Spilled"] for t in ended) == 0
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.select("id").distinct().count() == back.count() == 60_000
    assert back.where("NOT label <=> if(id % 10 = 3, null, id % 10)").count() == 0


def test_more_partitions_than_open_files(spark, tmp_path):
    rows = spark.range(0, 20_000, 1, 2).withColumn("p", F.col("id") % (3 * objects.OPEN_FILES))
    objects.write_parquet(rows, f"{tmp_path}/p", "p")
    again = rows.where("p IN (5, 40)").withColumn("id", -F.col("id"))
    objects.write_parquet(again, f"{tmp_path}/p", "p")
    back = spark.read.parquet(f"{tmp_path}/p")
    assert back.selectExpr("abs(id)").distinct().count() == back.count() == 20_000
    assert back.where("p <> abs(id) % 48 OR (id < 0) <> (p IN (5, 40))").count() == 0


def test_setting_of_the_session_comes_back(spark, tmp_path):
    assert spark.conf.get(OPEN) == "0"
    rows = spark.range(1000).withColumn("p", F.col("id") % 5)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        objects.write_parquet(rows.withColumn("x", 1 / (F.col("id") - 3)), f"{tmp_path}/bad", "p")
    assert spark.conf.get(OPEN) == "0"
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: objects.write_parquet(rows, f"{tmp_path}/{i}", "p"), range(8)))
    assert all(spark.read.parquet(f"{tmp_path}/{i}").distinct().count() == 1000 for i in range(8))
    assert spark.conf.get(OPEN) == "0"
    spark.conf.set(OPEN, "3")
    try:
        objects.write_parquet(rows, f"{tmp_path}/own", "p")
        assert spark.conf.get(OPEN) == "3" and spark.read.parquet(f"{tmp_path}/own").distinct().count() == 1000
    finally:
        spark.conf.set(OPEN, "0")
