"""Session helpers: test sessions and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "panelwright") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "12g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session, used for checkpoints and staged tables.

    ``spark.checkpoint.dir`` wins. Only a local session without one gets a temporary folder: on a
    cluster a machine-local folder is lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="panelwright-"))
    return context.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


class Staging:
    """Frames written once to the shared folder and read back from there; removed on exit.

    Cuts lineage and survives lost executors. Parquet, not row checkpoints: later reads take only the columns
    they need, and Spark knows the sizes.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = shared_path(spark, "staged")

    def __enter__(self) -> Staging:
        return self

    def put(self, df: DataFrame) -> DataFrame:
        target = f"{self.path}/{uuid.uuid4().hex}"
        df.write.parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def put_all(self, frames: Sequence[DataFrame]) -> list[DataFrame]:
        """Several frames at once: their jobs share the cluster."""
        if len(frames) < 2:
            return [self.put(f) for f in frames]
        with ThreadPoolExecutor(len(frames)) as pool:
            return list(pool.map(inheritable_thread_target(self.spark)(self.put), frames))

    def __exit__(self, *_error) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers; once per application.

    Needed where it was not installed on the cluster or passed with ``--py-files``.
    """
    context = spark.sparkContext
    if getattr(context, "_panelwright_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="panelwright-"), "panelwright")
    shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package))
    context.addPyFile(target + ".zip")
    context._panelwright_shipped = True
