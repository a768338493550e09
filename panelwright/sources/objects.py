"""Files on an object store, by path. Credentials and the file system come with the session."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Blanks stay, quotes are doubled inside quotes, an empty text is a pair of quotes and a null is nothing. The reader needs
# another mark for null, since it would take an empty text for one.
_EXACT = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "quote": '"', "escape": '"'}
_READ, _WRITE = {"nullValue": "\u0000", "emptyValue": "", "multiLine": True}, {"nullValue": "", "emptyValue": '""'}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, which reads the data twice."""
    reader = spark.read.options(**_EXACT, **_READ)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV that reads back as it was: blanks at the ends, empty texts, quotes and line breaks are kept."""
    df.write.mode("overwrite").options(**_EXACT, **_WRITE).csv(path)


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``path``, ``length`` and ``modified`` of every file below a folder; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return found.select("path", "length", F.col("modificationTime").alias("modified"))


#: Partitions whose files a task keeps open at once. A task sorts its other rows by partition, which may spill.
OPEN_FILES = 16
#: Bytes of a row group, which an open file holds in memory: 256 MB for all of a task's open files.
ROW_GROUP_BYTES = 16 << 20
#: Rows of a page. Long pages compress better: ids of a matrix come again after each of its rows.
PAGE_ROWS = 1_000_000
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
_lock, _writes = Lock(), Counter()


@contextmanager
def _files_open(spark: SparkSession) -> Iterator[None]:
    """Spark writes files of several partitions at once, without a sort of the rows; a number set by the user stays.

    The setting is the session's, so it stays until the last of the writes that share it is done.
    """
    with _lock:
        ours = _writes[spark] > 0 or spark.conf.get(_OPEN_FILES) == "0"
        if ours:
            _writes[spark] += 1
            spark.conf.set(_OPEN_FILES, str(OPEN_FILES))
    try:
        yield
    finally:
        with _lock:
            if ours:
                _writes[spark] -= 1
                if not _writes[spark]:
                    del _writes[spark]
                    spark.conf.set(_OPEN_FILES, "0")


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Overwrite a folder, or only the partitions that occur in the frame.

    Partitions are written as their rows come: no sort of them all, unless a task has rows of over ``OPEN_FILES``.
    """
    writer = df.write.mode("overwrite").option("compression", "zstd").option("parquet.page.row.count.limit", PAGE_ROWS)
    if not partition_by:
        writer.parquet(path)
        return
    writer = writer.option("parquet.block.size", ROW_GROUP_BYTES).option("partitionOverwriteMode", "dynamic").partitionBy(partition_by)
    with _files_open(df.sparkSession):
        writer.parquet(path)
