"""What the operators of this subpackage share: words, output columns, staged tables, size-checked joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.scalars import quoted
from panelwright.session import shared_path, ship_package

#: White space between words: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
#: A join side of more rows than this is shuffled, not broadcast.
BROADCAST_ROWS = 200_000
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text in order; none of a null text."""
    plain = F.translate(F.coalesce(text, F.lit("")), BLANKS[1:], " " * (len(BLANKS) - 1))
    return F.array_remove(F.split(plain, " "), "")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; all other characters stay."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def put(df: DataFrame, name: str, value: Column) -> DataFrame:
    """The frame with an output column; columns of that name, in any case, are replaced."""
    return without(df, name).withColumn(name, value)


def without(df: DataFrame, *names: str) -> DataFrame:
    """The frame without columns of these names, in any case."""
    gone = {n.lower() for n in names}
    clash = [c for c in df.columns if c.lower() in gone]
    return df.drop(*clash) if clash else df


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Just these columns, matched exactly if possible; extra columns, also of clashing names, are left out."""
    columns = []
    for name in names:
        exact = [i for i, c in enumerate(df.columns) if c == name]
        loose = [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
        if not loose:
            raise ValueError(f"no column {name}: {df.columns}")
        columns.append((exact or loose)[0])
    if len({c.lower() for c in df.columns}) == len(df.columns):
        return df.select([quoted(df.columns[i]).alias(n) for i, n in zip(columns, names)])
    placed = df.toDF(*[f"__c{i}" for i in range(len(df.columns))])
    return placed.select([F.col(f"__c{i}").alias(n) for i, n in zip(columns, names)])


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_bounded(df: DataFrame, side: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join with a side that is expected to be small: broadcast only if its counted rows are few, else shuffled.

    Only narrow sides are given here, so the bound is a few MB. In the shuffled form a hot key of ``df`` is split by adaptive execution.
    """
    few = side.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return df.join(F.broadcast(side) if few else side, on, how)


def python_tasks(spark: SparkSession, batch_bytes: int = 16 << 20) -> None:
    """Make the package importable in Python workers and bound the bytes of an Arrow batch."""
    ship_package(spark)
    if int(spark.conf.get(_BATCH_BYTES).rstrip("bB")) > 1 << 30:
        spark.conf.set(_BATCH_BYTES, str(batch_bytes))


class Replaced:
    """A table that is written anew in every step of a loop: each version cuts lineage in the shared folder, and the one before
    it is removed once its successor is complete, so two versions exist at most."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.path = spark, name, None

    def put(self, df: DataFrame) -> DataFrame:
        path = shared_path(self.spark, f"llm-{self.name}")
        df.write.parquet(path)
        if self.path:
            remove(self.spark, self.path)
        self.path = path
        return self.spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table of the shared folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
