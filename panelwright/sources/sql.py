"""SQL vendor tables: column subset, date range, declared types."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.functions.scalars import conform


def year_predicates(start: date, end: date, column: str = "date") -> list[str]:
    """One SQL predicate per calendar year of the range: the partitions of a JDBC read."""
    spans = [(max(start, date(y, 1, 1)), min(end, date(y, 12, 31))) for y in range(start.year, end.year + 1)]
    return [f"{column} BETWEEN DATE '{a}' AND DATE '{b}'" for a, b in spans]


def read_range(
    spark: SparkSession,
    source: str | Mapping[str, str] | DataFrame,
    schema: T.StructType,
    start: date,
    end: date,
    where: Column | None = None,
) -> DataFrame:
    """Rows with ``date`` from start to end, cast to ``schema``.

    ``source`` is a Parquet path, a frame, or JDBC options with ``url`` and ``dbtable``, read with one
    partition per year. Column choice and predicates reach the scan.
    """
    if isinstance(source, DataFrame):
        frame = source
    elif isinstance(source, str):
        frame = spark.read.parquet(source)
    else:
        options = {k: v for k, v in source.items() if k not in ("url", "dbtable")}
        frame = spark.read.jdbc(
            source["url"], source["dbtable"], predicates=year_predicates(start, end), properties=options
        )
    kept = frame.where(F.col("date").between(F.lit(start), F.lit(end)))
    return conform(kept if where is None else kept.where(where), schema)
