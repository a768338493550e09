"""Frame-level cleaning steps and guards."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.functions.scalars import quoted
from panelwright.specs import END_OF_FILE


def rename_known(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns the map knows; names absent from the frame are ignored."""
    return df.withColumnsRenamed(dict(names))


def rename_all(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename, and fail if the frame lacks one of the names."""
    require_columns(df, names)
    return df.withColumnsRenamed(dict(names))


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the frame has {df.columns}")


def drop_trailer(df: DataFrame, column: str, marker: str = END_OF_FILE) -> DataFrame:
    """Drop the end-of-file line; a null in the column drops the row too.

    Run it before dates are parsed: the trailer holds no date and strict parsing would fail on it.
    """
    return df.where(quoted(column) != F.lit(marker))


def keep_members(df: DataFrame, ids: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``ids``: a semi join, never a collected list."""
    on = [on] if isinstance(on, str) else list(on)
    return df.join(ids.select(*on), on, "left_semi")


def at_latest(df: DataFrame, column: str) -> DataFrame:
    """Rows at the greatest value of the column, by scalar subquery (pruned to one column)."""
    return df.where(quoted(column) == df.agg(F.max(quoted(column))).scalar())


def add_missing_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Append the columns of ``schema`` the frame lacks, as typed nulls."""
    have = set(df.columns)
    extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in have]
    return df.select("*", *extra) if extra else df


def must_hold(condition: Column, message: str, value: Column) -> Column:
    """``value`` where the condition holds; the job fails with ``message`` elsewhere."""
    return F.when(condition, value).otherwise(F.raise_error(F.lit(message)))


def single_value(value: Column, message: str) -> Column:
    """Aggregate for a group that must have one row; fails on a second."""
    return F.when(F.count(F.lit(1)) <= 1, F.first(value)).otherwise(F.raise_error(F.lit(message)))


def check_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Fail now if a key repeats. One aggregation; copies are counted map-side."""
    repeated = df.groupBy(*keys).count().where("count > 1").limit(1)
    if not repeated.isEmpty():
        raise ValueError(f"repeated key {list(keys)}")


def distinct_sorted(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct().orderBy(*columns)
