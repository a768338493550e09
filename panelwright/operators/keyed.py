"""Keyed upserts and updates that never overwrite a stored value with null."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.frames import add_missing_columns, must_hold, require_columns
from panelwright.functions.scalars import quoted

_NEW = "__new_"


def upsert(stored: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows with incoming non-null values put in, plus the rows with unknown keys.

    The result has the columns of ``stored``; other incoming columns are dropped. A null incoming key fails the job.
    """
    return _put(stored, incoming, keys, "full")


def update(stored: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """As ``upsert`` without inserts. An incoming row with a null key matches nothing, so it is left out."""
    return _put(stored, incoming, keys, "left")


def merge_widen(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """As ``upsert``/``update`` (``how`` is left, inner or full), keeping incoming columns unknown to ``stored``.

    A null incoming key fails the job if ``how`` is full, and matches nothing otherwise.
    """
    if how not in ("left", "inner", "full"):
        raise ValueError(f"how must be left, inner or full, not {how!r}")
    return _put(add_missing_columns(stored, incoming.schema), incoming, keys, how)


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest by ``order``, then by the other columns.

    An aggregate, not a ranking window, so copies of one key collapse before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = [*order, *(c for c in rest if c not in order)]
    if not ranked:
        return df.select(*keys).distinct().select(*df.columns)
    best = F.max(F.struct(*[quoted(c) for c in ranked])).alias("__best")
    return df.groupBy(*[quoted(k) for k in keys]).agg(best).select(*_unpacked(df, keys))


def _unpacked(df: DataFrame, keys: Sequence[str]) -> list:
    return [quoted(c) if c in keys else F.col("__best")[c].alias(c) for c in df.columns]


def _put(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    keys = list(keys)
    require_columns(stored, keys)
    require_columns(incoming, keys)
    shared = [c for c in stored.columns if c in incoming.columns and c not in keys]
    checked = incoming
    if how == "full":
        # A null key matches nothing and would be inserted again by every run. The keys themselves stay untouched,
        # so that rows already partitioned by them are not shuffled again.
        known = [quoted(k).isNotNull() for k in keys]
        checked = incoming.where(must_hold(reduce(and_, known), f"null key in {keys}", F.lit(True)))
    same = {k: stored.schema[k].dataType == incoming.schema[k].dataType for k in keys}
    typed = [quoted(k) if same[k] else quoted(k).cast(stored.schema[k].dataType).alias(k) for k in keys]
    fresh = [quoted(c).cast(stored.schema[c].dataType).alias(_NEW + c) for c in shared]
    # by size of compressed files rows may pass for few that do not fit the driver's memory as a broadcast
    joined = stored.join(checked.select(*typed, *fresh).hint("merge"), keys, how)
    return joined.select(
        [F.coalesce(quoted(_NEW + c), quoted(c)).alias(c) if c in shared else quoted(c) for c in stored.columns]
    )
