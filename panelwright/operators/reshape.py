"""Long to wide panels and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.frames import must_hold
from panelwright.functions.scalars import quoted

_BITS = 63  # columns per bitmap; a long without its sign


def pivot_panel(
    long: DataFrame,
    index: Sequence[str],
    on: str,
    value: str,
    columns: Sequence[str],
    strict: bool = True,
) -> DataFrame:
    """One row per index, one column per name in ``columns``.

    A name that never occurs gives a null column; other names give no column. Strict: a repeated
    (index, name) fails the job, otherwise the greatest value is taken.

    One shuffle: names become positions by a lookup of ``len(columns)`` rows, each position is a
    conditional aggregate, and map-side rows of one index collapse before they move. Repeats show up as a
    row count above the number of bits set.
    """
    spark = long.sparkSession
    columns = list(columns)
    # built from the given names, so as small as they are
    lookup = spark.createDataFrame([(c, i) for i, c in enumerate(columns)], "__name string, __pos int")
    placed = long.join(F.broadcast(lookup), quoted(on) == F.col("__name"), "left").select(
        *map(quoted, index), "__pos", quoted(value).alias("__value")
    )
    cells = [F.max(F.when(F.col("__pos") == i, F.col("__value"))).alias(c) for i, c in enumerate(columns)]
    if not strict:
        return placed.groupBy(*index).agg(*cells)
    maps = [
        F.bit_or(
            F.when(
                (F.col("__pos") >= low) & (F.col("__pos") < low + _BITS),
                F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("__pos") - low),
            ).otherwise(F.lit(0).cast("bigint"))
        )
        for low in range(0, len(columns), _BITS)
    ]
    distinct_names = sum((F.bit_count(m) for m in maps), F.lit(0))
    wide = placed.groupBy(*index).agg(*cells, (F.count("__pos") == distinct_names).alias("__once"))
    message = f"repeated ({', '.join([*index, on])})"
    # a filter, since the check must not go with a column that nobody selects
    checked = wide.where(must_hold(F.col("__once"), message, F.lit(True)))
    return checked.select(*map(quoted, index), *map(quoted, columns))


def unpivot_panel(
    wide: DataFrame,
    index: Sequence[str],
    columns: Sequence[str],
    name: str = "factor",
    value: str = "value",
    keep_null: bool = False,
) -> DataFrame:
    """One row per index and column; null cells are left out unless asked for."""
    long = wide.unpivot([quoted(c) for c in index], [quoted(c) for c in columns], name, value)
    return long if keep_null else long.where(quoted(value).isNotNull())
