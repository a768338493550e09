"""Forward fill within a key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.scalars import quoted
from panelwright.operators.skew import ROWS_PER_RANGE, carried, range_cuts, with_ranges


def forward_fill(
    df: DataFrame,
    by: str | Sequence[str],
    order: str | Sequence[str],
    columns: Sequence[str],
    rows_per_range: int | None = ROWS_PER_RANGE,
) -> DataFrame:
    """Each null of ``columns`` becomes the last non-null value before it within its key.

    Large keys are filled range by range, each range starting from the last values of the ranges before it; a range ends
    anywhere in the order, also among rows of one time. ``rows_per_range=None`` leaves that out, for tables whose keys bound
    the rows per ``by`` anyway. Rows that are equal in all of ``order`` come in the order of a hash of their content.
    """
    by = [by] if isinstance(by, str) else list(by)
    order = [order] if isinstance(order, str) else list(order)
    running = (Window.unboundedPreceding, Window.currentRow)
    # as a struct the key compares null-safely, so the rows of a null key are parted like any other
    keyed = df.withColumns({"__k": F.struct(*map(quoted, by)), "__h": F.xxhash64(*map(quoted, df.columns))})
    place = F.struct(*map(quoted, order), "__h")
    layout = None if rows_per_range is None else range_cuts(keyed, ["__k"], place, rows_per_range)
    if layout is None:
        window = Window.partitionBy(*map(quoted, by)).orderBy(*map(quoted, order)).rowsBetween(*running)
        return df.withColumns({c: F.last(quoted(c), ignorenulls=True).over(window) for c in columns})

    ranged = with_ranges(keyed, layout, ["__k"], place)
    window = Window.partitionBy("__k", "__g").orderBy(*map(quoted, order), "__h").rowsBetween(*running)
    filled = ranged.withColumns({c: F.last(quoted(c), ignorenulls=True).over(window) for c in columns})
    # a carry has the last value of each column by itself
    closing = (
        ranged.where(F.col("__parted") & reduce(or_, [quoted(c).isNotNull() for c in columns]))
        .groupBy("__k", "__g")
        .agg(*[F.max_by(quoted(c), F.when(quoted(c).isNotNull(), place)).alias(c) for c in columns])
    )
    opening = carried(layout, closing, ["__k"], columns).withColumnsRenamed({c: f"__open_{c}" for c in columns})
    return layout.joined(filled, opening, ["__k", "__g"]).select(
        [F.coalesce(quoted(c), quoted(f"__open_{c}")).alias(c) if c in columns else quoted(c) for c in df.columns]
    )
