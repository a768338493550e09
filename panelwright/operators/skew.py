"""Prefix scans over keys of any size, for operators that carry a state along the rows of a key.

A key's rows must be seen in order, so a large key cannot simply be salted. All rows are thought of as one sequence by key and
place, and a sample of it gives cuts about every so many rows. A cut that falls inside a key parts the key there; keys that hold
no cut stay whole, so without large keys nothing is parted. Rows are then dealt by key and range, each range is scanned by
itself, and the state at its start is an exclusive scan over one closing state per range.

A place is a whole order tuple, at last a hash of the row, so rows of one time can be parted as well; any type with
an order will do. The cuts are a small table made before the plan that uses them, so all its parts cut at the same places.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import groupby
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.functions.scalars import quoted

ROWS_PER_RANGE = 2_000_000
#: Sampled rows per range: the ranges then differ by an eighth or so.
SAMPLED_PER_RANGE = 64
#: Cuts up to which the table of cuts is broadcast; there is one cut for every ``rows_per_range`` rows.
BROADCAST_CUTS = 100_000
#: Children of a node of the tree of cuts: a row meets this many cuts per level, not all of its key.
FAN = 16


@dataclass(frozen=True)
class Layout:
    """``by`` and ``__last``, the number of cuts, of the keys that are parted; the number of all cuts; and the levels of a tree of
    the cuts from its root on. A level has ``by``, ``__node`` and ``__fences``, the range starts between the node's children."""

    frame: DataFrame
    total: int
    levels: list[DataFrame]

    def joined(self, df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
        """Left join with a table of one row per key or range of this layout."""
        return df.join(F.broadcast(other) if self.total <= BROADCAST_CUTS else other, list(on), "left")


def range_cuts(rows: DataFrame, by: Sequence[str], place: Column, rows_per_range: int = ROWS_PER_RANGE) -> Layout | None:
    """Cuts of the keys that hold about ``rows_per_range`` rows or more; None if there are none, which leaves the plan as
    simple as it would be without skew.

    One pass counts, and only if there are rows for two ranges another one samples key and place. Exact copies of a
    row have one place and stay together. Rows with a null in a key are left out.
    """
    by = list(by)
    narrow = rows.select(*map(quoted, by), place.alias("__at")).dropna(subset=by)
    total = narrow.count()
    if total < 2 * rows_per_range:
        return None
    share = min(1.0, SAMPLED_PER_RANGE / rows_per_range)
    apart = max(1, round(rows_per_range * share))
    rank = F.row_number().over(Window.partitionBy(*map(quoted, by)).orderBy("__at"))
    chosen = narrow.sample(share, 11).withColumn("__i", rank).where(F.col("__i") % apart == 0)
    listed = chosen.groupBy(*map(quoted, by)).agg(F.sort_array(F.collect_set("__at")).alias("__cuts"))
    # a cut for every ``rows_per_range`` rows; taken once, so that all parts of a plan use the same cuts
    cuts = listed.collect()
    if not cuts:
        return None
    keys = listed.select(*map(quoted, by)).schema
    key_of = lambda row: tuple(row[c] for c in by)
    spark = rows.sparkSession
    sizes = [len(r["__cuts"]) for r in cuts]
    frame = spark.createDataFrame([(*key_of(r), n) for r, n in zip(cuts, sizes)], T.StructType([*keys, T.StructField("__last", T.IntegerType())]))
    node = T.StructType([*keys, T.StructField("__node", T.IntegerType()), T.StructField("__fences", listed.schema["__cuts"].dataType)])
    levels, span = [], 1
    while not levels or span <= max(sizes):
        # range g starts at cut g - 1; the fences of a node are the starts of its children after the first
        fences = []
        for row, last in zip(cuts, sizes):
            starts = range(span, last + 1, span)
            for parent, some in groupby((g for g in starts if g // span % FAN), key=lambda g: g // span // FAN):
                fences.append((*key_of(row), parent, [row["__cuts"][g - 1] for g in some]))
        levels.insert(0, spark.createDataFrame(fences, node))
        span *= FAN
    return Layout(frame, sum(sizes), levels)


def with_ranges(df: DataFrame, layout: Layout, by: Sequence[str], place: Column) -> DataFrame:
    """Adds ``__g``, the number of the row's range within its key (0 if it is not parted), and ``__parted``."""
    ranged = layout.joined(df.withColumn("__at", place), layout.frame, by).withColumn("__g", F.lit(0))
    # Down the tree, a level after the other: the child is the number of fences at or before the place. Each level names the one
    # before it a fixed number of times and stands behind a join, so expressions do not grow with the cuts; a halving
    # search in one expression triples with each step wherever the optimizer puts a column's definition in its place. An array
    # function with a lambda would copy the fences for every row.
    for level in layout.levels:
        ranged = layout.joined(ranged.withColumnRenamed("__g", "__node"), level, [*by, "__node"])
        passed = [F.when(F.get("__fences", F.lit(i)) <= F.col("__at"), 1).otherwise(0) for i in range(FAN - 1)]
        ranged = ranged.withColumn("__g", F.col("__node") * FAN + reduce(add, passed)).drop("__node", "__fences")
    return ranged.withColumn("__parted", F.col("__last").isNotNull()).drop("__last", "__at")


def carried(layout: Layout, closing: DataFrame, by: Sequence[str], states: Sequence[str], backwards: bool = False) -> DataFrame:
    """``by``, ``__g`` and the state that each range of a parted key starts from: per column of ``states`` the last non-null
    closing state of the ranges before it (``backwards``: after it). ``closing`` has a row per key and range at most."""
    ranges = layout.frame.select(*map(quoted, by), F.explode(F.sequence(F.lit(0), F.col("__last"))).alias("__g"))
    order = F.col("__g").desc() if backwards else F.col("__g").asc()
    earlier = Window.partitionBy(*map(quoted, by)).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    met = ranges.join(closing, [*by, "__g"], "left")
    return met.select(*map(quoted, by), "__g", *[F.last(quoted(s), ignorenulls=True).over(earlier).alias(s) for s in states])
