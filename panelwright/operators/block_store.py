"""Matrices kept as blocks, and sub-matrices that open only the blocks of their names.

A block is one row and one row group, with the numbers of its two sides and their distance in the group's statistics. A small
index beside the blocks has the side of each name, taken from the diagonal blocks: of all others only the statistics are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.scalars import quoted
from panelwright.sources.objects import write_parquet

#: Stored column: how many blocks a block lies from the diagonal.
_APART = "__apart"


def write_blocks(blocks: DataFrame, path: str, panels: Column, panel: str = "date") -> None:
    """Blocks of ``asset_covariance_blocks`` below ``path``, one partition per panel; panels that occur in them are replaced.

    ``panels`` is a condition that holds for the panels written, such as ``F.col("date") == day``: those are indexed anew.
    """
    # two columns are not compared with statistics, a stored one and a number are
    ordered = blocks.withColumn(_APART, F.col("bj") - F.col("bi")).sortWithinPartitions(panel, "bi", "bj")
    writer = ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("parquet.block.row.count.limit", 1).partitionBy(panel).parquet(f"{path}/blocks")
    diagonal = blocks.sparkSession.read.parquet(f"{path}/blocks").where(panels & (F.col(_APART) == 0))
    write_parquet(diagonal.select(panel, F.explode("row_ids").alias("id"), F.col("bi").alias("side")), f"{path}/index", panel)


def stored_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/blocks").drop(_APART)


def sides_of(spark: SparkSession, path: str, names: Sequence, panels: Column) -> list[int]:
    """Sides that hold one of the names in some panel; no more than names and panels given."""
    found = spark.read.parquet(f"{path}/index").where(panels & F.col("id").isin(*names))
    return sorted(r[0] for r in found.select("side").distinct().collect())


def blocks_of(spark: SparkSession, path: str, names: Sequence, panels: Column) -> DataFrame:
    """The stored blocks that may hold a cell between two of the names."""
    sides = sides_of(spark, path, names, panels)
    return stored_blocks(spark, path).where(panels & F.col("bi").isin(*sides) & F.col("bj").isin(*sides))


def read_submatrix(spark: SparkSession, path: str, names: Sequence, panels: Column, panel: str = "date") -> DataFrame:
    """Long cells ``panel, id_i, id_j, value`` between the names, both triangles; unknown names have none.

    ``panels`` is a condition on the panel column.
    """
    chosen = blocks_of(spark, path, names, panels)
    width = F.size("column_ids")
    rows = chosen.select("*", width.alias("__width"), F.posexplode("row_ids").alias("__row", "__a")).where(F.col("__a").isin(*names))
    both = rows.select("*", F.posexplode("column_ids").alias("__column", "__b")).where(F.col("__b").isin(*names))
    value = F.get("values", F.col("__row") * F.col("__width") + F.col("__column"))
    cells = both.select(quoted(panel), "bi", "bj", "__a", "__b", value.alias("value"))
    sides = F.when(F.col("bi") < F.col("bj"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    placed = cells.withColumn("__mirrored", F.explode(sides))
    return placed.select(
        quoted(panel),
        F.when(F.col("__mirrored"), F.col("__b")).otherwise(F.col("__a")).alias("id_i"),
        F.when(F.col("__mirrored"), F.col("__a")).otherwise(F.col("__b")).alias("id_j"),
        "value",
    )
