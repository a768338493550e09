"""Point-in-time index membership."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.operators.fill import forward_fill
from panelwright.specs import HOME_COUNTRY

FLAGS = ("russell_1000", "russell_2000")


def base_universe(assets: DataFrame) -> DataFrame:
    """Primary home listings: the rows whose own id is their root id."""
    return assets.where((F.col("barrid") == F.col("rootid")) & (F.col("iso_country_code") == HOME_COUNTRY)).select(
        "date", "barrid", "cusip"
    )


def membership(universe: DataFrame, holdings: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Flags and ``in_universe`` for every (date, barrid) of the universe.

    On a date on which some universe asset is held, an asset's flags are its holding's, or false. On
    other dates they carry on from the last such date, and before the first one they are null, or what ``before`` says: the
    flags of assets as of a date before all others (``date, barrid`` and the flags, a row per asset).
    """
    # holdings may list a security twice; either listing counts
    held = holdings.groupBy("date", "cusip").agg(*[F.max(f).alias(f) for f in FLAGS])
    matched = universe.join(held, ["date", "cusip"], "left")
    # distinct days: a few hundred a year, and under 3.7 million in all the years a date can hold
    rebalanced = (
        matched.where(F.col(FLAGS[0]) | F.col(FLAGS[1]))
        .select(F.col("date").cast("date").alias("date"), F.lit(True).alias("rebalance"))
        .distinct()
    )
    dated = matched.join(F.broadcast(rebalanced), "date", "left").select(
        "date",
        "barrid",
        *[F.when(F.col("rebalance"), F.coalesce(F.col(f), F.lit(False))).alias(f) for f in FLAGS],
    )
    # (date, barrid) is the key, so an asset has at most one row per session: no hot key is possible
    if before is not None:
        carried = before.select("date", "barrid", *FLAGS, F.lit(True).alias("__carried"))
        dated = dated.withColumn("__carried", F.lit(False)).unionByName(carried)
    filled = forward_fill(dated, "barrid", "date", FLAGS, rows_per_range=None)
    if before is not None:
        filled = filled.where(~F.col("__carried"))
    return filled.withColumn("in_universe", F.col(FLAGS[0]) | F.col(FLAGS[1])).select(
        "date", "barrid", *FLAGS, "in_universe"
    )
