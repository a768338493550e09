"""Daily covariance matrix of all home stocks, funds and receipts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.frames import keep_members, rename_all
from panelwright.functions.scalars import from_percent_squared, in_force, replace_first
from panelwright.operators.block_store import read_submatrix, write_blocks
from panelwright.operators.calendar import session_list
from panelwright.operators.keyed import dedupe_latest
from panelwright.operators.matrix import (
    BLOCK_SIZE,
    asset_covariance_blocks,
    exposure_vectors,
    factor_matrix,
    long_cells,
    relabel,
    with_variance,
)
from panelwright.plans.vendor import clean, clean_covariance_cells, clean_exposures, clean_identity, clean_ids
from panelwright.session import Staging
from panelwright.sources import archive
from panelwright.sources.objects import write_parquet
from panelwright.specs import (
    COVARIANCE_DATA,
    EXPOSURE_DATA,
    FACTORS,
    HOME_COUNTRY,
    HOME_PREFIX,
    IDENTITY_DATA,
    IDS_DATA,
    LOCAL_ID_KIND,
    MATRIX_COVARIANCE_DATA,
    MATRIX_EXPOSURE_DATA,
    MATRIX_INSTRUMENTS,
    MATRIX_RISK_DATA,
    RISK_DATA,
    VENDOR_COLUMNS,
    DatasetSpec,
)


def named(raw: DataFrame, data: DatasetSpec) -> DataFrame:
    """The raw rows under the table's names; a column that the dataset should have and the rows lack fails the job."""
    return rename_all(raw, {c: VENDOR_COLUMNS[c] for c in data.raw.fieldNames() if c in VENDOR_COLUMNS})


def matrix_assets(identity: DataFrame, ids: DataFrame, on_date: date) -> DataFrame:
    """``barrid``, ``ticker`` of the assets in the matrix: identity and local id both in force.

    Of several local ids the one that started last is taken.
    """
    listed = clean_identity(named(identity, IDENTITY_DATA)).where(
        F.col("instrument").isin(*MATRIX_INSTRUMENTS)
        & (F.col("iso_country_code") == HOME_COUNTRY)
        & in_force(on_date, F.col("start_date"), F.col("end_date"))
    )
    local = clean_ids(named(ids, IDS_DATA), LOCAL_ID_KIND, "ticker").where(
        in_force(on_date, F.col("start_date"), F.col("end_date")) & F.col("ticker").isNotNull()
    )
    latest = dedupe_latest(local.select("barrid", "start_date", "ticker"), ["barrid"], ["start_date"])
    tickers = latest.select("barrid", replace_first(F.col("ticker"), HOME_PREFIX).alias("ticker"))
    return tickers.join(listed.select("barrid").distinct(), "barrid")


def matrix_blocks(
    staging: Staging, archive_root: str, on_date: date, block_size: int = BLOCK_SIZE
) -> DataFrame:
    """Blocks of the matrix of one session, between tickers.

    What is used more than once goes through ``staging``; the blocks can be read until it is left.
    """
    spark = staging.spark

    def scan(*datasets: DatasetSpec) -> DataFrame:
        frames = [archive.scan_sessions(spark, archive_root, d, [on_date]) for d in datasets]
        return reduce(DataFrame.unionByName, frames)

    assets = staging.put(matrix_assets(scan(IDENTITY_DATA), scan(IDS_DATA), on_date))
    exposures = clean_exposures(keep_members(named(scan(*MATRIX_EXPOSURE_DATA), EXPOSURE_DATA), assets, "barrid"))
    risk = clean(keep_members(named(scan(*MATRIX_RISK_DATA), RISK_DATA), assets, "barrid"))
    covariances = clean_covariance_cells(named(scan(MATRIX_COVARIANCE_DATA), COVARIANCE_DATA)).withColumn(
        "covariance", from_percent_squared(F.col("covariance"))
    )
    x = exposure_vectors(exposures, FACTORS).alias("x")
    rated = with_variance(exposures.select("date", "barrid", x), risk, ["date", "barrid"])
    vectors = staging.put(relabel(rated, assets))
    kernel = factor_matrix(known_factors(covariances, FACTORS), FACTORS, ["date"])
    return asset_covariance_blocks(vectors, kernel, ["date"], "ticker", block_size)


def matrix_cells(
    staging: Staging, archive_root: str, on_date: date, block_size: int = BLOCK_SIZE
) -> DataFrame:
    """As ``matrix_blocks``, in long cells ``date, ticker_i, ticker_j, value``."""
    cells = long_cells(matrix_blocks(staging, archive_root, on_date, block_size), ["date"])
    return cells.withColumnsRenamed({"id_i": "ticker_i", "id_j": "ticker_j"})


def known_factors(cells: DataFrame, factors: Sequence[str]) -> DataFrame:
    return cells.where(F.col("factor_1").isin(*factors) & F.col("factor_2").isin(*factors))


def daily_matrix(
    spark: SparkSession,
    archive_root: str,
    calendar: DataFrame,
    today: date,
    target: str,
    block_size: int = BLOCK_SIZE,
) -> date:
    """Write the matrix of the last session as long cells, one partition per date; returns the date."""
    (session,) = session_list(calendar, today, 1)
    with Staging(spark) as staging:
        write_parquet(matrix_cells(staging, archive_root, session, block_size), target, "date")
    return session


def daily_matrix_blocks(
    spark: SparkSession,
    archive_root: str,
    calendar: DataFrame,
    today: date,
    target: str,
    block_size: int = BLOCK_SIZE,
) -> date:
    """As ``daily_matrix``, kept as blocks with an index: a half of the cells, no ids per cell, and ``submatrix`` opens only some."""
    (session,) = session_list(calendar, today, 1)
    with Staging(spark) as staging:
        write_blocks(matrix_blocks(staging, archive_root, session, block_size), target, F.col("date") == F.lit(session))
    return session


def submatrix(spark: SparkSession, target: str, on_date: date, tickers: Sequence[str]) -> DataFrame:
    """Long cells ``date, ticker_i, ticker_j, value`` between some tickers, from what ``daily_matrix_blocks`` wrote."""
    cells = read_submatrix(spark, target, tickers, F.col("date") == F.lit(on_date))
    return cells.withColumnsRenamed({"id_i": "ticker_i", "id_j": "ticker_j"})
