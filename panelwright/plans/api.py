"""Reading the stored tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.frames import keep_members
from panelwright.functions.scalars import quoted
from panelwright.operators.matrix import BLOCK_SIZE, long_cells, risk_model_blocks, wide_cells
from panelwright.specs import ASSETS, COVARIANCES, EXPOSURES, FACTORS
from panelwright.store import PanelStore


def load_assets(
    store: PanelStore, start: date, end: date, columns: Sequence[str], in_universe: bool = False
) -> DataFrame:
    """Asset rows of a date range, in the universe or all."""
    rows = store.between(ASSETS, start, end)
    return (rows.where("in_universe") if in_universe else rows).select(*map(quoted, columns))


def load_assets_by_date(store: PanelStore, date_: date, columns: Sequence[str], in_universe: bool = False) -> DataFrame:
    return load_assets(store, date_, date_, columns, in_universe)


def assets_columns() -> list[tuple[str, str]]:
    """Names and types of the assets table."""
    return [(f.name, f.dataType.simpleString()) for f in ASSETS.schema.fields]


def construct_covariance_matrix(
    store: PanelStore, date_: date, assets: DataFrame, strict: bool = True, block_size: int = BLOCK_SIZE
) -> DataFrame:
    """Long cells ``date, id_i, id_j, value`` between the assets given by ``barrid``.

    Both axes are cut down to them before the product. With a ``ticker`` column the cells carry tickers.
    """
    exposures = keep_members(store.between(EXPOSURES, date_, date_), assets, "barrid")
    risk = store.between(ASSETS, date_, date_).select("date", "barrid", "specific_risk")
    covariances = store.between(COVARIANCES, date_, date_)
    names = assets if "ticker" in assets.columns else None
    blocks = risk_model_blocks(
        exposures, covariances, risk, FACTORS, names=names, strict=strict, block_size=block_size
    )
    return long_cells(blocks, ["date"])


def covariance_by_ticker(store: PanelStore, date_: date, tickers: Sequence[str], strict: bool = True) -> DataFrame:
    """Wide matrix ``ticker`` by ticker for a chosen list of universe members."""
    members = load_assets_by_date(store, date_, ["barrid", "ticker"], in_universe=True)
    cells = construct_covariance_matrix(store, date_, members.where(F.col("ticker").isin(*tickers)), strict)
    return wide_cells(cells, list(tickers))
