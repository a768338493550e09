"""Index membership job."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.frames import rename_known
from panelwright.functions.scalars import is_yes
from panelwright.operators.universe import FLAGS, base_universe, membership
from panelwright.session import Staging
from panelwright.sources.sql import read_range
from panelwright.specs import ASSETS, INDEX_COLUMNS, INDEX_STATE, schema_of
from panelwright.store import PanelStore

HOLDINGS = schema_of("date date, cusip string, russell2000 string, russell1000 string")


def clean_holdings(raw: DataFrame) -> DataFrame:
    """``"Y"`` flags to booleans under the table's names."""
    return rename_known(raw, INDEX_COLUMNS).withColumns({c: is_yes(F.col(c)) for c in INDEX_COLUMNS.values()})


def membership_rows(store: PanelStore, source, start: date, end: date) -> DataFrame:
    """Flags of the whole stored history: a carried flag may come from any earlier year."""
    holdings = clean_holdings(read_range(store.spark, source, HOLDINGS, start, end))
    return membership(base_universe(store.read(ASSETS)), holdings)


def backfill(store: PanelStore, source, start: date, end: date) -> None:
    """Update the flags of asset rows in the years from start to end."""
    rows = membership_rows(store, source, start, end)
    in_range = rows.where(F.year("date").between(start.year, end.year))
    store.update(ASSETS, in_range, keys=["date", "barrid"], unique=True)


def carried_flags(store: PanelStore, before: date) -> tuple[date | None, DataFrame]:
    """The date of the newest state before a day, and the flags that assets had then."""
    years = [y for y in store.years(INDEX_STATE) if y <= before.year]
    known = store.read(INDEX_STATE, years).where(F.col("date") < F.lit(before))
    newest = known.agg(F.max("date")).first()[0]
    return newest, known.where(F.col("date") == F.lit(newest))


def increment(store: PanelStore, source, start: date, end: date) -> None:
    """Update the flags of asset rows from start to end, going on from the newest state before start.

    Only rows and holdings after that state are read, so a daily run over the last sessions reads these and one row per asset,
    not the history. What lies between the state and the start is read as well, since its rebalance days count. The state
    as of the end is stored after the flags: a run that breaks off in between is simply run again. Without a state the flags
    begin with the first rebalance day from start on, as in ``backfill``.
    """
    since, before = carried_flags(store, start)
    first = start if since is None else since + timedelta(days=1)
    holdings = clean_holdings(read_range(store.spark, source, HOLDINGS, first, end))
    with Staging(store.spark) as staging:
        before = staging.put(before)
        rows = staging.put(membership(base_universe(store.between(ASSETS, first, end)), holdings, before))
        store.update(ASSETS, rows.where(F.col("date") >= F.lit(start)), keys=["date", "barrid"], unique=True)
        known = before.select("date", "barrid", *FLAGS).unionByName(rows.select("date", "barrid", *FLAGS)).where(F.col(FLAGS[0]).isNotNull())
        last = known.groupBy("barrid").agg(F.max_by(F.struct(*FLAGS), "date").alias("__last"))
        state = last.select(F.lit(end).alias("date"), "barrid", *[F.col("__last")[f].alias(f) for f in FLAGS])
        store.upsert(INDEX_STATE, state, unique=True)
