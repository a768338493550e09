"""Price-history jobs: SQL vendor tables into the stored ones."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from panelwright.sources.sql import read_range
from panelwright.specs import CRSP_DAILY, CRSP_EVENTS, CRSP_MONTHLY
from panelwright.store import PanelStore

NAME_EVENTS = "NAMES"  # fixed value: the event kind that holds names and codes


def events(store: PanelStore, source, start: date, end: date) -> None:
    rows = read_range(store.spark, source, CRSP_EVENTS.schema, start, end, F.col("event") == NAME_EVENTS)
    store.upsert(CRSP_EVENTS, rows)


def monthly(store: PanelStore, source, start: date, end: date) -> None:
    store.upsert(CRSP_MONTHLY, read_range(store.spark, source, CRSP_MONTHLY.schema, start, end))


def daily(store: PanelStore, source, start: date, end: date, clip: bool = False) -> None:
    """Whole years from start to end; ``clip`` keeps to the dates given."""
    if not clip:
        start, end = date(start.year, 1, 1), date(end.year, 12, 31)
    store.upsert(CRSP_DAILY, read_range(store.spark, source, CRSP_DAILY.schema, start, end))
