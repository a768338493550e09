"""Jobs that bring the risk-model files into the stored tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.frames import drop_trailer, rename_known
from panelwright.functions.scalars import contains, padded_double, parse_date, replace_first, to_percent
from panelwright.operators.asof import RightSide
from panelwright.operators.calendar import session_list
from panelwright.operators.reshape import pivot_panel
from panelwright.session import Staging
from panelwright.sources import archive
from panelwright.specs import (
    ARRIVAL,
    ASSETS,
    COVARIANCE_DATA,
    COVARIANCES,
    CUSIP_KIND,
    EXPOSURE_DATA,
    EXPOSURES,
    FACTOR_RETURN_DATA,
    FACTOR_RETURNS,
    FACTORS,
    HOME_PREFIX,
    IDENTITY_DATA,
    IDS_DATA,
    LOCAL_ID_KIND,
    LOOKBACK_SESSIONS,
    RETURNS_DATA,
    RISK_DATA,
    SPECIFIC_RETURNS_DATA,
    VENDOR_COLUMNS,
    VOLUME_DATA,
    DatasetSpec,
    TableSpec,
)
from panelwright.store import Change, PanelStore

VOLUME_COLUMNS = (
    "date",
    "barrid",
    "daily_volume",
    "average_daily_volume_30",
    "average_daily_volume_60",
    "average_daily_volume_90",
    "bid_ask_spread",
    "average_daily_bid_ask_spread_30",
    "average_daily_bid_ask_spread_60",
    "average_daily_bid_ask_spread_90",
)


def clean(raw: DataFrame, first: str = "barrid", dates: tuple[str, ...] = ("date",)) -> DataFrame:
    """Table column names, no trailer, dates parsed. ``first`` is the file's first column, renamed."""
    rows = drop_trailer(rename_known(raw, VENDOR_COLUMNS), first)
    return rows.withColumns({d: parse_date(F.col(d)) for d in dates})


def clean_volume(raw: DataFrame) -> DataFrame:
    rows = clean(raw)
    return rows.select(*VOLUME_COLUMNS, *[c for c in ARRIVAL if c in rows.columns])


def clean_exposures(raw: DataFrame) -> DataFrame:
    return pivot_panel(clean(raw), ["date", "barrid"], "factor", "exposures", FACTORS)


def clean_covariance_cells(raw: DataFrame) -> DataFrame:
    return clean(raw, "factor_1").withColumn("covariance", padded_double(F.col("covariance")))


def clean_covariances(raw: DataFrame) -> DataFrame:
    return pivot_panel(clean_covariance_cells(raw), ["date", "factor_1"], "factor_2", "covariance", FACTORS)


def clean_factor_returns(raw: DataFrame) -> DataFrame:
    """The file gives fractions; the table holds percent."""
    rows = clean(raw, "factor").withColumn("return", to_percent(F.col("return")))
    return pivot_panel(rows, ["date"], "factor", "return", FACTORS)


def clean_ids(raw: DataFrame, kind: str, name: str) -> DataFrame:
    """Identifiers of one kind as ``name`` with their ``start_date`` and ``end_date``."""
    rows = drop_trailer(rename_known(raw, VENDOR_COLUMNS), "barrid").where(F.col("asset_id_type") == kind)
    dated = rows.withColumns({d: parse_date(F.col(d)) for d in ("start_date", "end_date")})
    return dated.drop("asset_id_type").withColumnRenamed("assetid", name)


def clean_cusips(raw: DataFrame) -> DataFrame:
    return clean_ids(raw, CUSIP_KIND, "cusip")


def clean_tickers(raw: DataFrame) -> DataFrame:
    """Local ids of home assets without the country prefix."""
    home = clean_ids(raw, LOCAL_ID_KIND, "ticker").where(contains(F.col("barrid"), HOME_PREFIX))
    return home.withColumn("ticker", replace_first(F.col("ticker"), HOME_PREFIX))


def clean_identity(raw: DataFrame) -> DataFrame:
    return clean(raw, dates=("start_date", "end_date"))


@dataclass(frozen=True)
class Feed:
    """A dataset, its cleaning, and the table it goes to; ``insert`` feeds create rows.

    ``unique``: cleaning leaves one row per key.
    """

    data: DatasetSpec
    clean: Callable[[DataFrame], DataFrame]
    table: TableSpec
    insert: bool
    unique: bool = False

    def change(self, raw: DataFrame) -> Change:
        return Change(self.clean(raw), self.insert, unique=self.unique)


# In this order: only returns create asset rows, the next three fill them in.
ASSET_FEEDS = (
    Feed(RETURNS_DATA, clean, ASSETS, True),
    Feed(SPECIFIC_RETURNS_DATA, clean, ASSETS, False),
    Feed(RISK_DATA, clean, ASSETS, False),
    Feed(VOLUME_DATA, clean_volume, ASSETS, False),
)
RETURNS_FEED, SPECIFIC_RETURNS_FEED, RISK_FEED, VOLUME_FEED = ASSET_FEEDS
EXPOSURE_FEED = Feed(EXPOSURE_DATA, clean_exposures, EXPOSURES, True, True)
COVARIANCE_FEED = Feed(COVARIANCE_DATA, clean_covariances, COVARIANCES, True, True)
FACTOR_RETURN_FEED = Feed(FACTOR_RETURN_DATA, clean_factor_returns, FACTOR_RETURNS, True, True)

# dataset and cleaning of the interval maps put into assets
TICKERS = (IDS_DATA, clean_tickers)
CUSIPS = (IDS_DATA, clean_cusips)
IDENTITY = (IDENTITY_DATA, clean_identity)
INTERVAL_MAPS = (TICKERS, CUSIPS, IDENTITY)


@dataclass(frozen=True)
class VendorJobs:
    """Daily and history jobs over one archive tree and one store.

    ``archive_root`` must be a folder every executor can reach; ``calendar`` has one ``date`` per session.
    """

    store: PanelStore
    archive_root: str
    calendar: DataFrame
    today: dt.date

    @property
    def spark(self) -> SparkSession:
        return self.store.spark

    def sessions(self, n: int = LOOKBACK_SESSIONS) -> list[dt.date]:
        return session_list(self.calendar, self.today, n)

    def daily(self, *feeds: Feed) -> None:
        """Re-read the last sessions of the feeds, which must share a table, and rewrite it once."""
        sessions = self.sessions()
        self._put(feeds, lambda f: archive.scan_sessions(self.spark, self.archive_root, f.data, sessions, origin=not f.unique))

    def latest(self, *feeds: Feed) -> None:
        """As ``daily`` for the newest session alone; nothing to read changes nothing."""
        sessions = self.sessions()
        self._put(feeds, lambda f: archive.scan_latest(self.spark, self.archive_root, f.data, sessions, origin=not f.unique))

    def history(self, start: dt.date, end: dt.date, *feeds: Feed, clip: bool = False) -> None:
        """Whole archives of the years from start to end; ``clip`` keeps only dates inside the range."""
        years = range(start.year, end.year + 1)

        def scan(feed: Feed) -> DataFrame:
            return archive.scan_history(self.spark, self.archive_root, feed.data, years, origin=not feed.unique)

        inside = F.col("date").between(F.lit(start), F.lit(end)) if clip else None
        self._put(feeds, scan, inside)

    def _put(self, feeds: tuple[Feed, ...], scan: Callable[[Feed], DataFrame], where: Column | None = None) -> None:
        (table,) = {f.table.name: f.table for f in feeds}.values()
        changes = [f.change(scan(f)) for f in feeds]
        if where is not None:
            changes = [replace(c, rows=c.rows.where(where)) for c in changes]
        self.store.apply(table, changes)

    def map_intervals(self, *maps: tuple[DatasetSpec, Callable[[DataFrame], DataFrame]]) -> None:
        """Put the newest interval maps into assets, as of each row's date.

        A map stays in force until the next start date. Maps that reach equally far go in together, in
        one pass over the table.
        """
        pending: list[RightSide] = []
        reach: tuple[int, int] | None = None
        sessions = self.sessions()
        with Staging(self.spark) as staging:
            wanted = maps or INTERVAL_MAPS
            cleaned = [
                cleaning(archive.scan_latest(self.spark, self.archive_root, data, sessions)) for data, cleaning in wanted
            ]
            for rows in staging.put_all(cleaned):
                first, last = rows.agg(F.min("start_date"), F.least(F.max("end_date"), F.lit(self.today))).first()
                if first is None or last is None:
                    continue
                if pending and (first.year, last.year) != reach:
                    self._map(pending, *reach)
                    pending = []
                reach = (first.year, last.year)
                pending.append(RightSide(rows, "start_date", ("start_date", "end_date"), ("end_date",)))
            if pending:
                self._map(pending, *reach)

    def _map(self, rights: list[RightSide], first_year: int, last_year: int) -> None:
        # rows before the first start date match nothing, so their years are not read
        years = [y for y in self.store.years(ASSETS) if first_year <= y <= last_year]
        self.store.update_asof(ASSETS, rights, "barrid", years=years)
