"""The archive scans, vendor jobs and composites over the test tables, one query each.

The vendor files are made from whole tables: tasks write one archive tree below the shared folder, as streams of sorted lines, and
the jobs read it as they would a vendor's. Customers are assets and order days are sessions.
"""

from __future__ import annotations

import os
import shutil
import uuid
import zipfile
from collections.abc import Iterator
from datetime import date
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright import specs as sp
from panelwright.functions import frames as FR
from panelwright.functions import scalars as S
from panelwright.operators.reshape import unpivot_panel
from panelwright.plans import api, composite, prices, risk
from panelwright.plans import vendor as V
from panelwright.plans.catalog import ORDER_PANEL, QUERIES, _day, _price_source, _store, _sum, _t, query
from panelwright.session import Staging, ship_package, shared_path
from panelwright.sources import archive, objects
from panelwright.store import PanelStore
from panelwright.streaming.incremental import start_feed

TODAY = date(1999, 6, 15)
FAR = "20991231"


def _stamp(column: str) -> Column:
    return F.date_format(column, "yyyyMMdd")


def _sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = _t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "orders")
    # texts are made once per order, not per line
    named = orders.withColumns({"barrid": F.concat(F.lit("USA"), "o_custkey"), "day": _stamp("o_orderdate")})
    joined = lines.join(named, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.withColumn("line", F.col("l_linenumber") - 1)


def _factor(place: Column) -> Column:
    return F.get(F.array(*map(F.lit, sp.FACTORS)), place)


#: Columns of the sold lines that the raw datasets are made from.
_SOLD = ("barrid", "day", "line", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority", "l_suppkey", "l_quantity", "l_discount", "l_tax")
#: Datasets that are made from ``asset_days`` alone.
_BY_ASSET = (sp.RETURNS_DATA, sp.SPECIFIC_RETURNS_DATA, sp.RISK_DATA, sp.VOLUME_DATA, sp.IDENTITY_DATA, sp.IDS_DATA)


def asset_days(sold: DataFrame) -> DataFrame:
    """One row per asset and day with what any dataset of assets takes from its lines."""
    greatest = [F.max(c).alias(c) for c in ("o_totalprice", "o_orderstatus", "o_custkey", "o_orderpriority", "l_tax", "l_discount", "l_quantity")]
    least = [F.min(c).alias(f"least_{c}") for c in ("l_tax", "l_discount")]
    return sold.groupBy("barrid", "day").agg(*greatest, *least, _sum("l_quantity").alias("sum_quantity"))


def raw_rows(spark: SparkSession, sf_dir: str, data: sp.DatasetSpec, sold: DataFrame | None = None, days: DataFrame | None = None) -> DataFrame:
    """Rows of one raw dataset, with the columns of its files. ``sold`` and ``days`` are lines and ``asset_days`` made before."""
    sold = _sold(spark, sf_dir) if sold is None else sold
    # the columns that whole assets need have the same names and extremes in both
    whole = (sold if days is None else days).groupBy(F.col("barrid").alias("!Barrid"))
    days = asset_days(sold) if days is None else days
    key = [F.col("barrid").alias("!Barrid"), F.col("day").alias("DataDate")]
    if data.name == "returns":
        rows = days.select(*key, F.col("o_totalprice").alias("Price"), F.col("sum_quantity").alias("Capt"), F.col("o_orderstatus").alias("PriceSource"), F.lit("USD").alias("Currency"), F.col("l_discount").alias("DlyReturn%"))
    elif data.name == "specific_returns":
        rows = days.select(*key, F.col("l_tax").alias("SpecificReturn"))
    elif data.name == "risk":
        rows = days.select(*key, F.col("l_tax").alias("Yield%"), F.col("l_quantity").alias("TotalRisk%"), (F.col("l_discount") + 1).alias("SpecRisk%"), F.col("least_l_tax").alias("HistBeta"), F.col("least_l_discount").alias("PredBeta"))
    elif data.name == "volume":
        rows = days.select(*key, F.col("sum_quantity").alias("DailyVolume"))
    elif data.name == "exposures":
        grouped = sold.groupBy(F.col("barrid").alias("!Barrid"), F.col("day").alias("DataDate"), _factor(F.col("line")).alias("Factor"))
        rows = grouped.agg(F.max("l_quantity").alias("Exposure"))
    elif data.name == "covariances":
        pair = sold.groupBy(_factor(F.col("line")).alias("!Factor1"), _factor(F.col("l_suppkey") % 7).alias("Factor2"), F.col("day").alias("DataDate"))
        rows = pair.agg(F.concat(F.lit("  "), F.max("l_discount").cast("string"), F.lit(" ")).alias("VarCovar"))
    elif data.name == "factor_returns":
        rows = sold.groupBy(_factor(F.col("line")).alias("!Factor"), F.col("day").alias("DataDate")).agg(F.max("l_tax").alias("DlyReturn"))
    elif data.name == "identity":
        rows = whole.agg(F.concat(F.lit("name "), F.max("o_custkey")).alias("Name"), F.lit("STOCK").alias("Instrument"), F.max("o_orderpriority").alias("IssuerID"), F.lit("USA").alias("ISOCountryCode"), F.lit("USD").alias("ISOCurrencyCode"), F.max("o_orderstatus").alias("RootID"), F.min("day").alias("StartDate"), F.lit(FAR).alias("EndDate"))
    else:
        local = whole.agg(F.lit("LOCALID").alias("AssetIDType"), F.concat(F.lit("UST"), F.max("o_custkey")).alias("AssetID"), F.min("day").alias("StartDate"), F.lit(FAR).alias("EndDate"))
        cusips = days.select(key[0], F.col("day").alias("StartDate"), F.lit("CUSIP").alias("AssetIDType"), F.col("o_orderstatus").alias("AssetID"), F.lit(FAR).alias("EndDate"))
        rows = local.unionByName(cusips)
    return FR.add_missing_columns(rows, data.raw).select(data.raw.fieldNames())


def full_covariances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One triangle of a whole factor covariance matrix; pairs that the tables lack are 0."""
    names = spark.createDataFrame([(f, i) for i, f in enumerate(sp.FACTORS)], "f string, i int")
    # the factor list is fixed, so the grid is too
    grid = names.selectExpr("f AS `!Factor1`", "i").join(F.broadcast(names.selectExpr("f AS Factor2", "i AS j")), F.expr("i <= j"))
    places = _t(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 76).alias("p"), (F.col("l_suppkey") % 76).alias("q"), "l_discount")
    sums = places.groupBy(F.least("p", "q").cast("int").alias("i"), F.greatest("p", "q").cast("int").alias("j")).agg(F.max("l_discount").alias("v"))
    return grid.join(sums, ["i", "j"], "left").select("!Factor1", "Factor2", F.coalesce("v", F.lit(0.0)).cast("string").alias("VarCovar"))


def local_root(spark: SparkSession) -> str:
    """A fresh archive root below the shared folder, as a path of the mount."""
    path = shared_path(spark, "archives")
    scheme, _, rest = path.rpartition(":")
    if scheme not in ("", "file"):
        raise RuntimeError(f"archives need a folder that every executor has mounted, not {path}")
    return "/" + rest.lstrip("/") if scheme else path


class _Writer:
    """One zip archive after the other, written member by member and line by line. ``whole`` gives members their first and last lines."""

    def __init__(self, heads: list[str], whole: bool = True):
        self.heads, self.whole = heads, whole
        self.path = self.member = self.zip = self.stream = None

    def put(self, path: str, member: str, kind: int, lines: bytes) -> None:
        if path != self.path:
            self.close()
            self.path = path
            os.makedirs(os.path.dirname(path), exist_ok=True)
            self.part = f"{path}.{uuid.uuid4().hex}.part"
            # pieces are read again at once and go, so they are not compressed
            # archives are read once or twice, so at the fastest level
            self.zip = zipfile.ZipFile(self.part, "w", zipfile.ZIP_DEFLATED if self.whole else zipfile.ZIP_STORED, compresslevel=1)
        if member != self.member:
            self.end_member()
            self.member = member
            # a member may be larger than 2 GB, which is not known before
            self.stream = self.zip.open(member if self.whole else f"{kind}/{member}", "w", force_zip64=True)
            if self.whole:
                self.stream.write(self.heads[kind].encode())
        self.stream.write(lines)

    def end_member(self) -> None:
        if self.stream:
            if self.whole:
                self.stream.write(f"{sp.END_OF_FILE}\n".encode())
            self.stream.close()
        self.member = self.stream = None

    def close(self) -> None:
        if self.zip:
            self.end_member()
            self.zip.close()
            os.replace(self.part, self.path)  # whole or not at all, also when a task runs twice
        self.path = self.zip = None


def _joined_pieces(pieces: list[str], path: str, writer: _Writer) -> None:
    """One archive of successive pieces, copied chunk by chunk; a member may go on in the next piece."""
    for piece in pieces:
        with zipfile.ZipFile(piece) as archive:
            for name in archive.namelist():
                kind, _, member = name.partition("/")
                with archive.open(name) as stream:
                    while chunk := stream.read(1 << 20):
                        writer.put(path, member, int(kind), chunk)


#: Optional column of rows to be written: their order within a member, before the order of their lines.
_PLACE = "__place"
#: Rows of one dataset, and the archive and member of each.
Part = tuple[DataFrame, sp.DatasetSpec, Column, Column]


def put_archives(parts: list[Part], root: str) -> None:
    """Write the rows as members of zip archives.

    Datasets may share archives, so all of them are sorted at once, by ranges of archive, member and line: an archive of any size is
    sorted by many tasks. A task streams the archives that lie inside its range; of the first and the last one, which its
    neighbours may hold as well, it leaves a piece, and pieces are copied together without a sort.
    """
    spark = parts[0][0].sparkSession
    ship_package(spark)
    heads = ["preamble\n" * data.skip_lines + "|".join(data.raw.fieldNames()) + "\n" for _, data, _, _ in parts]

    def placed(kind: int, part: Part) -> DataFrame:
        rows, data, archive_of, member_of = part
        line = F.concat_ws("|", *[F.coalesce(S.quoted(c).cast("string"), F.lit("")) for c in data.raw.fieldNames()])
        place = F.col(_PLACE) if _PLACE in rows.columns else F.lit(0)
        return rows.select(archive_of.alias("archive"), member_of.alias("member"), F.lit(kind).alias("kind"), place.alias("place"), line.alias("line"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, left = TaskContext.get().partitionId(), []
        inside, apart = _Writer(heads), _Writer(heads, whole=False)
        # the last archive is known at the end only, so each but the first starts as a piece and is made whole when another follows
        current = None

        def follow(archive: str | None) -> None:
            apart.close()
            if len(left) > 1 and archive is not None:
                name, piece = left.pop()
                _joined_pieces([piece], os.path.join(root, name), inside)
                inside.close()
                os.remove(piece)
            if archive is not None:
                left.append((archive, f"{pieces}/{task}-{uuid.uuid4().hex}.piece"))

        for batch in batches:
            archives, members = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("archive", "member"))
            new = np.flatnonzero((archives[1:] != archives[:-1]) | (members[1:] != members[:-1])) + 1 if batch.num_rows else []
            for a, b in zip([0, *new], [*new, batch.num_rows]):
                if a < b:
                    if archives[a] != current:
                        follow(current := archives[a])
                    lines = ("\n".join(batch.column("line").slice(a, b - a).to_pylist()) + "\n").encode()
                    apart.put(left[-1][1], members[a], batch.column("kind")[int(a)].as_py(), lines)
        follow(None)
        columns = [pa.array([n for n, _ in left], pa.string()), pa.array([task] * len(left), pa.int32()), pa.array([p for _, p in left], pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["archive", "task", "piece"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, joined = _Writer(heads), 0
        for batch in batches:
            for row in batch.to_pylist():
                _joined_pieces([row["piece"]], os.path.join(root, row["archive"]), writer)
                joined += 1
        writer.close()
        yield pa.RecordBatch.from_arrays([pa.array([joined], pa.int64())], ["n"])

    lines = reduce(DataFrame.unionByName, [placed(k, p) for k, p in enumerate(parts)])
    # archives may come in any order; by a hash most rows are told apart by the first eight bytes of their sort key, which names that
    # all begin alike are not
    order = ["hash", "archive", "member", "place", "line"]
    pieces = f"{local_root(spark)}-pieces"
    with Staging(spark) as staging:
        # a range sort goes over its rows twice, first for a sample; what makes the rows is done once
        sorted_ = staging.put(lines).withColumn("hash", F.xxhash64("archive")).repartitionByRange(*order).sortWithinPartitions(*order)
        left = staging.put(sorted_.drop("hash").mapInArrow(write, "archive string, task int, piece string"))
        dealt = left.repartition("archive").sortWithinPartitions("archive", "task")
        dealt.mapInArrow(join, "n long").write.format("noop").mode("overwrite").save()
    shutil.rmtree(pieces, ignore_errors=True)


def daily_part(rows: DataFrame, data: sp.DatasetSpec, day: Column | None = None) -> Part:
    """An archive per session."""
    day = F.col("DataDate") if day is None else day
    name = F.concat(F.lit(f"{data.daily_folder}/{data.daily_zip}_"), F.substring(day, 3, 6), F.lit(".zip"))
    return rows, data, name, F.concat(F.lit(f"{data.member}."), day)


def history_part(rows: DataFrame, data: sp.DatasetSpec) -> Part:
    """An archive per year, or one per half year where a year may have several."""
    year = F.substring("DataDate", 1, 4)
    half = F.when(F.substring("DataDate", 5, 2) <= "06", "01").otherwise("02") if data.history_many else F.lit("")
    name = F.concat(F.lit(f"{data.history_folder}/{data.history_zip}_"), year, half, F.lit(".zip"))
    return rows, data, name, F.concat(F.lit(f"{data.member}."), F.col("DataDate"))


def put_daily(rows: DataFrame, data: sp.DatasetSpec, root: str, day: Column | None = None) -> None:
    put_archives([daily_part(rows, data, day)], root)


class Vendor:
    """A vendor's archive tree, a store and the jobs between them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.store = spark, sf_dir, _store(spark)
        self.calendar = _t(spark, sf_dir, "orders").select(_day("o_orderdate").alias("date")).distinct()
        self.first, self.last = self.calendar.agg(F.min("date"), F.max("date")).first()

    def jobs(self, root: str) -> V.VendorJobs:
        return V.VendorJobs(self.store, root, self.calendar, TODAY)

    def tree(self, daily=(), history=(), latest=()) -> str:
        """One tree with the datasets in their daily and history archives; ``latest`` ones come whole with the newest session."""
        root, newest = local_root(self.spark), None
        if latest:
            (newest,) = self.jobs(root).sessions(1)
        with Staging(self.spark) as staging:
            # lines and asset days that several datasets are made from are joined and aggregated once
            datasets, sold, days = [*daily, *history, *latest], None, None
            if len(datasets) > 1:
                sold = _sold(self.spark, self.sf_dir).select(*_SOLD)
                by_asset = sum(d in _BY_ASSET for d in datasets)
                if len(datasets) > by_asset + 1 or 0 < by_asset < len(datasets):
                    sold = staging.put(sold)
                if by_asset > 1:
                    days = staging.put(asset_days(sold))

            def rows(data: sp.DatasetSpec) -> DataFrame:
                return raw_rows(self.spark, self.sf_dir, data, sold, days)

            parts = [daily_part(rows(d), d) for d in daily] + [history_part(rows(d), d) for d in history]
            parts += [daily_part(rows(d), d, F.lit(f"{newest:%Y%m%d}")) for d in latest]
            put_archives(parts, root)
        return root

    def daily(self, data: sp.DatasetSpec) -> str:
        return self.tree(daily=[data])

    def history(self, data: sp.DatasetSpec) -> str:
        return self.tree(history=[data])

    def with_assets(self, *latest: sp.DatasetSpec) -> str:
        """The tree, with the returns of all years in the store."""
        root = self.tree(history=[sp.RETURNS_DATA], latest=latest)
        self.jobs(root).history(self.first, self.last, V.RETURNS_FEED)
        return root


# --- scans ------------------------------------------------------------------------------------------


@query
def archive_daily_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last sixty sessions of a daily dataset, each in an archive of its own."""
    vendor = Vendor(spark, sf_dir)
    root = vendor.daily(sp.RETURNS_DATA)
    return V.clean(archive.scan_sessions(spark, root, sp.RETURNS_DATA, vendor.jobs(root).sessions())).select("date", "barrid", "price", "price_source")


@query
def archive_history_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All years of a dataset, one archive each."""
    vendor = Vendor(spark, sf_dir)
    root, years = vendor.history(sp.VOLUME_DATA), range(vendor.first.year, vendor.last.year + 1)
    return V.clean_volume(archive.scan_history(spark, root, sp.VOLUME_DATA, years)).select("date", "barrid", "daily_volume")


@query
def archive_many_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year spread over several archives, all of its dates kept."""
    root = Vendor(spark, sf_dir).history(sp.RISK_DATA)
    return V.clean(archive.scan_history(spark, root, sp.RISK_DATA, [1996, 1997])).select("date", "barrid", "yield", "specific_risk")


@query
def archive_latest_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest session that has an archive."""
    vendor = Vendor(spark, sf_dir)
    root = vendor.daily(sp.SPECIFIC_RETURNS_DATA)
    return V.clean(archive.scan_latest(spark, root, sp.SPECIFIC_RETURNS_DATA, vendor.jobs(root).sessions())).select("date", "barrid", "specific_return")


@query
def archive_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archives of a folder by name."""
    root = Vendor(spark, sf_dir).daily(sp.FACTOR_RETURN_DATA)
    found = objects.list_files(spark, root, "*.zip")
    return found.where("length > 0").select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"))


# --- cleaning and guards ----------------------------------------------------------------------------


@query
def strict_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = FR.rename_all(_t(spark, sf_dir, "supplier"), {"s_suppkey": "id", "s_name": "name"})
    return named.select(F.col("id").cast("string").alias("id_text"), "name")


@query
def unique_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group that must have one row gives it; a second one would fail the job."""
    orders = _t(spark, sf_dir, "orders")
    return orders.groupBy("o_orderkey").agg(FR.single_value(F.col("o_totalprice"), "repeated order").alias("price"))


@query
def mapped_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assets whose identity and local id are both in force, with the id cut to a ticker."""
    identity, ids = (raw_rows(spark, sf_dir, d) for d in (sp.IDENTITY_DATA, sp.IDS_DATA))
    return risk.matrix_assets(identity, ids, date(1996, 6, 28))


# --- stored tables ----------------------------------------------------------------------------------


@query
def stored_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which years a stored table has; before its first row it exists and is empty."""
    store = _store(spark)
    store.create_if_not_exists(sp.CRSP_DAILY)
    if store.years(sp.CRSP_DAILY) or store.read(sp.CRSP_DAILY).count():
        raise ValueError("a new table has rows")
    prices.daily(store, _price_source(spark, sf_dir), date(1995, 1, 1), date(1997, 3, 1))
    rows = [(y, store.exists(sp.CRSP_DAILY, y)) for y in range(1990, 2003)]
    return spark.createDataFrame(rows, "year int, stored boolean")


def _feed_job(spark: SparkSession, sf_dir: str, feed: V.Feed) -> DataFrame:
    vendor = Vendor(spark, sf_dir)
    vendor.jobs(vendor.history(feed.data)).history(vendor.first, vendor.last, feed)
    return vendor.store.read(feed.table)


def _seven(df: DataFrame, *keys: str) -> DataFrame:
    """The factor columns that the tables fill."""
    return df.select(*keys, *[S.quoted(f).alias(f"f{i}") for i, f in enumerate(sp.FACTORS[:7])])


@query
def exposures_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seven(_feed_job(spark, sf_dir, V.EXPOSURE_FEED), "date", "barrid")


@query
def covariances_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seven(_feed_job(spark, sf_dir, V.COVARIANCE_FEED), "date", "factor_1")


@query
def factor_returns_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest session's factor returns, in percent."""
    vendor = Vendor(spark, sf_dir)
    vendor.jobs(vendor.daily(sp.FACTOR_RETURN_DATA)).latest(V.FACTOR_RETURN_FEED)
    return _seven(vendor.store.read(sp.FACTOR_RETURNS), "date").select("date", *[F.round(f"f{i}", 6).alias(f"f{i}") for i in range(7)])


def _map_job(spark: SparkSession, sf_dir: str, *maps) -> DataFrame:
    vendor = Vendor(spark, sf_dir)
    root = vendor.with_assets(*{m[0].name: m[0] for m in maps}.values())
    vendor.jobs(root).map_intervals(*maps)
    return vendor.store.read(sp.ASSETS)


@query
def tickers_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _map_job(spark, sf_dir, V.TICKERS).select("date", "barrid", "ticker")


@query
def cusips_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _map_job(spark, sf_dir, V.CUSIPS).select("date", "barrid", "cusip")


@query
def metadata_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _map_job(spark, sf_dir, V.IDENTITY).select("date", "barrid", "name", "issuerid", "rootid", "iso_country_code")


@query
def load_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest session's rows with all text columns that the table declares."""
    vendor = Vendor(spark, sf_dir)
    (session,) = vendor.jobs(vendor.with_assets()).sessions(1)
    texts = [name for name, kind in api.assets_columns() if kind == "string"]
    return api.load_assets_by_date(vendor.store, session, ["date", *texts, "price"])


# --- composites -------------------------------------------------------------------------------------


def _model_rows(store, *more: Column) -> DataFrame:
    """Rows of the assets table with exposures, covariances and factor returns of the first factor beside them."""
    assets = store.read(sp.ASSETS).select("date", "barrid", "price", "specific_return", "specific_risk", "daily_volume", "ticker", "cusip", *more)
    first = S.quoted(sp.FACTORS[0])
    exposed = store.read(sp.EXPOSURES).select("date", "barrid", first.alias("f0"))
    varied = store.read(sp.COVARIANCES).where(F.col("factor_1") == sp.FACTORS[0]).select("date", first.alias("c0"))
    returned = store.read(sp.FACTOR_RETURNS).select("date", F.round(first, 6).alias("r0"))
    # a row per asset and day; three of 80 columns, most of them empty, are estimated at a small part of what they hold
    return assets.join(exposed.hint("merge"), ["date", "barrid"], "left").join(varied, "date", "left").join(returned, "date", "left")


_NAMES = ("name", "issuerid", "rootid", "iso_country_code")
_MODEL_DATA = (*(f.data for f in V.ASSET_FEEDS), sp.EXPOSURE_DATA, sp.COVARIANCE_DATA)


@query
def risk_model_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily composite over one archive tree; all four tables, identifiers and metadata."""
    vendor = Vendor(spark, sf_dir)
    root = vendor.tree(daily=(*_MODEL_DATA, sp.FACTOR_RETURN_DATA), latest=(sp.IDS_DATA, sp.IDENTITY_DATA))
    composite.risk_model_daily(vendor.jobs(root))
    return _model_rows(vendor.store, *_NAMES)


@query
def risk_model_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The backfill composite over one archive tree, started again after its last step: what was done is not done again."""
    vendor = Vendor(spark, sf_dir)
    jobs = vendor.jobs(vendor.tree(history=_MODEL_DATA, latest=(sp.IDS_DATA, sp.IDENTITY_DATA)))
    composite.risk_model_backfill(jobs, vendor.first, vendor.last, run="whole-history")
    composite.risk_model_backfill(jobs, vendor.first, vendor.last, run="whole-history")
    return _model_rows(vendor.store, *_NAMES).drop("r0")


@query
def price_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events, monthly and daily prices in one run."""
    store, source = _store(spark), _price_source(spark, sf_dir)
    names = source.select("date", "permno", F.col("cusip").alias("ticker"), F.col("shrout").alias("shrcd"), F.col("shrout").alias("exchcd"), F.lit("NAMES").alias("event"))
    composite.price_backfill(store, names, source, source, date(1999, 3, 31), date(1996, 7, 1))
    tables = [store.read(t).groupBy(F.year("date").alias("year")).agg(F.count("*").alias("n")).select(F.lit(t.name).alias("table"), "year", "n") for t in (sp.CRSP_EVENTS, sp.CRSP_MONTHLY, sp.CRSP_DAILY)]
    return reduce(DataFrame.unionByName, tables)


# --- the daily matrix -------------------------------------------------------------------------------


def _matrix_root(vendor: Vendor) -> str:
    """The model files of the newest session, each dataset below a folder of its own."""
    spark, sf_dir, root = vendor.spark, vendor.sf_dir, local_root(vendor.spark)
    (session,) = vendor.jobs(root).sessions(1)
    day = f"{session:%Y%m%d}"
    newest = raw_rows(spark, sf_dir, sp.EXPOSURE_DATA).where(F.col("DataDate") == day)
    risks = raw_rows(spark, sf_dir, sp.RISK_DATA).where(F.col("DataDate") == day)
    stamped = full_covariances(spark, sf_dir).withColumn("DataDate", F.lit(day)).select(sp.COVARIANCE_DATA.raw.fieldNames())
    put_daily(newest, sp.MATRIX_EXPOSURE_DATA[0], f"{root}/exposures")
    put_daily(risks, sp.MATRIX_RISK_DATA[0], f"{root}/risk")
    put_daily(stamped, sp.MATRIX_COVARIANCE_DATA, f"{root}/model")
    return root


@query
def risk_model_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Covariances between one day's universe members, from stored tables, as cells."""
    vendor = Vendor(spark, sf_dir)
    session = _store_matrix_tables(vendor)
    members = api.load_assets_by_date(vendor.store, session, ["barrid", "ticker"], in_universe=True)
    cells = api.construct_covariance_matrix(vendor.store, session, members)
    return cells.select("date", "id_i", "id_j", S.rounded(F.col("value"), 6).alias("value"))


@query
def matrix_by_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide matrix of a list of tickers, one of each market segment and one that is no member; its cells as rows."""
    vendor = Vendor(spark, sf_dir)
    session = _store_matrix_tables(vendor)
    # one name per segment
    tickers = [str(r[0]) for r in _newest_per_segment(spark, sf_dir).select("custkey").collect()] + ["nobody"]
    wide = api.covariance_by_ticker(vendor.store, session, tickers)
    cells = unpivot_panel(wide, ["ticker"], sorted(tickers), "other", "value")
    return cells.select("ticker", "other", S.rounded(F.col("value"), 6).alias("value"))


def _store_matrix_tables(vendor: Vendor) -> date:
    """Exposures, covariances and assets of the newest session, all of its assets universe members; returns the session."""
    root = _matrix_root(vendor)
    (session,) = vendor.jobs(root).sessions(1)
    move = {"daily_folder": "bime"}
    feeds = [(V.EXPOSURE_FEED, "exposures"), (V.COVARIANCE_FEED, "model")]
    for feed, folder in feeds:
        raw = archive.scan_sessions(vendor.spark, f"{root}/{folder}", feed.data.moved(**move), [session])
        vendor.store.apply(feed.table, [feed.change(raw)])
    risks = V.clean(archive.scan_sessions(vendor.spark, f"{root}/risk", sp.RISK_DATA.moved(**move), [session]))
    listed = risks.withColumns({"ticker": S.replace_first(F.col("barrid"), "USA"), "in_universe": F.lit(True)})
    vendor.store.upsert(sp.ASSETS, listed)
    return session


def _daily_matrix_tree(vendor: Vendor) -> str:
    """What the matrix job reads for the newest session: model files of stocks and, in archives of their own, of every fifth
    asset as a fund, the covariances, and all assets' identities and ids."""
    root = local_root(vendor.spark)
    (session,) = vendor.jobs(root).sessions(1)
    day = f"{session:%Y%m%d}"
    parts = []
    for data, moved in ((sp.EXPOSURE_DATA, sp.MATRIX_EXPOSURE_DATA), (sp.RISK_DATA, sp.MATRIX_RISK_DATA)):
        rows = raw_rows(vendor.spark, vendor.sf_dir, data).where(F.col("DataDate") == day)
        fund = F.substring("!Barrid", -1, 1).isin("0", "5")
        parts += [daily_part(rows.where(~fund), moved[0]), daily_part(rows.where(fund), moved[1])]
        # an archive must be there even on a day without funds; its one asset is no member of the matrix
        nobody = vendor.spark.createDataFrame([("none", *[None] * (len(data.raw) - 2), day)], data.raw)
        parts.append(daily_part(nobody, moved[1]))
    stamped = full_covariances(vendor.spark, vendor.sf_dir).withColumn("DataDate", F.lit(day)).select(sp.COVARIANCE_DATA.raw.fieldNames())
    parts.append(daily_part(stamped, sp.MATRIX_COVARIANCE_DATA))
    parts += [daily_part(raw_rows(vendor.spark, vendor.sf_dir, d), d, F.lit(day)) for d in (sp.IDENTITY_DATA, sp.IDS_DATA)]
    put_archives(parts, root)
    return root


@query
def daily_matrix_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily matrix from archives, written by date and read again."""
    vendor = Vendor(spark, sf_dir)
    target = shared_path(spark, "matrix")
    risk.daily_matrix(spark, _daily_matrix_tree(vendor), vendor.calendar, TODAY, target)
    return spark.read.parquet(target).select("date", "ticker_i", "ticker_j", S.rounded(F.col("value"), 6).alias("value"))


@query
def daily_submatrix_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily matrix kept as blocks, and of it the cells between each market segment's customer who ordered last."""
    vendor = Vendor(spark, sf_dir)
    target = shared_path(spark, "matrix")
    session = risk.daily_matrix_blocks(spark, _daily_matrix_tree(vendor), vendor.calendar, TODAY, target, block_size=16)
    asset = _newest_per_segment(spark, sf_dir)
    # one name per segment
    tickers = [r[0] for r in asset.select(F.concat(F.lit("T"), "custkey")).collect()]
    return risk.submatrix(spark, target, session, tickers).select("date", "ticker_i", "ticker_j", S.rounded(F.col("value"), 6).alias("value"))


def _newest_per_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``custkey`` of the customer of each market segment who was the last to order before today; of several the least."""
    last = _t(spark, sf_dir, "orders").where(_day("o_orderdate") < F.lit(TODAY)).groupBy(F.col("o_custkey").alias("custkey")).agg(F.max(_day("o_orderdate")).alias("day"))
    placed = last.join(_t(spark, sf_dir, "customer"), F.col("custkey") == F.col("c_custkey"))
    return placed.groupBy("c_mktsegment").agg(F.max_by("custkey", F.struct("day", -F.col("custkey"))).alias("custkey"))


# --- corrections and streams ------------------------------------------------------------------------


@query
def corrections_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each price is listed too high first and corrected further down in the same member: what arrived last is kept."""
    vendor = Vendor(spark, sf_dir)
    rows = raw_rows(spark, sf_dir, sp.RETURNS_DATA)
    wrong = rows.withColumns({"Price": F.col("Price") + 1000, _PLACE: F.lit(1)})
    put_archives([daily_part(wrong.unionByName(rows.withColumn(_PLACE, F.lit(2))), sp.RETURNS_DATA)], root := local_root(spark))
    vendor.jobs(root).daily(V.RETURNS_FEED)
    return vendor.store.read(sp.ASSETS).select("date", "barrid", "price", "price_source")


@query
def archive_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily archives as a stream, taken up in two runs. Between them one half of the sessions arrives late and the other half
    is corrected under the same names."""
    vendor = Vendor(spark, sf_dir)
    root, place = local_root(spark), shared_path(spark, "stream")
    rows = raw_rows(spark, sf_dir, sp.RETURNS_DATA)
    early = F.substring("DataDate", -1, 1).cast("int") % 2 == 0
    put_archives([daily_part(rows.where(early).withColumn("Price", F.col("Price") + 1000), sp.RETURNS_DATA)], root)
    log = f"{local_root(spark)}-log"
    start_feed(vendor.jobs(root), V.RETURNS_FEED, place, log).awaitTermination()
    put_archives([daily_part(rows, sp.RETURNS_DATA)], root)
    start_feed(vendor.jobs(root), V.RETURNS_FEED, place, log).awaitTermination()
    return vendor.store.read(sp.ASSETS).select("date", "barrid", "price", "price_source")


@query
def archive_years_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All years of a dataset whose years have several archives."""
    vendor = Vendor(spark, sf_dir)
    root, years = vendor.history(sp.RISK_DATA), range(vendor.first.year, vendor.last.year + 1)
    return V.clean(archive.scan_history(spark, root, sp.RISK_DATA, years)).select("date", "barrid", "yield", "specific_risk")


@query
def price_backfill_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily table of a price backfill, row by row, with the monthly price and the events beside it."""
    store, source = _store(spark), _price_source(spark, sf_dir)
    names = source.select("date", "permno", F.col("cusip").alias("ticker"), F.col("shrout").alias("shrcd"), F.col("shrout").alias("exchcd"), F.lit("NAMES").alias("event"))
    composite.price_backfill(store, names, source, source, date(1999, 3, 31), date(1996, 7, 1))
    keys = ["date", "permno"]
    events = store.read(sp.CRSP_EVENTS).select(*keys, "ticker", "shrcd")
    monthly = store.read(sp.CRSP_MONTHLY).select(*keys, F.col("prc").alias("monthly_prc"))
    return store.read(sp.CRSP_DAILY).select(*keys, "cusip", "prc", "vol", "askhi").join(monthly, keys, "left").join(events, keys, "left")


JOB_QUERIES = {n: q for n, q in QUERIES.items() if q.__module__ == __name__}


# --- rewrites by file -------------------------------------------------------------------------------


@query
def one_day_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders are stored, then the prices of the busiest day come again. ``file`` says what became of each row's file: rows of
    the day are in new ones, those of other years in the files of before, and ``near`` of the same year in either. Of all files
    no more are new than the day's rows fill, and one at either end."""
    per_file = 500
    store = PanelStore(spark, shared_path(spark, "store"), rows_per_file=per_file)
    orders = _t(spark, sf_dir, "orders").select(
        _day("o_orderdate").alias("date"), "o_orderkey", "o_custkey", F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority")
    )
    store.upsert(ORDER_PANEL, orders)
    before = store.file_names(ORDER_PANEL)
    day, n = orders.groupBy("date").count().orderBy(F.desc("count"), "date").first()
    again = orders.where(F.col("date") == day).select("date", "o_orderkey", F.round(F.col("price") * 2, 2).alias("price"))
    store.upsert(ORDER_PANEL, again)
    rows = store.read(ORDER_PANEL).withColumn("path", F.substring_index("_metadata.file_path", "/", -2))
    # as many names as the table has files
    names = spark.createDataFrame([(p,) for p in before], "path string")
    gone = len(set(before) - set(store.file_names(ORDER_PANEL)))
    marked = rows.join(names.withColumn("old", F.lit(True)), "path", "left").withColumn("old", F.col("old").isNotNull())
    year = F.year("date") == day.year
    file = F.when(F.col("date") == day, F.when(F.col("old"), "old").otherwise("new")).when(year, "near").when(F.col("old"), "kept").otherwise("rewritten")
    few = F.lit(1 <= gone <= n // per_file + 2)
    return marked.select("date", "o_orderkey", "o_custkey", "price", "priority", file.alias("file"), few.alias("few_rewritten"))
