"""The operators over the test tables, one query each, all over whole tables.

Roles: ``orders`` and ``lineitem`` are dated panels, ``events`` the as-of and fill input, ``embeddings`` the factor
exposures (one factor per position).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions import frames as FR
from panelwright.functions import scalars as S
from panelwright.operators import matrix as M
from panelwright.operators.asof import RightSide, asof_join, asof_update, asof_update_many
from panelwright.operators.calendar import last_sessions, with_previous
from panelwright.operators.fill import forward_fill
from panelwright.operators.keyed import dedupe_latest, merge_widen, update, upsert
from panelwright.operators.reshape import pivot_panel, unpivot_panel
from panelwright.operators.universe import base_universe, membership
from panelwright.plans import api, index, prices
from panelwright.plans.vendor import clean, clean_volume
from panelwright.session import shared_path
from panelwright.sources import objects
from panelwright.sources.lines import parse_lines
from panelwright.sources.sql import read_range
from panelwright.specs import (
    ASSETS,
    CRSP_DAILY,
    CRSP_EVENTS,
    CRSP_MONTHLY,
    END_OF_FILE,
    RETURNS_DATA,
    RISK_DATA,
    SPECIFIC_RETURNS_DATA,
    VOLUME_DATA,
    schema_of,
    table,
)
from panelwright.store import Change, PanelStore
from panelwright.streaming.incremental import start_upsert

#: Rows of a range where a whole table is made one hot key.
HOT_ROWS = 1_000

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _day(column: str) -> Column:
    return F.col(column).cast("date")


def _sum(column: str) -> Column:
    return F.round(F.sum(column), 2)


# --- matrices -------------------------------------------------------------------------------------


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exposure vectors; the specific risk in percent is one above the label."""
    return _t(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        "label",
        F.col("embedding").cast("array<double>").alias("x"),
        (F.col("label") + 1).cast("double").alias("specific_risk"),
    )


def _positions(vectors: DataFrame) -> list[int]:
    """0 .. width - 1 of the vectors, which must all be of one length."""
    least, most = vectors.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if least != most:
        raise ValueError(f"vectors of {least} to {most} numbers")
    return list(range(most))


def _cov_cells(vectors: DataFrame, panel: list[str], asset: str = "id") -> DataFrame:
    gram = M.sample_covariance(vectors, panel)
    risky = vectors.withColumn("variance", S.squared(S.from_percent(F.col("specific_risk"))))
    return M.asset_covariance(risky, gram, panel, asset, sizes=gram)


@query
def factor_cov(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _cov_cells(_vectors(spark, sf_dir), [])
    return cells.select("id_i", "id_j", S.rounded(F.col("value"), 6).alias("value"))


@query
def factor_cov_by_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _cov_cells(_vectors(spark, sf_dir), ["label"])
    return cells.select("label", "id_i", "id_j", S.rounded(F.col("value"), 6).alias("value"))


@query
def cov_submatrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix between the newest vector of each label, wide; both axes are cut down before the product."""
    vectors = _vectors(spark, sf_dir)
    labels = [r[0] for r in FR.distinct_sorted(vectors, "label").collect()]
    chosen = vectors.groupBy("label").agg(F.max("id").alias("id"))
    kernel = M.sample_covariance(vectors)
    risky = vectors.withColumn("variance", S.squared(S.from_percent(F.col("specific_risk")))).drop("label")
    names = chosen.select("id", F.concat(F.lit("l"), "label").alias("ticker"))
    named = M.relabel(FR.keep_members(risky, chosen, "id"), names, "id")
    wide = M.wide_cells(M.asset_covariance(named, kernel, asset="ticker"), [f"l{v}" for v in labels])
    return wide.select("ticker", *[F.round(f"l{v}", 6).alias(f"l{v}") for v in labels])


@query
def cov_relabel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids become names where one is known, before the product: documents of known quality name the vector with their id."""
    vectors = _vectors(spark, sf_dir)
    known = _t(spark, sf_dir, "labels").where("quality = 1").select(F.col("doc_id").alias("id"))
    names = known.select("id", F.concat(F.lit("doc-"), "id").alias("ticker"))
    cells = _cov_cells(M.relabel(vectors, names, "id"), ["label"], "ticker")
    return cells.select("label", F.col("id_i").alias("ticker_i"), F.col("id_j").alias("ticker_j"), S.rounded(F.col("value"), 6).alias("value"))


@query
def symmetric_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = M.symmetric_fill(M.covariance_cells(M.sample_covariance(_vectors(spark, sf_dir))))
    return filled.select("factor_1", "factor_2", F.round("covariance", 8).alias("covariance"))


@query
def specific_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exposures and risk joined by key; risk is known for labelled documents only."""
    vectors = _vectors(spark, sf_dir).select("id", F.size("x").alias("width"))
    risk = _t(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), (F.col("quality") + 2 * F.col("toxic") + 1).alias("specific_risk"))
    joined = M.with_variance(vectors, risk, ["id"], strict=False)
    return joined.select("id", "width", F.round("variance", 8).alias("variance"))


# --- as-of joins and fills ------------------------------------------------------------------------


def _events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = _t(spark, sf_dir, "events")
    others = events.where("event_type <> 'purchase'").select(
        "user_id", "ts", F.col("event_id").alias("match_id"), F.col("value").alias("match_value")
    )
    return events.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), others


def _asof(spark: SparkSession, sf_dir: str, strategy: str) -> DataFrame:
    left, right = _events(spark, sf_dir)
    out = asof_join(left, right, "ts", "ts", "user_id", strategy, ["match_id", "match_value"], tie_break=["match_id"])
    return out.select("event_id", "user_id", "match_id", "match_value")


@query
def asof_backward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _asof(spark, sf_dir, "backward")


@query
def asof_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _asof(spark, sf_dir, "forward")


@query
def asof_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _asof(spark, sf_dir, "nearest")


@query
def asof_backward_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events are one key; it is parted into ranges."""
    left, right = (side.withColumn("user_id", F.lit(1)) for side in _events(spark, sf_dir))
    matched = asof_join(left, right, "ts", "ts", "user_id", "backward", ["match_id"], tie_break=["match_id"], rows_per_range=HOT_ROWS)
    return matched.select("event_id", "match_id")


@query
def forward_fill_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events are one key; the fill goes range by range."""
    events = _t(spark, sf_dir, "events")
    marked = events.select("event_id", F.lit(1).alias("one"), "ts", F.when(F.col("event_type") == "purchase", F.col("value")).alias("last_purchase"))
    filled = forward_fill(marked, "one", ["ts", "event_id"], ["last_purchase"], rows_per_range=HOT_ROWS)
    return filled.select("event_id", "last_purchase")


@query
def asof_update_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of the last other event replace a purchase's, unless they are null (errors carry none)."""
    events = _t(spark, sf_dir, "events")
    left = events.where("event_type = 'purchase'").select("user_id", "ts", "event_id", "value")
    right = events.where("event_type <> 'purchase'").select(
        "user_id",
        F.col("ts").alias("start_ts"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.col("event_type").alias("kind"),
        F.col("event_id").alias("order_id"),
    )
    out = asof_update(left, right, "ts", "start_ts", "user_id", drop_right_cols=["order_id"], tie_break=["order_id"])
    return out.drop("ts")


@query
def asof_several_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three interval maps put into one panel in one pass, later maps over earlier ones."""
    events = _t(spark, sf_dir, "events")

    def side(kind: str, *columns: Column) -> RightSide:
        rows = events.where(F.col("event_type") == kind).select("user_id", F.col("ts").alias("start_ts"), *columns)
        return RightSide(rows, "start_ts", ("event_id",), ("event_id",))

    rights = [
        side("signup", F.col("value").alias("plan"), "event_id"),
        side("error", F.col("props").alias("last_error"), "event_id"),
        side("click", F.when(F.col("value") > 20, F.col("value")).alias("plan"), "event_id"),
    ]
    left = events.where("event_type = 'view'").select("event_id", "user_id", "ts", F.lit(None).cast("double").alias("plan"))
    out = asof_update_many(left, rights, "ts", "user_id")
    return out.select("event_id", "user_id", "plan", "last_error")


@query
def forward_fill_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _t(spark, sf_dir, "events")
    marked = events.select(
        "event_id", "user_id", "ts",
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("last_purchase"),
        F.when(F.col("event_type") == "error", F.col("event_id")).alias("last_error_id"),
    )
    filled = forward_fill(marked, "user_id", ["ts", "event_id"], ["last_purchase", "last_error_id"])
    return filled.select("event_id", "user_id", "last_purchase", "last_error_id")


# --- keyed updates --------------------------------------------------------------------------------


def _shipments(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Stored: goods kept, per day and supplier. Incoming: goods returned, small prices unknown."""
    lines = _t(spark, sf_dir, "lineitem").withColumn("ship_date", _day("l_shipdate"))
    keys = ["ship_date", "l_suppkey"]
    stored = lines.where("l_returnflag <> 'R'").groupBy(*keys).agg(
        _sum("l_quantity").alias("qty"), _sum("l_extendedprice").alias("price"), F.max("l_discount").alias("discount")
    )
    price = _sum("l_extendedprice")
    incoming = lines.where("l_returnflag = 'R'").groupBy(*keys).agg(
        _sum("l_quantity").alias("qty"), F.when(price >= 30000, price).alias("price"), F.max("l_tax").alias("tax")
    )
    return stored, incoming


KEYS = ["ship_date", "l_suppkey"]


@query
def upsert_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert(*_shipments(spark, sf_dir), KEYS)


@query
def update_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return update(*_shipments(spark, sf_dir), KEYS)


@query
def merge_widen_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_widen(*_shipments(spark, sf_dir), KEYS, "full")


@query
def merge_widen_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_widen(*_shipments(spark, sf_dir), KEYS, "left")


@query
def merge_widen_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_widen(*_shipments(spark, sf_dir), KEYS, "inner")


@query
def dedupe_latest_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _t(spark, sf_dir, "orders").select(
        "o_custkey", _day("o_orderdate").alias("order_date"), "o_orderkey", "o_totalprice", "o_orderpriority"
    )
    return dedupe_latest(orders, ["o_custkey"], ["order_date", "o_orderkey"])


# --- reshaping ------------------------------------------------------------------------------------

RETURN_FLAGS = ["A", "N", "R"]


def _flag_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _t(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.year("l_shipdate").alias("ship_year"), "l_returnflag", "l_quantity"
    )
    cells = lines.groupBy("l_suppkey", "ship_year", "l_returnflag").agg(_sum("l_quantity").alias("qty"))
    return pivot_panel(cells, ["l_suppkey", "ship_year"], "l_returnflag", "qty", [*RETURN_FLAGS, "X"])


@query
def pivot_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flag_panel(spark, sf_dir)


@query
def unpivot_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unpivot_panel(_flag_panel(spark, sf_dir), ["l_suppkey", "ship_year"], [*RETURN_FLAGS, "X"], "flag", "qty")


@query
def pivot_exposures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long exposures to one column per factor."""
    vectors = _vectors(spark, sf_dir)
    names = [f"f{i}" for i in _positions(vectors)]
    long = vectors.select("label", "id", F.posexplode("x").alias("__p", "value")).withColumn("factor", F.concat(F.lit("f"), "__p"))
    return pivot_panel(long, ["label", "id"], "factor", "value", names)


@query
def unique_key_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that repeat, as the pivot guard would report them."""
    lines = _t(spark, sf_dir, "lineitem")
    return lines.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


# --- universe and calendar ------------------------------------------------------------------------


def _panel_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One asset per customer and order day; customers in debt are no primary listings."""
    nations = _t(spark, sf_dir, "nation").join(_t(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    people = _t(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    days = _t(spark, sf_dir, "orders").groupBy("o_custkey", _day("o_orderdate").alias("date")).agg(
        _sum("o_totalprice").alias("price")
    )
    ident = F.col("c_custkey").cast("string")
    return days.join(people, F.col("o_custkey") == F.col("c_custkey")).select(
        "date",
        ident.alias("barrid"),
        F.when(F.col("c_acctbal") >= 0, ident).otherwise(F.lit("parent")).alias("rootid"),
        F.when(F.col("r_name") != "ASIA", F.lit("USA")).otherwise(F.lit("CHN")).alias("iso_country_code"),
        F.col("c_name").alias("cusip"),
        F.col("price"),
    )


def _holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index holdings on the last order day of each quarter."""
    orders = _t(spark, sf_dir, "orders").withColumn("date", _day("o_orderdate"))
    ends = orders.groupBy(F.trunc("date", "quarter").alias("q")).agg(F.max("date").alias("date")).select("date")
    people = _t(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("cusip"))
    held = orders.join(ends, "date", "left_semi").join(people, F.col("o_custkey") == F.col("c_custkey"))
    return held.select(
        "date",
        "cusip",
        F.when(F.col("o_orderstatus") == "F", F.lit("Y")).alias("russell2000"),
        F.when(F.col("o_totalprice") > 250000, F.lit("Y")).otherwise(F.lit("N")).alias("russell1000"),
    )


@query
def universe_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base_universe(_panel_assets(spark, sf_dir))


@query
def universe_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    universe = base_universe(_panel_assets(spark, sf_dir))
    return membership(universe, index.clean_holdings(_holdings(spark, sf_dir)))


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "orders").select(_day("o_orderdate").alias("date")).distinct()


@query
def calendar_prev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_previous(_sessions(spark, sf_dir))


@query
def calendar_last_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_sessions(_sessions(spark, sf_dir), date(1998, 6, 13), 60)


# --- filters, sets, scalars -----------------------------------------------------------------------


@query
def latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", _day("o_orderdate").alias("order_date"))
    return FR.at_latest(orders, "order_date")


@query
def semi_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = _t(spark, sf_dir, "part").where("p_size >= 40").select(F.col("p_partkey").alias("l_partkey"))
    lines = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return FR.keep_members(lines, large, "l_partkey")


@query
def validity_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines under way on a day: ordered by it, shipped on it or later."""
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", _day("o_orderdate").alias("start_date"))
    lines = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", _day("l_shipdate").alias("end_date"))
    spans = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    on = spans.where(S.in_force(date(1998, 6, 15), F.col("start_date"), F.col("end_date")))
    return on.select("l_orderkey", "l_linenumber", "start_date", "end_date")


@query
def predicate_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equality, membership, containment and three-valued disjunction on parts."""
    parts = _t(spark, sf_dir, "part")
    small = F.when(F.col("p_size") != 25, F.col("p_size") < 10)  # null at 25
    cheap = F.when(F.col("p_brand") != "Brand#1", F.col("p_retailprice") < 950)
    kept = parts.where(
        (small | cheap)
        & F.col("p_type").isin("ECONOMY", "STANDARD", "PROMO")
        & S.contains(F.col("p_name"), "r")
        & F.col("p_brand").isNotNull()
        & (F.col("p_type") != "PROMO")
    )
    return kept.select("p_partkey", "p_name", "p_type", "p_size")


@query
def column_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose part and supplier numbers agree."""
    lines = _t(spark, sf_dir, "lineitem")
    return lines.where(F.col("l_partkey") == F.col("l_suppkey")).select("l_orderkey", "l_linenumber", "l_partkey")


@query
def first_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "part").select("p_partkey", S.replace_first(F.col("p_name"), "i").alias("name"))


@query
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _t(spark, sf_dir, "lineitem")
    returned = S.is_yes(F.when(F.col("l_returnflag") == "R", F.lit("Y")).when(F.col("l_returnflag") == "A", F.lit("N")))
    open_line = F.when(F.col("l_quantity") > 25, F.col("l_linestatus") == "O")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        F.year("l_shipdate").alias("ship_year"),
        F.round(S.to_percent(F.col("l_discount")), 6).alias("discount_pct"),
        F.round(S.from_percent(F.col("l_tax")), 6).alias("tax_frac"),
        F.round(S.from_percent_squared(F.col("l_quantity")), 8).alias("qty_scaled"),
        F.round(S.squared(F.col("l_quantity")), 4).alias("qty_squared"),
        S.fill_null(returned, False).alias("returned_filled"),
        (returned | open_line).alias("either"),
        F.when(returned, F.coalesce(open_line, F.lit(False))).alias("when_returned"),
        S.literal(None, "double").alias("nothing"),
    )


@query
def parse_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor text made from the orders, with a trailer per year, back to typed rows."""
    return _asset_lines(spark, sf_dir).transform(
        lambda lines: clean(parse_lines(lines, RETURNS_DATA.raw)).select("date", "barrid", "price", "currency")
    )


def _asset_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _panel_assets(spark, sf_dir).select("date", "barrid", "price")
    text = F.concat_ws("|", "barrid", F.col("price").cast("string"), F.lit(""), F.lit("src"), F.lit("USD"), F.lit(""), F.date_format("date", "yyyyMMdd"))
    trailers = days.select(F.year("date")).distinct().select(F.lit(END_OF_FILE).alias("line"))
    return days.select(text.alias("line")).unionByName(trailers)


@query
def padded_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.format_string("   %.2f  ", F.col("s_acctbal"))
    return _t(spark, sf_dir, "supplier").select("s_suppkey", S.padded_double(padded).alias("acctbal"))


@query
def concat_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = _t(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal")
    )
    customers = _t(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal")
    )
    return suppliers.unionByName(customers)


@query
def distinct_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FR.distinct_sorted(_t(spark, sf_dir, "orders").select(_day("o_orderdate").alias("order_date")), "order_date")


@query
def distinct_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FR.distinct_sorted(_t(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("ship_year")), "ship_year")


@query
def date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First start and last end of the lines' spans, the end capped at a day."""
    lines = _t(spark, sf_dir, "lineitem")
    cap = F.lit(date(2000, 6, 30))
    return lines.agg(
        F.min(_day("l_shipdate")).alias("first_day"), F.least(F.max(_day("l_shipdate")), cap).alias("last_day")
    )


@query
def left_join_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left join on a composite key: repeats fan out, missing keys give null."""
    lines = _t(spark, sf_dir, "lineitem").select("l_suppkey", _day("l_shipdate").alias("day"), "l_quantity")
    orders = _t(spark, sf_dir, "orders").select(
        (F.col("o_custkey")).alias("l_suppkey"), _day("o_orderdate").alias("day"), "o_orderkey"
    )
    return lines.join(orders, ["l_suppkey", "day"], "left").select("l_suppkey", "day", "l_quantity", "o_orderkey")


@query
def sql_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date range, column subset and declared types over a table source."""
    source = _t(spark, sf_dir, "orders").select(
        _day("o_orderdate").alias("date"), F.col("o_orderkey").alias("permno"), F.col("o_totalprice").alias("prc"),
        F.col("o_orderpriority").alias("event"),
    )
    schema = schema_of("date date, permno bigint, prc double")
    return read_range(spark, source, schema, date(1996, 3, 1), date(1999, 9, 30), F.col("event") == "2-HIGH")


@query
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as CSV files with a header and read back with declared types."""
    path = shared_path(spark, "csv")
    orders = _t(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", _day("o_orderdate").alias("order_date"), "o_totalprice",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
    )
    objects.write_csv(orders, path)
    return objects.read_csv(spark, path, orders.schema)


@query
def matrix_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matrices written one partition per panel, one panel then written again; both steps keep the rest."""
    path = shared_path(spark, "matrix")
    cells = _cov_cells(_vectors(spark, sf_dir), ["label"])
    objects.write_parquet(cells.select("label", "id_i", "id_j", S.rounded(F.col("value"), 6).alias("value")), path, "label")
    first = spark.read.parquet(path)
    objects.write_parquet(FR.at_latest(first, "label").withColumn("value", -F.col("value")), path, "label")
    return spark.read.parquet(path).select("label", "id_i", "id_j", "value")


# --- stored tables and jobs -----------------------------------------------------------------------


def _store(spark: SparkSession) -> PanelStore:
    return PanelStore(spark, shared_path(spark, "store"))


def _vendor_text(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Parsed raw frames of the four asset feeds, from orders (returns) and lineitem (the rest)."""
    lines = _t(spark, sf_dir, "lineitem").join(
        _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    days = lines.groupBy(F.col("o_custkey").cast("string").alias("!Barrid"), F.date_format("o_orderdate", "yyyyMMdd").alias("DataDate"))
    kept = lines.where("l_returnflag = 'R'").groupBy(
        F.col("o_custkey").cast("string").alias("!Barrid"), F.date_format("l_shipdate", "yyyyMMdd").alias("DataDate")
    )
    returns = parse_lines(_asset_lines(spark, sf_dir), RETURNS_DATA.raw)
    specific = days.agg(_sum("l_tax").alias("SpecificReturn"))
    risk = kept.agg(_sum("l_discount").alias("SpecRisk%"), F.max("l_tax").alias("Yield%"))
    volume = days.agg(_sum("l_quantity").alias("DailyVolume"))
    volume = FR.add_missing_columns(volume, VOLUME_DATA.raw)
    return [
        returns,
        specific.select(SPECIFIC_RETURNS_DATA.raw.fieldNames()),
        FR.add_missing_columns(risk, RISK_DATA.raw),
        volume,
    ]


@query
def asset_feeds_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns make the asset rows, three feeds fill them in; one rewrite of the stored table."""
    store = _store(spark)
    returns, specific, risk, volume = _vendor_text(spark, sf_dir)
    changes = [Change(clean(returns), True), Change(clean(specific), False), Change(clean(risk), False), Change(clean_volume(volume), False)]
    store.apply(ASSETS, changes)
    return store.read(ASSETS).select(
        "date", "barrid", "price", "currency", "specific_return", "specific_risk", "yield", "daily_volume"
    )


@query
def stored_asof_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored asset rows take the name of the customer's last shipped part as of their day."""
    store = _store(spark)
    assets = _panel_assets(spark, sf_dir)
    store.upsert(ASSETS, assets)
    shipped = (
        _t(spark, sf_dir, "lineitem")
        .join(_t(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(_t(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(F.col("o_custkey").cast("string").alias("barrid"), _day("l_shipdate").alias("start_date"), "l_partkey", F.col("p_name").alias("name"))
    )
    maps = shipped.groupBy("barrid", "start_date").agg(F.max_by("name", "l_partkey").alias("name"))
    store.update_asof(ASSETS, [RightSide(maps, "start_date", ("start_date",))], "barrid")
    return store.read(ASSETS).select("date", "barrid", "name", "cusip", "price")


@query
def index_flags_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership flags put into the stored assets, then the universe of three years."""
    store = _store(spark)
    store.upsert(ASSETS, _panel_assets(spark, sf_dir))
    index.backfill(store, _holdings(spark, sf_dir), date(1995, 1, 1), date(1999, 12, 31))
    columns = ["date", "barrid", "russell_1000", "russell_2000", "in_universe", "price"]
    return api.load_assets(store, date(1997, 1, 1), date(2000, 12, 31), columns, in_universe=True)


@query
def index_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same flags by three runs, each from the state that the one before it has left; the last one goes back a year."""
    store, held = _store(spark), _holdings(spark, sf_dir)
    store.upsert(ASSETS, _panel_assets(spark, sf_dir))
    for start, end in ((date(1995, 1, 1), date(1996, 2, 10)), (date(1996, 2, 11), date(1998, 3, 1)), (date(1997, 3, 1), date(1999, 12, 31))):
        index.increment(store, held, start, end)
    columns = ["date", "barrid", "russell_1000", "russell_2000", "in_universe", "price"]
    return api.load_assets(store, date(1997, 1, 1), date(2000, 12, 31), columns, in_universe=True)


@query
def panel_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date range of stored rows; the years outside are pruned."""
    store = _store(spark)
    store.upsert(ASSETS, _panel_assets(spark, sf_dir))
    return api.load_assets(store, date(1996, 5, 1), date(1998, 2, 28), ["date", "barrid", "cusip", "price"])


def _price_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _t(spark, sf_dir, "lineitem").groupBy(_day("l_shipdate").alias("date"), F.col("l_partkey").alias("permno"))
    return lines.agg(
        F.max("l_returnflag").alias("cusip"), F.max("l_tax").alias("ret"), F.min("l_tax").alias("retx"),
        _sum("l_extendedprice").alias("prc"), F.sum("l_quantity").alias("vol"), F.min("l_extendedprice").alias("openprc"),
        F.max("l_extendedprice").alias("askhi"), F.min("l_quantity").alias("bidlo"), F.count(F.lit(1)).alias("shrout"),
    )


@query
def price_daily_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily prices of whole years, although the range ends inside one."""
    store = _store(spark)
    prices.daily(store, _price_source(spark, sf_dir), date(1996, 7, 1), date(1999, 3, 31))
    return store.read(CRSP_DAILY)


@query
def price_monthly_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark)
    prices.monthly(store, _price_source(spark, sf_dir), date(1996, 7, 1), date(1999, 3, 31))
    return store.read(CRSP_MONTHLY)


@query
def price_events_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark)
    source = (
        _t(spark, sf_dir, "orders")
        .groupBy(_day("o_orderdate").alias("date"), F.col("o_custkey").alias("permno"))
        .agg(
            F.max("o_orderpriority").alias("ticker"), F.count(F.lit(1)).alias("shrcd"), F.max("o_orderkey").alias("exchcd"),
            F.when(F.max("o_orderstatus") == "P", F.lit("NAMES")).otherwise(F.lit("DIST")).alias("event"),
        )
    )
    prices.events(store, source, date(1996, 7, 1), date(1999, 3, 31))
    return store.read(CRSP_EVENTS)


ORDER_PANEL = table(
    "order_panel", "date o_orderkey", "date date, o_orderkey bigint, o_custkey bigint, price double, priority string"
)


@query
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored orders kept current by a stream; orders already stored keep values the stream leaves out."""
    store = _store(spark)
    orders = _t(spark, sf_dir, "orders").select(
        _day("o_orderdate").alias("date"), "o_orderkey", "o_custkey",
        F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority"), "o_orderstatus",
    )
    store.upsert(ORDER_PANEL, orders.where("o_orderstatus <> 'O'"))
    raw = _t(spark, sf_dir, "orders").schema
    stream = spark.readStream.schema(raw).option("pathGlobFilter", "orders.parquet").parquet(sf_dir)

    def corrected(batch: DataFrame) -> DataFrame:
        rows = batch.where("o_orderstatus <> 'F'")
        return rows.select(
            _day("o_orderdate").alias("date"), "o_orderkey",
            F.when(F.col("o_totalprice") > 100000, F.round(F.col("o_totalprice") * 2, 2)).alias("price"),
            F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("rush")).alias("priority"),
        )

    start_upsert(store, ORDER_PANEL, stream, shared_path(spark, "stream"), corrected).awaitTermination()
    return store.read(ORDER_PANEL)
