"""Jobs end to end over small archive trees."""

import os
import time
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F
from vendor_files import put_daily, put_history, ymd

from panelwright import specs as sp
from panelwright.plans import api, composite, risk
from panelwright.plans import vendor as v
from panelwright.store import PanelStore
from panelwright.streaming.incremental import start_feed

D1, D2, D3 = date(2023, 12, 29), date(2024, 1, 2), date(2024, 1, 3)
SESSIONS = [date(2023, 12, 28), D1, D2, D3, date(2024, 1, 4)]
TODAY = date(2024, 1, 4)
ASSETS = ["USA1", "USA2", "CAN3"]
F1, F2 = sp.FACTORS[0], sp.FACTORS[1]
FOREVER = "20991231"


def returns(d, b, price=10.0):
    return [b, price, 100.0, "src", "USD", 1.25, ymd(d)]


def risk_row(d, b, spec=20.0):
    return [b, 1.0, 25.0, spec, 1.1, 1.2, ymd(d)]


def volume(d, b):
    return [b, 1000.0, 1.0, 2.0, 3.0, 0.5, 4.0, 5.0, 6.0, ymd(d)]


def exposures(d, assets=ASSETS):
    return [[b, f, float(i + 1) * (j + 1) / 10, ymd(d)] for i, b in enumerate(assets) for j, f in enumerate(sp.FACTORS)]


def covariances(d):
    # one triangle, padded with blanks
    n = len(sp.FACTORS)
    return [
        [sp.FACTORS[i], sp.FACTORS[j], f"  {(100.0 if i == j else 10.0 / (1 + j - i)):.6f} ", ymd(d)]
        for i in range(n)
        for j in range(i, n)
    ]


def covariance_matrix():
    n = len(sp.FACTORS)
    return np.array([[100.0 if i == j else round(10.0 / (1 + abs(j - i)), 6) for j in range(n)] for i in range(n)])


def ids():
    return [
        ["USA1", "LOCALID", "USXUSA", "20200101", FOREVER],
        ["USA1", "CUSIP", "C1-old", "20200101", "20240101"],
        ["USA1", "CUSIP", "C1-new", "20240102", FOREVER],
        ["USA2", "LOCALID", "USTWO", "20240103", FOREVER],
        ["CAN3", "LOCALID", "CATHREE", "20200101", FOREVER],
        ["USA2", "SEDOL", "S2", "20200101", FOREVER],
    ]


def identity():
    return [
        ["USA1", "One", "STOCK", "I1", "USA", "USD", "USA1", "20200101", FOREVER],
        ["USA2", "Two", "ETF", "I2", "USA", "USD", "USA2", "20200101", FOREVER],
        ["CAN3", "Three", "STOCK", "I3", "CAN", "CAD", "CAN3", "20200101", FOREVER],
    ]


@pytest.fixture
def jobs(spark, tmp_path):
    root = str(tmp_path / "archive")
    for d in (D1, D3):  # D2 has no archive
        put_daily(root, sp.RETURNS_DATA, d, [returns(d, b) for b in ASSETS])
        put_daily(root, sp.SPECIFIC_RETURNS_DATA, d, [["USA1", 0.5, ymd(d)], ["GHOST", 0.1, ymd(d)]])
        put_daily(root, sp.RISK_DATA, d, [risk_row(d, b) for b in ASSETS])
        put_daily(root, sp.VOLUME_DATA, d, [volume(d, b) for b in ASSETS])
        put_daily(root, sp.EXPOSURE_DATA, d, exposures(d))
        put_daily(root, sp.COVARIANCE_DATA, d, covariances(d))
    put_daily(root, sp.FACTOR_RETURN_DATA, D3, [[F1, 0.01, ymd(D3)], [F2, -0.02, ymd(D3)]])
    put_daily(root, sp.IDS_DATA, D3, ids())
    put_daily(root, sp.IDENTITY_DATA, D3, identity())
    calendar = spark.createDataFrame([(d,) for d in [*SESSIONS, date(2024, 1, 5)]], "date date")
    return v.VendorJobs(PanelStore(spark, str(tmp_path / "db")), root, calendar, TODAY)


def asset(jobs, d, b):
    return jobs.store.read(sp.ASSETS).where((F.col("date") == d) & (F.col("barrid") == b)).first()


def test_daily_composite(jobs):
    composite.risk_model_daily(jobs)
    store = jobs.store
    assets = store.read(sp.ASSETS)
    assert assets.columns == sp.ASSETS.columns and assets.count() == 6  # GHOST has no returns
    assert store.years(sp.ASSETS) == [2023, 2024]
    one = asset(jobs, D3, "USA1")
    assert (one["price"], one["return"], one["specific_return"], one["total_risk"]) == (10.0, 1.25, 0.5, 25.0)
    assert (one["daily_volume"], one["average_daily_volume_90"], one["average_daily_bid_ask_spread_30"]) == (1000.0, 3.0, 4.0)
    assert (one["ticker"], one["cusip"], one["name"], one["rootid"]) == ("XUSA", "C1-new", "One", "USA1")
    assert asset(jobs, D1, "USA1")["cusip"] == "C1-old"
    assert asset(jobs, D1, "USA2")["ticker"] is None and asset(jobs, D3, "USA2")["ticker"] == "TWO"
    assert asset(jobs, D3, "CAN3")["ticker"] is None
    panel = store.read(sp.EXPOSURES)
    assert panel.count() == 6 and panel.where(F.col("barrid") == "USA2").first()[F2] == pytest.approx(0.4)
    assert store.read(sp.COVARIANCES).count() == 2 * len(sp.FACTORS)
    factor = store.read(sp.FACTOR_RETURNS).first()
    assert (factor["date"], factor[F1], factor[F2], factor[sp.FACTORS[2]]) == (D3, 1.0, -2.0, None)

    before = sorted(map(str, assets.collect()))
    composite.risk_model_daily(jobs)
    assert sorted(map(str, store.read(sp.ASSETS).collect())) == before

    # queries over the result
    got = api.load_assets(store, D1, D1, ["date", "barrid", "price"])
    assert got.count() == 3 and got.columns == ["date", "barrid", "price"]
    assert api.load_assets_by_date(store, D3, ["barrid"], in_universe=True).count() == 0
    assert dict(api.assets_columns())["in_universe"] == "boolean"
    listed = store.read(sp.ASSETS).where(F.col("iso_country_code") == "USA").select("barrid").distinct()
    cells = {(r.id_i, r.id_j): r.value for r in api.construct_covariance_matrix(store, D3, listed).collect()}
    x = np.array([[(i + 1) * (j + 1) / 10 for j in range(len(sp.FACTORS))] for i in range(2)])
    sigma = x @ (covariance_matrix() / 1e4) @ x.T + np.diag([0.04, 0.04])
    for i, a in enumerate(["USA1", "USA2"]):
        for j, b in enumerate(["USA1", "USA2"]):
            assert cells[a, b] == pytest.approx(sigma[i, j], rel=1e-12)
    assert len(cells) == 4


def test_index_job_and_sub_matrix(spark, jobs):
    jobs.daily(v.RETURNS_FEED, v.RISK_FEED)
    jobs.daily(v.EXPOSURE_FEED)
    jobs.daily(v.COVARIANCE_FEED)
    jobs.map_intervals()
    holdings = spark.createDataFrame(
        [(D1, "C1-old", None, "Y"), (D3, "zzz", "Y", "Y")], "date date, cusip string, russell2000 string, russell1000 string"
    )
    composite.index_backfill(jobs.store, holdings, TODAY)
    one = asset(jobs, D3, "USA1")
    assert (one["russell_1000"], one["russell_2000"], one["in_universe"]) == (True, False, True)
    assert asset(jobs, D1, "USA2")["in_universe"] is False and asset(jobs, D1, "CAN3")["in_universe"] is None
    wide = api.covariance_by_ticker(jobs.store, D3, ["XUSA", "TWO"])
    assert wide.columns == ["ticker", "TWO", "XUSA"]
    assert [tuple(r)[0] for r in wide.collect()] == ["XUSA"]  # TWO is not in the universe
    assert wide.first()["TWO"] is None and wide.first()["XUSA"] > 0


def test_single_jobs_and_null_values_keep_what_is_stored(jobs):
    jobs.daily(v.RETURNS_FEED)
    jobs.daily(v.RISK_FEED)
    early = date(2023, 12, 28)
    put_daily(jobs.archive_root, sp.RETURNS_DATA, early, [returns(early, "USA1", None)])
    put_daily(jobs.archive_root, sp.SPECIFIC_RETURNS_DATA, early, [["USA1", None, ymd(early)]])
    jobs.daily(v.RETURNS_FEED)
    assert asset(jobs, early, "USA1")["price"] is None
    assert asset(jobs, D3, "USA1")["total_risk"] == 25.0
    jobs.daily(v.SPECIFIC_RETURNS_FEED)
    jobs.daily(v.VOLUME_FEED)
    assert asset(jobs, D3, "USA1")["specific_return"] == 0.5


def test_map_past_its_reach_leaves_later_years(spark, jobs):
    jobs.daily(v.RETURNS_FEED)
    jobs.map_intervals()
    ended = [r[:-1] + ["20231231"] for r in ids()]
    put_daily(jobs.archive_root, sp.IDS_DATA, date(2024, 1, 4), [r[:2] + ["US" + r[2] + "-x"] + r[3:] for r in ended])
    later = v.VendorJobs(jobs.store, jobs.archive_root, jobs.calendar, date(2024, 1, 5))
    later.map_intervals(v.TICKERS)
    assert asset(jobs, D1, "USA1")["ticker"] == "USXUSA-x"
    assert asset(jobs, D3, "USA1")["ticker"] == "XUSA"  # 2024 lies past the last end date


def test_backfill(spark, jobs, tmp_path):
    root = jobs.archive_root
    for y, d in ((2023, D1), (2024, D2)):
        put_history(root, sp.RETURNS_DATA, y, {d: [returns(d, b) for b in ASSETS]})
        put_history(root, sp.SPECIFIC_RETURNS_DATA, y, {d: [["USA1", 0.7, ymd(d)]]})
        put_history(root, sp.VOLUME_DATA, y, {d: [volume(d, b) for b in ASSETS]})
        for data, rows in ((sp.RISK_DATA, [risk_row(d, b) for b in ASSETS]), (sp.EXPOSURE_DATA, exposures(d)), (sp.COVARIANCE_DATA, covariances(d))):
            put_history(root, data, y, {d: rows}, suffix="01")
    composite.risk_model_backfill(jobs, D1, D2)
    assert jobs.store.read(sp.ASSETS).count() == 6
    two = asset(jobs, D2, "USA1")
    assert (two["specific_return"], two["specific_risk"], two["ticker"], two["cusip"]) == (0.7, 20.0, "XUSA", "C1-new")
    assert jobs.store.read(sp.EXPOSURES).count() == 6 and jobs.store.read(sp.FACTOR_RETURNS).count() == 0
    other = v.VendorJobs(PanelStore(spark, str(tmp_path / "clipped")), root, jobs.calendar, TODAY)
    other.history(D1, date(2024, 1, 1), v.RETURNS_FEED, clip=True)
    assert other.store.years(sp.ASSETS) == [2023]


def test_price_composite(spark, tmp_path):
    store = PanelStore(spark, str(tmp_path))
    events = spark.createDataFrame(
        [(D1, 1, "T", 10, 1, "NAMES"), (D1, 2, "U", 10, 1, "DIST"), (date(1924, 1, 1), 3, "V", 1, 1, "NAMES")],
        "date date, permno long, ticker string, shrcd int, exchcd int, event string",
    )
    prices = spark.createDataFrame(
        [(D1, 1, "c", "0.5", 0.4, 9.0, 100.0, 1.0, 2.0, 3.0, 7), (D3, 1, "c", None, 0.4, 9.0, None, 1.0, 2.0, 3.0, 7)],
        "date date, permno long, cusip string, ret string, retx double, prc double, vol double, openprc double, askhi double, bidlo double, shrout int",
    )
    composite.price_backfill(store, events, prices, prices, D2)
    assert [r.permno for r in store.read(sp.CRSP_EVENTS).collect()] == [1]
    monthly = store.read(sp.CRSP_MONTHLY).collect()
    assert [(r.date, r.ret, r.vol) for r in monthly] == [(D1, 0.5, 100)]
    assert store.read(sp.CRSP_DAILY).count() == 2  # whole years


def put_matrix_files(root, d):
    put_daily(root, sp.IDS_DATA, d, ids() + [["USA1", "LOCALID", "USOLD", "19990101", "20191231"]])
    put_daily(root, sp.IDENTITY_DATA, d, identity() + [["GONE", "G", "STOCK", "I", "USA", "USD", "GONE", "20000101", "20010101"]])
    stocks, funds = sp.MATRIX_EXPOSURE_DATA
    rows = exposures(d)
    put_daily(root, stocks, d, [r for r in rows if r[0] != "USA2"])
    put_daily(root, funds, d, [r for r in rows if r[0] == "USA2"])
    stock_risk, fund_risk = sp.MATRIX_RISK_DATA
    put_daily(root, stock_risk, d, [risk_row(d, "USA1", 20.0), risk_row(d, "CAN3", 30.0)])
    put_daily(root, fund_risk, d, [risk_row(d, "USA2", 40.0)])
    put_daily(root, sp.MATRIX_COVARIANCE_DATA, d, covariances(d))


def test_daily_matrix(spark, tmp_path):
    root, out = str(tmp_path / "archive"), str(tmp_path / "matrix")
    put_matrix_files(root, D3)
    calendar = spark.createDataFrame([(d,) for d in SESSIONS], "date date")
    assert risk.daily_matrix(spark, root, calendar, TODAY, out, block_size=1) == D3
    got = {(r.ticker_i, r.ticker_j): r.value for r in spark.read.parquet(out).where(F.col("date") == D3).collect()}
    x = np.array([[(i + 1) * (j + 1) / 10 for j in range(len(sp.FACTORS))] for i in range(2)])
    sigma = x @ (covariance_matrix() / 1e4) @ x.T + np.diag([0.04, 0.16])
    assert set(got) == {(a, b) for a in ("XUSA", "TWO") for b in ("XUSA", "TWO")}
    assert got["XUSA", "TWO"] == pytest.approx(sigma[0, 1], rel=1e-12) == got["TWO", "XUSA"]
    assert got["XUSA", "XUSA"] == pytest.approx(sigma[0, 0]) and got["TWO", "TWO"] == pytest.approx(sigma[1, 1])


def test_stream_takes_up_new_and_corrected_archives(spark, jobs, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    start_feed(jobs, v.RETURNS_FEED, checkpoint).awaitTermination()
    assert jobs.store.read(sp.ASSETS).count() == 6
    time.sleep(0.05)
    path = os.path.join(jobs.archive_root, sp.RETURNS_DATA.daily_archive(D3))
    fixed = str(tmp_path / "fixed")
    put_daily(fixed, sp.RETURNS_DATA, D3, [returns(D3, "USA1", 77.0)])
    with open(os.path.join(fixed, sp.RETURNS_DATA.daily_archive(D3)), "rb") as new, open(path, "wb") as old:
        old.write(new.read())
    start_feed(jobs, v.RETURNS_FEED, checkpoint).awaitTermination()
    assert asset(jobs, D3, "USA1")["price"] == 77.0 and asset(jobs, D3, "USA2")["price"] == 10.0
    assert jobs.store.read(sp.ASSETS).count() == 6


def test_a_run_that_broke_off_goes_on_with_the_step_it_had_reached(jobs, monkeypatch):
    done = []
    feeds = type(jobs).daily

    def daily(self, *feed):
        done.append(feed[0].data.name)
        if feed[0].data.name == "covariances" and done.count("covariances") == 1:
            raise OSError("broken off")
        feeds(self, *feed)

    monkeypatch.setattr(type(jobs), "daily", daily)
    with pytest.raises(OSError):
        composite.risk_model_daily(jobs, run="today")
    assert not jobs.store.is_noted("today", "covariances") and jobs.store.is_noted("today", "exposures")
    composite.risk_model_daily(jobs, run="today")
    assert done == ["returns", "exposures", "covariances", "covariances"]
    assert jobs.store.read(sp.COVARIANCES).count() and jobs.store.read(sp.FACTOR_RETURNS).count()
    composite.risk_model_daily(jobs, run="today")
    assert len(done) == 4
    composite.risk_model_daily(jobs, run="tomorrow")
    assert len(done) == 7


def test_matrix_job_fails_on_a_missing_column(spark):
    raw = spark.createDataFrame([], sp.RISK_DATA.raw)
    assert "specific_risk" in risk.named(raw, sp.RISK_DATA).columns
    with pytest.raises(Exception, match="SpecRisk"):
        risk.named(raw.drop("SpecRisk%"), sp.RISK_DATA)


def test_index_increments_go_on_from_the_state_and_leave_old_years_alone(spark, tmp_path):
    from panelwright.plans import index

    days = [date(y, m, d) for y in (2021, 2022, 2023) for m in (3, 6, 9) for d in (1, 15)]
    names = ["A", "B", "C"]
    assets = [(d, b, b, "USA", "c" + b) for d in days for b in names if (b, d.year) != ("C", 2022)]
    held = [(date(2021, 3, 15), "cA", "Y", "N"), (date(2021, 9, 1), "cB", None, "Y"), (date(2021, 9, 1), "cC", "Y", None), (date(2023, 6, 1), "cA", "N", "Y")]
    holdings = spark.createDataFrame(held, index.HOLDINGS)
    columns = "date date, barrid string, rootid string, iso_country_code string, cusip string"
    found = []
    for cuts in ([], [date(2021, 12, 31), date(2022, 7, 1)], days[2:-1:3]):
        store = PanelStore(spark, f"{tmp_path}/{len(cuts)}")
        store.upsert(sp.ASSETS, spark.createDataFrame(assets, columns))
        if cuts:
            for a, b in zip([date(2021, 1, 1), *[date.fromordinal(c.toordinal() + 1) for c in cuts]], [*cuts, date(2023, 12, 31)]):
                if b.year == 2023 and a.year > 2021:  # an unreadable file would be noticed
                    with open(f"{store.path(sp.ASSETS)}/year=2021/part-x.parquet", "w") as bad:
                        bad.write("no parquet")
                index.increment(store, holdings, a, b)
        else:
            index.backfill(store, holdings, date(2021, 1, 1), date(2023, 12, 31))
        kept = store.between(sp.ASSETS, date(2022, 1, 1), date(2023, 12, 31)).select("date", "barrid", "russell_1000", "russell_2000", "in_universe")
        found.append(sorted(map(tuple, kept.collect())))
    assert found[0] == found[1] == found[2] and any(r[2] for r in found[0])
