"""Rows and values that must not get lost without an error."""

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from vendor_files import member_text, put_daily, write_zip, ymd

from panelwright import specs as sp
from panelwright.operators.asof import RightSide, asof_join
from panelwright.operators.reshape import pivot_panel
from panelwright.plans.catalog import _positions
from panelwright.sources import archive, objects
from panelwright.sources.lines import parse_lines
from panelwright.specs import schema_of
from panelwright.store import PanelStore

D1, D2 = date(2024, 1, 2), date(2024, 1, 3)


def asset(day, barrid, price=1.0):
    return (day, barrid, price)


def rows(spark, *values):
    return spark.createDataFrame(list(values), "date date, barrid string, price double")


def test_null_date_or_key_fails_before_anything_is_written(spark, tmp_path):
    store = PanelStore(spark, str(tmp_path))
    for bad in (asset(None, "A"), asset(D1, None)):
        for put in (store.upsert, store.update):
            with pytest.raises(ValueError, match="null key"):
                put(sp.ASSETS, rows(spark, asset(D1, "B"), bad))
    assert store.years(sp.ASSETS) == []


def test_added_columns_live_on(spark, tmp_path):
    store = PanelStore(spark, str(tmp_path))
    store.upsert(sp.ASSETS, rows(spark, asset(D1, "A"), asset(D1, "B")))
    sectors = spark.createDataFrame([("A", date(2020, 1, 1), "tech")], "barrid string, since date, sector string")
    store.update_asof(sp.ASSETS, [RightSide(sectors, "since")], "barrid")
    store.upsert(sp.ASSETS, rows(spark, asset(D1, "B", 5.0), asset(D2, "C")))
    found = {(r.date, r.barrid): (r.price, r.sector) for r in store.read(sp.ASSETS).collect()}
    assert found == {(D1, "A"): (1.0, "tech"), (D1, "B"): (5.0, None), (D2, "C"): (1.0, None)}
    assert "sector" in store.between(sp.ASSETS, D1, D2).columns


@pytest.mark.parametrize("lost", ["!Barrid", "DataDate"])
def test_header_without_a_column_fails(spark, tmp_path, lost):
    spec = sp.RETURNS_DATA
    header = [c for c in spec.raw.fieldNames() if c != lost]
    text = member_text(header, [["1"] * len(header)], spec.skip_lines)
    write_zip(os.path.join(tmp_path, spec.daily_archive(D1)), {spec.daily_member(D1): text})
    with pytest.raises(Exception, match="no column"):
        archive.scan_sessions(spark, str(tmp_path), spec, [D1]).collect()


def test_vectors_of_several_lengths_fail(spark):
    uneven = spark.createDataFrame([([1.0, 2.0],), ([1.0, 2.0, 9.0],)], "x array<double>")
    with pytest.raises(ValueError, match="2 to 3"):
        _positions(uneven)


def test_late_archive_with_an_old_time_is_read(spark, tmp_path):
    spec = sp.RETURNS_DATA
    row = ["A", 10.0, 100.0, "s", "USD", 1.0]
    put_daily(str(tmp_path), spec, D2, [[*row, ymd(D2)]])
    reader = archive.ArchiveStreamReader(spec.raw, {"root": str(tmp_path), "archives": f'["{spec.daily_folder}/*.zip"]', "memberPrefix": spec.member + "."})
    first = reader.latestOffset()
    put_daily(str(tmp_path), spec, D1, [[*row, ymd(D1)]])
    os.utime(os.path.join(tmp_path, spec.daily_archive(D1)), (1, 1))
    fresh = reader.partitions(first, reader.latestOffset())
    assert [os.path.basename(m.archive) for m in fresh] == [os.path.basename(spec.daily_archive(D1))]
    assert len(reader.partitions(reader.initialOffset(), first)) == 1


def test_csv_keeps_every_text(spark, tmp_path):
    texts = [" a ", "", None, 'say "hi"', "x\ny", "a,b", "\\", "\r\n", '"', "null", " ", "tab\t"]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    objects.write_csv(frame, f"{tmp_path}/c")
    back = objects.read_csv(spark, f"{tmp_path}/c", frame.schema)
    assert dict(map(tuple, back.collect())) == dict(enumerate(texts))


@pytest.mark.parametrize("line", ["a|1|extra", "a", 'a|"1', '"a|1'])
def test_lines_of_another_width_fail(spark, line):
    schema = schema_of("name string, n bigint")
    good = spark.createDataFrame([('"x|y"|2',), ("b|",), (sp.END_OF_FILE,)], "line string")
    assert [tuple(r) for r in parse_lines(good, schema).collect()] == [("x|y", 2), ("b", None), (sp.END_OF_FILE, None)]
    with pytest.raises(Exception, match="unclosed quote"):
        parse_lines(good.union(spark.createDataFrame([(line,)], "line string")), schema).collect()


def test_pivot_guard_holds_whatever_is_selected(spark):
    long = spark.createDataFrame([(1, "a", 2.0), (1, "a", 3.0)], "k int, name string, v double")
    for columns in (["a"], ["k"], ["k", "a"]):
        with pytest.raises(Exception, match="repeated"):
            pivot_panel(long, ["k"], "name", "v", ["a"]).select(*columns).collect()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_nearest_in_any_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        left = spark.createDataFrame([(1, datetime(2024, 3, 10, 3, 10))], "k int, t timestamp_ntz")
        right = spark.createDataFrame([(1, datetime(2024, 3, 10, 1, 50), "80"), (1, datetime(2024, 3, 10, 3, 40), "30")], "k int, u timestamp_ntz, v string")
        assert asof_join(left, right, "t", "u", "k", "nearest").first()["v"] == "30"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_nearest_of_large_integers(spark):
    at = 1_700_000_000_000_000_100
    left = spark.createDataFrame([(1, at)], "k int, t long")
    right = spark.createDataFrame([(1, at - 100, "far"), (1, at + 1, "near")], "k int, u long, v string")
    assert asof_join(left, right, "t", "u", "k", "nearest").first()["v"] == "near"


def test_hot_instant_in_one_partition_is_split(spark):
    left = spark.range(4000).select(F.lit(1).alias("k"), F.lit(5).cast("long").alias("t"), "id").coalesce(1)
    right = spark.createDataFrame([(1, 3, "x"), (1, 9, "y")], "k int, u long, v string")
    found = asof_join(left, right, "t", "u", "k", rows_per_range=100)
    assert found.groupBy("v").count().collect()[0][:] == ("x", 4000)
