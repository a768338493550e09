from datetime import date

import pytest

from panelwright.operators.keyed import dedupe_latest, merge_widen, update, upsert

D1, D2 = date(2024, 1, 2), date(2024, 1, 3)
STORED = "date date, barrid string, price double, name string"


@pytest.fixture
def stored(spark):
    return spark.createDataFrame([(D1, "A", 1.0, "a"), (D1, "B", 2.0, None), (D2, "A", 3.0, "c")], STORED)


@pytest.fixture
def incoming(spark):
    rows = [(D1, "A", None, 9), (D1, "B", 5.0, 8), (D2, "Z", 7.0, 7)]
    return spark.createDataFrame(rows, "date date, barrid string, price double, extra int")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_keeps_stored_over_null_inserts_and_drops_unknown(stored, incoming):
    out = upsert(stored, incoming, ["date", "barrid"])
    assert out.columns == ["date", "barrid", "price", "name"]
    assert rows(out.where("name is not null")) == [(D1, "A", 1.0, "a"), (D2, "A", 3.0, "c")]
    assert {(r.barrid, r.price) for r in out.where("name is null").collect()} == {("B", 5.0), ("Z", 7.0)}


def test_update_never_inserts(stored, incoming):
    out = update(stored, incoming, ["date", "barrid"])
    assert out.count() == 3
    assert {(r.date, r.barrid, r.price) for r in out.collect()} == {(D1, "A", 1.0), (D1, "B", 5.0), (D2, "A", 3.0)}


def test_upsert_is_idempotent(stored, incoming):
    once = upsert(stored, incoming, ["date", "barrid"])
    twice = upsert(once, incoming, ["date", "barrid"])
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()


def test_update_casts_to_stored_type(spark, stored):
    new = spark.createDataFrame([(D1, "A", 4)], "date date, barrid string, price int")
    out = update(stored, new, ["date", "barrid"])
    assert out.schema["price"].dataType.simpleString() == "double"


def test_null_key_is_an_error(spark, stored):
    new = spark.createDataFrame([(None, "A", 4.0)], "date date, barrid string, price double")
    with pytest.raises(Exception, match="null key in"):
        upsert(stored, new, ["date", "barrid"]).collect()


@pytest.mark.parametrize("how,count", [("left", 3), ("inner", 2), ("full", 4)])
def test_merge_widen(stored, incoming, how, count):
    out = merge_widen(stored, incoming, ["date", "barrid"], how)
    assert out.columns == ["date", "barrid", "price", "name", "extra"]
    assert out.count() == count
    assert {r.extra for r in out.where("barrid = 'B'").collect()} == {8}


def test_merge_widen_rejects_other_hows(stored, incoming):
    with pytest.raises(ValueError):
        merge_widen(stored, incoming, ["date"], "outer")


def test_dedupe_latest(spark):
    df = spark.createDataFrame([("A", 1, "x"), ("A", 2, "y"), ("A", 2, "w"), ("B", 0, None)], "k string, v int, s string")
    assert rows(dedupe_latest(df, ["k"], ["v"]).where("k='A'")) == [("A", 2, "y")]
    assert dedupe_latest(df, ["k"]).columns == ["k", "v", "s"]
    assert dedupe_latest(df.select("k"), ["k"]).count() == 2


def test_updates_and_model_rows_broadcast_no_panel(spark, tmp_path):
    """Few bytes on disk may be many rows, so sides with a row per key are never sent whole to the driver and all executors."""

    from panelwright import specs as sp
    from panelwright.plans.job_catalog import _model_rows
    from panelwright.store import PanelStore

    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    stored = spark.createDataFrame([(1, 2)], "k int, v int")
    assert "BroadcastHashJoin" not in plan(update(stored, spark.createDataFrame([(1, 3)], "k int, v int"), ["k"]))
    store, day = PanelStore(spark, str(tmp_path)), date(1996, 1, 2)
    store.upsert(sp.ASSETS, spark.createDataFrame([(day, "a", 1.0)], "date date, barrid string, price double"))
    store.upsert(sp.EXPOSURES, spark.createDataFrame([(day, "a", 2.0)], f"date date, barrid string, `{sp.FACTORS[0]}` double"))
    rows = _model_rows(store)
    assert [(r.barrid, r.price, r.f0) for r in rows.collect()] == [("a", 1.0, 2.0)]
    assert not [line for line in plan(rows).split("\n") if "BroadcastHashJoin" in line and "barrid" in line]
