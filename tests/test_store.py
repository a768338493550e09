import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from panelwright.files import Files, StaleTable
from panelwright.operators.asof import RightSide
from panelwright.specs import ASSETS, TABLES, table
from panelwright.store import Change, PanelStore

SPEC = table("panel", "date barrid", "date date, barrid string, price double, name string")
A, B, C = date(2022, 5, 2), date(2023, 5, 2), date(2024, 5, 2)


@pytest.fixture
def store(spark, tmp_path):
    return PanelStore(spark, str(tmp_path))


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "date date, barrid string, price double, name string")


def rows(store, **kw):
    return sorted(map(tuple, store.read(SPEC, **kw).collect()))


def files(store):
    return {r[0] for r in store.spark.read.parquet(store.path(SPEC)).select("_metadata.file_path").distinct().collect()}


def test_missing_table_reads_empty(spark, store):
    assert store.read(SPEC).schema == SPEC.schema and store.read(SPEC).count() == 0
    assert store.years(SPEC) == [] and not store.exists(SPEC, 2022)
    store.create_if_not_exists(SPEC)
    store.create_if_not_exists(SPEC)
    assert store.read(SPEC).schema == SPEC.schema and store.read(SPEC, 2022).count() == 0


def test_upsert_and_update_by_year(spark, store):
    store.upsert(SPEC, frame(spark, (A, "x", 1.0, "n"), (B, "x", 2.0, None), (C, "x", 3.0, None)))
    assert store.years(SPEC) == [2022, 2023, 2024] and store.exists(SPEC, 2023)
    before = files(store)
    store.upsert(SPEC, frame(spark, (B, "x", None, "m"), (B, "y", 9.0, None)))
    assert rows(store) == [(A, "x", 1.0, "n"), (B, "x", 2.0, "m"), (B, "y", 9.0, None), (C, "x", 3.0, None)]
    kept = before & files(store)
    assert {p.split("year=")[1][:4] for p in kept} == {"2022", "2024"}  # untouched years keep their files
    store.update(SPEC, frame(spark, (A, "x", 5.0, None), (A, "new", 5.0, None), (date(2021, 1, 4), "x", 1.0, None)))
    assert rows(store, years=2022) == [(A, "x", 5.0, "n")] and store.years(SPEC) == [2022, 2023, 2024]


def test_apply_in_order_with_one_rewrite(spark, store):
    sparse = frame(spark, (A, "x", 1.0, None))
    fill = frame(spark, (A, "x", None, "filled"), (A, "ghost", 1.0, "g"))
    store.apply(SPEC, [Change(sparse, True), Change(fill, False)])
    assert rows(store) == [(A, "x", 1.0, "filled")]


def test_update_sees_rows_a_former_change_makes_in_a_new_year(spark, store):
    store.upsert(SPEC, frame(spark, (A, "x", 1.0, None)))
    store.apply(SPEC, [Change(frame(spark, (C, "x", 2.0, None)), True), Change(frame(spark, (C, "x", None, "late")), False)])
    assert rows(store, years=2024) == [(C, "x", 2.0, "late")]


def test_idempotent(spark, store):
    change = frame(spark, (A, "x", 1.0, None), (A, "x", 2.0, None), (B, "y", None, "q"))
    store.upsert(SPEC, change)
    once = rows(store)
    store.upsert(SPEC, change)
    assert rows(store) == once == [(A, "x", 2.0, None), (B, "y", None, "q")]
    with pytest.raises(ValueError, match="repeated"):
        store.upsert(SPEC, change, on_repeat="error")


def test_unknown_columns_are_dropped(spark, store):
    store.upsert(SPEC, frame(spark, (A, "x", 1.0, None)).withColumn("junk", F.lit(1)))
    assert store.read(SPEC).columns == SPEC.columns


def test_update_asof_touches_changed_years_and_widens(spark, store):
    store.upsert(SPEC, frame(spark, (A, "x", 1.0, "n"), (B, "x", 2.0, None), (C, "z", 3.0, None)))
    before = files(store)
    mapping = spark.createDataFrame(
        [(date(2023, 1, 1), date(2023, 2, 1), "x", "named", "s")],
        "start_date date, end_date date, barrid string, name string, sector string",
    )
    side = RightSide(mapping, "start_date", ("start_date", "end_date"), ("end_date",))
    wider = store.update_asof(SPEC, [side], "barrid")
    assert wider.columns == [*SPEC.columns, "sector"]
    assert sorted(map(tuple, store.read(wider).collect())) == [
        (A, "x", 1.0, "n", None), (B, "x", 2.0, "named", "s"), (C, "z", 3.0, None, None),
    ]
    assert {p.split("year=")[1][:4] for p in before & files(store)} == {"2022", "2024"}
    again = files(store)
    store.update_asof(wider, [side], "barrid")
    assert files(store) == again  # nothing changed, nothing written
    store.update_asof(wider, [side], "barrid", only_changed=False, years=[2022])
    assert store.read(wider).count() == 3


def test_between_prunes_years(spark, store):
    store.upsert(SPEC, frame(spark, (A, "x", 1.0, None), (B, "x", 2.0, None), (C, "x", 3.0, None)))
    out = store.between(SPEC, B, C)
    assert out.count() == 2 and out.columns == SPEC.columns
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "PushedFilters: [IsNotNull(date)" in plan


def test_declared_tables(spark, store):
    assert len(TABLES) == 10
    signals = TABLES["signals"]
    store.upsert(signals, spark.createDataFrame([(A, "x", "mom", 1.0, None, None)], signals.schema))
    store.upsert(signals, spark.createDataFrame([(A, "x", "mom", None, 2.0, None)], signals.schema))
    assert tuple(store.read(signals).first()) == (A, "x", "mom", 1.0, 2.0, None)
    with pytest.raises(ValueError):
        PanelStore(spark, "/tmp/none", "elsewhere")


def test_the_row_that_arrived_last_wins(spark, tmp_path):
    """A correction counts also if its values are lower or null; without arrival columns the greatest row is taken."""
    store = PanelStore(spark, str(tmp_path))
    schema = "date date, barrid string, price double, _archive string, _member string, _line long"
    day = date(2024, 1, 2)
    rows = [
        (day, "A", 9.0, "a_240102.zip", "m.1", 1), (day, "A", 3.0, "a_240102.zip", "m.1", 7), (day, "A", 5.0, "a_240102.zip", "m.1", 2),
        (day, "B", 9.0, "a_240102.zip", "m.1", 50), (day, "B", 2.0, "a_240103.zip", "m.1", 0),
        (day, "C", 1.0, "a_240102.zip", "m.2", 0), (day, "C", 8.0, "a_240102.zip", "m.1", 9),
    ]
    store.upsert(ASSETS, spark.createDataFrame(rows, schema).repartition(3))
    assert {r.barrid: r.price for r in store.read(ASSETS).collect()} == {"A": 3.0, "B": 2.0, "C": 1.0}
    assert "_archive" not in store.read(ASSETS).columns
    store.upsert(ASSETS, spark.createDataFrame(rows, schema).drop("_archive", "_member", "_line"))
    assert {r.barrid: r.price for r in store.read(ASSETS).collect()} == {"A": 9.0, "B": 9.0, "C": 8.0}


def days(spark, first, n, price):
    ids = spark.range(n * 50).select(F.date_add(F.lit(first), (F.col("id") / 50).cast("int")).alias("date"), F.format_string("a%02d", F.col("id") % 50).alias("barrid"))
    return ids.withColumns({"price": F.lit(price), "name": F.lit(None).cast("string")})


def test_one_day_rewrites_only_files_it_reaches(spark, tmp_path):
    store = PanelStore(spark, str(tmp_path), rows_per_file=200)
    store.upsert(SPEC, days(spark, date(2023, 1, 2), 40, 1.0))
    before = files(store)
    assert len(before) >= 10
    store.upsert(SPEC, days(spark, date(2023, 1, 10), 1, 7.0))
    assert 1 <= len(before - files(store)) <= 2
    after = store.read(SPEC).groupBy("date").agg(F.count("*").alias("n"), F.sum("price").alias("s")).collect()
    assert {r.date: (r.n, r.s) for r in after} == {date(2023, 1, 2) + timedelta(i): (50, 350.0 if i == 8 else 50.0) for i in range(40)}
    # a day beyond all others touches nothing; one asset of a day reaches only the file that holds it
    before = files(store)
    store.upsert(SPEC, days(spark, date(2023, 6, 1), 1, 1.0))
    store.update(SPEC, frame(spark, (date(2023, 6, 1), "zz", 1.0, None)))
    assert before < files(store)
    before = files(store)
    store.update(SPEC, frame(spark, (date(2023, 1, 20), "a07", 9.0, None)))
    assert len(before - files(store)) == 1
    plan = store.between(SPEC, date(2023, 6, 1), date(2023, 6, 1)).select("_metadata.file_path").distinct()
    assert plan.count() == 1 and len(store.between(SPEC, date(2023, 6, 1), date(2023, 6, 1)).inputFiles()) == 1


def test_of_two_writers_the_later_fails_and_leaves_nothing(spark, store):
    store.upsert(SPEC, frame(spark, (A, "x", 1.0, None)))
    base, _order = store._files(SPEC)
    store.upsert(SPEC, frame(spark, (A, "x", 2.0, None)))
    before = files(store)
    with pytest.raises(StaleTable):
        store._rewrite(SPEC, base, {f.path for f in base.files}, frame(spark, (A, "x", 3.0, None)))
    assert files(store) == before and rows(store) == [(A, "x", 2.0, None)]
    # the name itself is refused, if both come to it at once
    lists = Files(spark, store.path(SPEC))
    now = lists.latest()
    late = Files(spark, store.path(SPEC))
    late.numbers = lambda: [now.number - 1]
    with pytest.raises(StaleTable):
        late.publish(now)
    assert lists.latest() == now


def test_folder_without_a_list_and_old_lists(spark, store):
    """Years written by something else are taken up by the first write; only some lists are kept."""
    given = frame(spark, (A, "x", 1.0, None), (B, "x", 2.0, None))
    given.withColumn("year", F.year("date")).write.partitionBy("year").parquet(store.path(SPEC))
    assert store.years(SPEC) == [2022, 2023] and store.between(SPEC, A, A).count() == 1 and store.read(SPEC, 2023).count() == 1
    for i in range(13):
        store.update(SPEC, frame(spark, (A, "x", float(i), None)))
    assert rows(store) == [(A, "x", 12.0, None), (B, "x", 2.0, None)]
    lists = Files(spark, store.path(SPEC))
    assert lists.latest().number == 13 and len(lists.numbers()) <= 11


def test_keys_without_the_date_reach_the_whole_year(spark, store):
    store.upsert(SPEC, frame(spark, (A, "x", 1.0, None), (date(2022, 9, 1), "x", 1.0, None), (B, "x", 1.0, None)))
    store.update(SPEC, frame(spark, (date(2022, 1, 3), "x", 4.0, None)).drop("name"), keys=["barrid"])
    assert sorted((r[0].year, r[2]) for r in rows(store)) == [(2022, 4.0), (2022, 4.0), (2023, 1.0)]


def test_a_write_that_fails_leaves_the_table_as_it_was(spark, store):
    store.upsert(SPEC, frame(spark, (A, "x", 1.0, None), (B, "x", 1.0, None)))
    base, _order = store._files(SPEC)
    before = files(store)
    bad = frame(spark, (A, "x", 2.0, None), (B, "x", 3.0, None)).withColumn("price", F.when(F.col("price") < 3, F.col("price")).otherwise(F.raise_error(F.lit("no price"))))
    with pytest.raises(Exception, match="no price"):
        store._rewrite(SPEC, base, {f.path for f in base.files}, bad)
    assert files(store) == before and [r[2] for r in rows(store)] == [1.0, 1.0]
    assert not [n for n in os.listdir(store.path(SPEC)) if n.startswith("_new")]
    store.upsert(SPEC, frame(spark, (A, "x", 5.0, None)))
    assert [r[2] for r in rows(store)] == [5.0, 1.0]
