import random
from datetime import date, datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelwright.operators.asof import RightSide, asof_join, asof_update, asof_update_many
from panelwright.operators.fill import forward_fill
from panelwright.operators.skew import range_cuts, with_ranges


def brute(left, right, strategy):
    """Matched right value per left row, by looking at all right rows of the key."""
    out = []
    for lid, k, t in left:
        best = None
        for rk, rt, v in right:
            if k is None or t is None or rk is None or rt is None or rk != k:
                continue
            if strategy == "backward" and rt > t or strategy == "forward" and rt < t:
                continue
            rank = (abs(rt - t), rt > t, -v)
            if best is None or rank < best[0]:
                best = (rank, v)
        out.append((lid, None if best is None else best[1]))
    return sorted(out)


def fixture(seed, hot_share):
    rng = random.Random(seed)
    base = datetime(2024, 1, 1)

    def key():
        return "hot" if rng.random() < hot_share else rng.choice(["a", "b", "c", None])

    def time(clustered):
        if rng.random() < 0.05:
            return None
        return base + timedelta(seconds=5000 if clustered and rng.random() < 0.4 else rng.randrange(10000))

    left = [(i, key(), time(True)) for i in range(600)]
    right = [(key(), time(False), i) for i in range(250)]
    return left, right


@pytest.mark.parametrize("strategy", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("rows_per_range", [None, 40])
def test_asof_against_brute_force(spark, strategy, rows_per_range):
    left, right = fixture(7, 0.6)
    l = spark.createDataFrame(left, "lid int, k string, t timestamp_ntz").repartition(5)
    r = spark.createDataFrame(right, "k string, rt timestamp_ntz, v int")
    # of right rows at one time the greatest value wins
    out = asof_join(l, r, "t", "rt", "k", strategy, ["v"], rows_per_range=rows_per_range)
    assert sorted((x.lid, x.v) for x in out.collect()) == brute(left, right, strategy)


def ranges_of(df, by, place, rows_per_range):
    """Rows per key and range."""
    layout = range_cuts(df, by, place, rows_per_range)
    if layout is None:
        return None
    counts = with_ranges(df, layout, by, place).groupBy(*by, "__g", "__parted").count().collect()
    return {(*(r[b] for b in by), r["__g"]): (r["count"], r["__parted"]) for r in counts}


def test_one_key_of_all_rows_is_parted_evenly(spark):
    """Two busy seconds and one row years away, as times and as texts."""
    base = datetime(2024, 1, 1)
    rows = [("k", base + timedelta(milliseconds=i), f"{i:06}") for i in range(4000)] + [("k", datetime(1990, 1, 1), "x")]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, s string").repartition(3)
    for order in (["t"], ["s"]):
        found = ranges_of(df, ["k"], F.struct(*order), 100)
        assert 35 <= len(found) <= 45 and max(n for n, _ in found.values()) < 250


def test_rows_of_one_time_are_parted(spark):
    df = spark.range(4000).selectExpr("1 k", "date'2024-01-01' t", "xxhash64(id) h")
    found = ranges_of(df, ["k"], F.struct("t", "h"), 100)
    assert 35 <= len(found) <= 45 and max(n for n, _ in found.values()) < 250


def test_only_large_keys_are_parted(spark):
    left, _ = fixture(3, 0.6)
    df = spark.createDataFrame(left, "lid int, k string, t timestamp_ntz")
    found = ranges_of(df, ["k"], F.struct("t", "lid"), 100)
    assert {k for (k, _), (_, parted) in found.items() if parted} == {"hot"}
    assert sum(n for n, _ in found.values()) == len(left)
    assert ranges_of(df, ["k"], F.struct("t"), 10_000) is None
    assert ranges_of(df.limit(0), ["k"], F.struct("t"), 10) is None


def test_cuts_beyond_the_broadcast_limit_are_joined(spark, monkeypatch):
    from panelwright.operators import skew

    monkeypatch.setattr(skew, "BROADCAST_CUTS", 0)
    test_asof_against_brute_force(spark, "nearest", 40)
    test_forward_fill_against_pandas(spark, 20)


@pytest.mark.parametrize("strategy", ["backward", "forward", "nearest"])
def test_left_rows_of_one_time_in_several_ranges_see_the_same_row(spark, strategy):
    base = datetime(2024, 1, 1)
    left = [(i, "hot", base + timedelta(seconds=[5, 5, 5, 7][i % 4])) for i in range(800)]
    right = [("hot", base + timedelta(seconds=s), s) for s in (1, 5, 6, 9)]
    l = spark.createDataFrame(left, "lid int, k string, t timestamp_ntz").repartition(4)
    r = spark.createDataFrame(right, "k string, rt timestamp_ntz, v int")
    out = asof_join(l, r, "t", "rt", "k", strategy, ["v"], rows_per_range=50)
    assert sorted((x.lid, x.v) for x in out.collect()) == brute(left, right, strategy)


@pytest.mark.parametrize("strategy", ["backward", "forward"])
def test_text_times(spark, strategy):
    left = [(i, "k", f"{i * 7 % 900:04}") for i in range(900)]
    right = [("k", f"{i * 31 % 900:04}", i) for i in range(60)]
    l, r = spark.createDataFrame(left, "lid int, k string, t string"), spark.createDataFrame(right, "k string, rt string, v int")
    out = asof_join(l, r, "t", "rt", "k", strategy, ["v"], rows_per_range=40)
    want = []
    for lid, _, t in left:
        fits = [(rt, v) for _, rt, v in right if (rt <= t if strategy == "backward" else rt >= t)]
        want.append((lid, (max(fits) if strategy == "backward" else min(fits))[1] if fits else None))
    assert sorted((x.lid, x.v) for x in out.collect()) == want


@pytest.mark.parametrize("rows_per_range", [None, 20])
def test_forward_fill_against_pandas(spark, rows_per_range):
    rng = random.Random(5)
    base = datetime(2024, 1, 1)
    rows = [
        (i, rng.choice(["hot", "hot", None, None, "x"]), base + timedelta(seconds=rng.randrange(500)),
         float(i) if rng.random() < 0.1 else None, str(i) if rng.random() < 0.05 else None)
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "i int, k string, t timestamp_ntz, v double, s string")
    got = forward_fill(df, "k", ["t", "i"], ["v", "s"], rows_per_range).toPandas().sort_values("i")
    want = pd.DataFrame(rows, columns=["i", "k", "t", "v", "s"]).sort_values(["t", "i"])
    want[["v", "s"]] = want.groupby("k", dropna=False)[["v", "s"]].ffill()
    want = want.sort_values("i")
    assert got["v"].fillna(-1).tolist() == want["v"].fillna(-1).tolist()
    assert got["s"].fillna("").tolist() == want["s"].fillna("").tolist()


D = [date(2024, 1, d) for d in range(1, 11)]


@pytest.fixture
def panel(spark):
    rows = [(D[0], "A", "old", 1.0), (D[4], "A", "old", 2.0), (D[9], "A", None, 3.0), (D[4], "B", "keep", 4.0)]
    return spark.createDataFrame(rows, "date date, barrid string, ticker string, price double")


@pytest.fixture
def mapping(spark):
    rows = [
        (D[3], D[5], "A", "T1", "n1"),
        (D[4], D[5], "A", None, "n2"),  # the chosen row on D[4]: its null must not fall back to T1
        (None, D[9], "A", "bad", "bad"),
        (D[1], D[9], None, "bad", "bad"),
        (D[4], D[8], "B", "tie-late", "x"),
        (D[4], D[6], "B", "tie-early", "y"),
    ]
    return spark.createDataFrame(rows, "start_date date, end_date date, barrid string, ticker string, note string")


def test_asof_update_rules(panel, mapping):
    out = asof_update(
        panel, mapping, "date", "start_date", "barrid", drop_right_cols=["end_date"], tie_break=["end_date"]
    )
    assert out.columns == ["barrid", "date", "ticker", "price", "note"]
    got = {(r.barrid, r.date): (r.ticker, r.note, r.price) for r in out.collect()}
    assert got[("A", D[0])] == ("old", None, 1.0)  # before the first start
    assert got[("A", D[4])] == ("old", "n2", 2.0)  # exact hit, null in the chosen row keeps the left value
    assert got[("A", D[9])] == (None, "n2", 3.0)  # past the end date the map stays in force
    assert got[("B", D[4])] == ("tie-late", "x", 4.0)
    assert len(got) == 4


def test_asof_update_many_equals_one_after_another(spark, panel, mapping):
    other = spark.createDataFrame([(D[2], "A", "N", "q")], "start_date date, barrid string, ticker string, q string")
    first = asof_update(panel, mapping, "date", "start_date", "barrid", drop_right_cols=["end_date"], tie_break=["end_date"])
    chained = asof_update(first, other, "date", "start_date", "barrid")
    sides = [RightSide(mapping, "start_date", ("end_date",), ("end_date",)), RightSide(other, "start_date")]
    at_once = asof_update_many(panel, sides, "date", "barrid")
    assert sorted(map(str, at_once.select(chained.columns).collect())) == sorted(map(str, chained.collect()))


def test_asof_rejects_unknown_strategy(panel, mapping):
    with pytest.raises(ValueError):
        asof_update(panel, mapping, "date", "start_date", "barrid", strategy="sideways")


def test_asof_by_several_keys_and_suffix(spark):
    l = spark.createDataFrame([(1, "x", 5, 0.5)], "a int, b string, t int, v double")
    r = spark.createDataFrame([(1, "x", 3, 9.0), (1, "y", 4, 8.0)], "a int, b string, t int, v double")
    row = asof_join(l, r, "t", "t", ["a", "b"]).collect()[0]
    assert row.asDict() == {"a": 1, "b": "x", "t": 5, "v": 0.5, "t_right": 3, "v_right": 9.0}


def test_thousands_of_ranges_keep_the_plan_small(spark):
    """One key in some 2,000 ranges: the search for a row's range names its columns a few times, not 3 ** 11 times."""
    n = 4000
    df = spark.range(n).selectExpr("1 AS k", "id AS t", "IF(id % 7 = 0, id, NULL) AS v")
    filled = forward_fill(df, "k", "t", ["v"], rows_per_range=2)
    assert [tuple(r) for r in filled.orderBy("t").select("t", "v").collect()] == [(i, i - i % 7) for i in range(n)]
    place = F.struct("t")
    layout = range_cuts(df, ["k"], place, 2)
    ranged = with_ranges(df, layout, ["k"], place)
    assert layout.total > 1500 and len(layout.levels) == 3
    # a join on the range puts its definition into a filter
    text = ranged.join(ranged.select("__g", F.lit(1).alias("one")), "__g").where("__g > 3")._jdf.queryExecution().executedPlan().toString()
    assert len(text) < 100_000
    assert ranged.select("__g").distinct().count() == layout.total + 1
