from datetime import date

import pytest
from pyspark.sql import functions as F

from panelwright.functions import frames as FR
from panelwright.functions import scalars as S
from panelwright.operators.calendar import last_sessions, session_list, with_previous
from panelwright.operators.universe import base_universe, membership
from panelwright.sources.lines import parse_lines
from panelwright.specs import schema_of


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expression(F.col("c"))).first()[0]


def test_parse_date(spark):
    assert one(spark, "20240102", S.parse_date) == date(2024, 1, 2)
    assert one(spark, 20240102, S.parse_date, "int") == date(2024, 1, 2)
    assert one(spark, None, S.parse_date) is None
    assert one(spark, "x", lambda c: S.parse_date(c, strict=False)) is None
    with pytest.raises(Exception):
        one(spark, "2024-01-02", S.parse_date)


@pytest.mark.parametrize(
    "text,want", [("USXUSA", "XUSA"), ("AAPL", "AAPL"), ("US", ""), ("XUS\nUS", "X\nUS"), (None, None)]
)
def test_replace_first(spark, text, want):
    assert one(spark, text, lambda c: S.replace_first(c, "US")) == want


def test_replace_first_with_signs(spark):
    assert one(spark, "a.b.c", lambda c: S.replace_first(c, r"\.", "$")) == "a$b.c"


def test_scalars(spark):
    assert one(spark, " 1.5 ", S.padded_double) == 1.5
    assert one(spark, "Y", S.is_yes) is True
    assert one(spark, "N", S.is_yes) is False
    assert one(spark, None, S.is_yes) is None
    assert one(spark, 2.0, S.to_percent, "double") == 200
    assert one(spark, 2.0, S.from_percent, "double") == 0.02
    assert one(spark, 2.0, S.from_percent_squared, "double") == 0.0002
    assert one(spark, 3.0, S.squared, "double") == 9
    assert one(spark, None, lambda c: S.fill_null(c, 0.0), "double") == 0
    assert one(spark, "xUSx", lambda c: S.contains(c, "US")) is True
    assert one(spark, "xUSx", lambda c: S.contains(c, "U.x")) is True
    assert one(spark, 1, lambda c: S.literal(None, "date"), "int") is None


def test_in_force(spark):
    d = date(2024, 1, 2)
    df = spark.createDataFrame([(d, d), (date(2024, 1, 3), d), (None, d)], "s date, e date")
    assert df.where(S.in_force(d, F.col("s"), F.col("e"))).count() == 1


def test_frames(spark):
    df = spark.createDataFrame([("A", 1), ("[End of File]", None), (None, 2)], "`!Barrid` string, x int")
    renamed = FR.rename_known(df, {"!Barrid": "barrid", "nope": "y"})
    assert FR.drop_trailer(renamed, "barrid").count() == 1
    with pytest.raises(ValueError, match="nope"):
        FR.rename_all(df, {"nope": "y"})
    assert FR.rename_all(df, {"x": "y"}).columns == ["!Barrid", "y"]
    assert FR.at_latest(renamed, "x").collect()[0].x == 2
    assert FR.keep_members(renamed, spark.createDataFrame([("A",), ("A",)], "barrid string"), "barrid").count() == 1
    FR.check_unique(renamed, ["barrid"])
    with pytest.raises(ValueError):
        FR.check_unique(renamed.union(renamed), ["barrid"])
    assert [r[0] for r in FR.distinct_sorted(renamed, "x").collect()] == [None, 1, 2]
    wide = FR.add_missing_columns(df, schema_of("x bigint, z date"))
    assert wide.columns == ["!Barrid", "x", "z"] and wide.schema["z"].dataType.simpleString() == "date"


def test_conform(spark):
    df = spark.createDataFrame([("2024-01-02", "7")], "date string, vol string")
    out = S.conform(df, schema_of("vol bigint, date date"))
    assert tuple(out.first()) == (7, date(2024, 1, 2))


def test_parse_lines(spark):
    lines = spark.createDataFrame([("A|1.5|20240102",), ("B||20240102",), ("[End of File]",)], "line string")
    out = parse_lines(lines, schema_of("!Barrid string, Price double, DataDate string"))
    assert [tuple(r) for r in out.collect()] == [("A", 1.5, "20240102"), ("B", None, "20240102"), ("[End of File]", None, None)]
    bad = spark.createDataFrame([("A|x|1",)], "line string")
    with pytest.raises(Exception):
        parse_lines(bad, schema_of("!Barrid string, Price double, DataDate string")).collect()


SESSIONS = [date(2023, 12, d) for d in (27, 28, 29)] + [date(2024, 1, d) for d in (2, 3, 4, 5, 8)]


def test_calendar(spark):
    cal = spark.createDataFrame([(d,) for d in reversed(SESSIONS)], "date date")
    assert session_list(cal, date(2024, 1, 6)) == [date(2024, 1, 5)]  # Saturday
    assert session_list(cal, date(2024, 1, 1), 2) == [date(2023, 12, 28), date(2023, 12, 29)]  # holiday
    assert session_list(cal, date(2024, 1, 3), 3) == [date(2023, 12, 28), date(2023, 12, 29), date(2024, 1, 2)]
    assert session_list(cal, SESSIONS[0], 5) == []
    with pytest.raises(Exception, match="after the last session"):
        last_sessions(cal, date(2024, 2, 1)).collect()
    assert {r.date: r.previous_date for r in with_previous(cal).collect()}[date(2024, 1, 2)] == date(2023, 12, 29)


def test_membership(spark):
    days = [date(2024, 6, d) for d in range(3, 8)]
    rows = [(d, b, b, "USA", "c" + b) for d in days for b in "AB"]
    rows += [(days[1], "C", "X", "USA", "cC"), (days[1], "D", "D", "CAN", "cD"), (days[1], "E", "E", "USA", None)]
    assets = spark.createDataFrame(rows, "date date, barrid string, rootid string, iso_country_code string, cusip string")
    holdings = spark.createDataFrame(
        [
            (days[1], "cA", True, None), (days[1], "cA", None, None),  # listed twice
            (days[1], "cC", True, True), (days[1], None, True, True),
            (days[2], "cB", None, False),  # no true flag: not a rebalance
            (days[3], "cB", False, True),  # A drops out
        ],
        "date date, cusip string, russell_1000 boolean, russell_2000 boolean",
    )
    got = {(r.barrid, r.date): tuple(r)[2:] for r in membership(base_universe(assets), holdings).collect()}
    none, r1, out, r2 = (None,) * 3, (True, False, True), (False, False, False), (False, True, True)
    assert [got["A", d] for d in days] == [none, r1, r1, out, out]
    assert [got["B", d] for d in days] == [none, out, out, r2, r2]
    assert got["E", days[1]] == out and len(got) == 11


def test_rounded_is_round_without_decimals(spark):
    """Halves, signs, zeros, large and odd numbers; and the plan goes the short way: only what is near a half asks ``round``."""
    from panelwright.functions.scalars import rounded

    halves = spark.range(4000).selectExpr("(id - 2000 + 0.5) / 1e6 AS v")
    spread = spark.range(4000).selectExpr("(rand(3) - 0.5) * pow(10, cast(id % 16 AS int) - 8) AS v")
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (-0.0,), (None,), (-1e-9,), (1e300,), (123456789.1234565,)], "v double")
    for row in halves.union(spread).union(odd).select(F.round("v", 6).alias("a"), rounded(F.col("v"), 6).alias("b")).collect():
        assert repr(row.a) == repr(row.b)
