"""Every query against its SQL in DuckDB, as a bag of rows."""

import datetime as dt
import math
import os
from collections import Counter

import duckdb
import pytest

from panelwright.plans import job_oracle, oracle
from panelwright.plans.job_catalog import QUERIES

ORACLE = {**oracle.ORACLE, **job_oracle.ORACLE}

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return v


def bag(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    assert sorted(got.columns) == sorted(columns)
    assert want, "an empty result checks nothing"
    mine, theirs = bag(got.columns, map(tuple, got.collect())), bag(columns, want)
    extra, missing = mine - theirs, theirs - mine
    assert not extra and not missing, (list(extra)[:3], list(missing)[:3], sum(extra.values()), sum(missing.values()))
