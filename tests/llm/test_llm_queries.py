"""The registered queries against their SQL, and the pipeline's stages against what each promises."""

import os

import duckdb
import pytest

import corpus_pipeline
from panelwright.llm.queries import ORACLE, QUERIES
from bags import bag

SF = os.environ.get("TEST_LLM_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert bag(got.columns, map(tuple, got.collect())) == bag(columns, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_reruns_agree(spark, name):
    first, second = (QUERIES[name](spark, SF) for _ in range(2))
    a, b = (bag(f.columns, map(tuple, f.collect())) for f in (first, second))
    assert a and a == b


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF)
        rows = {r.doc_id: r for r in after.collect()}
        assert set(rows) <= set(before), name
        if name != "source_mix":
            assert after.columns == columns, name
        if name == "quality":
            assert all(k in rows for k, r in labels.items() if r.quality == 1 and len(before[k].split()) >= 60)
        if name in ("near_duplicates", "benchmark_leaks", "source_mix"):
            assert all(r.text == before[k] for k, r in rows.items()), name
        docs, before = spark.createDataFrame(list(rows.values()), after.schema), {k: r.text for k, r in rows.items()}
    empty = spark.createDataFrame([], spark.read.parquet(f"{SF}/documents.parquet").schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
