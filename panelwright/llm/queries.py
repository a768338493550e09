"""One query per operator over its whole table, and SQL for DuckDB where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm import (
    ball_kmeans,
    decontaminate,
    hard_negatives,
    html,
    jaccard,
    mixing,
    pseudo_lm,
    quality,
    substrings,
    suffixes,
    tokens,
    toxicity,
    warc,
)
from panelwright.llm.common import pick

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return pick(spark.read.parquet(f"{sf_dir}/documents.parquet"), *columns)


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers  # only this query needs it

    docs = _documents(spark, sf_dir, "doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.json")
    sized = docs.withColumn("n_bytes", F.octet_length(F.coalesce("text", F.lit(""))).cast("long"))
    counted = tokens.count_tokens(sized, path, limit=512)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query
def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = pick(spark.read.parquet(f"{sf_dir}/pages.parquet"), "page_id", "url", "html")
    return html.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_documents(spark, sf_dir, "doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


ORACLE["op3_quality_rules"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
win AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS k
        FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM w)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM win) WHERE n > 1),
cov AS (SELECT r, sum(least(8, coalesce(nxt - i, 8)))::BIGINT AS n_repeat_words
        FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM rep) GROUP BY r),
s AS (SELECT doc_id, text, w, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words,
             len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) AS spoken,
             len(list_filter(w, lambda x: ends_with(x, '!'))) AS loud,
             length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS letters,
             length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) AS capitals
      FROM w LEFT JOIN cov USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR n_symbols * 10 > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR (n_lines >= 4 AND n_dup_lines * 2 > n_lines) OR spoken * 10 < n_words * 6 OR loud * 2 > n_words
            OR (letters >= 40 AND capitals * 2 > letters)) AS kept
FROM b
"""


@query
def op4_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.leaks(_documents(spark, sf_dir, "doc_id", "text"), items)
    return found.select("doc_id", "item_id", "n_found", F.round("share", 6).alias("share"), "changed")


@query
def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_documents(spark, sf_dir, "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


#: Word sizes, capped water-filling and the cut of the seeded order, over the rows of ``{docs}``.
MIX_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || source, '') AS key, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('17|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT AS h FROM {docs}),
s AS (SELECT key, source_size, source_size * 2.0::DOUBLE AS cap, [3.0::DOUBLE, 1.0, 2.0][1 + (row_number() OVER (ORDER BY key = '', key) - 1) % 3] AS w
      FROM (SELECT key, sum(size)::BIGINT AS source_size FROM d GROUP BY key)),
fill AS (SELECT 0 AS n, key, source_size, cap, w, FALSE AS full_, 1.5::DOUBLE * sum(source_size) OVER () AS total FROM s
         UNION ALL
         SELECT n + 1, key, source_size, cap, w, full_ OR cap <= w * level, total
         FROM (SELECT *, (total - coalesce(sum(cap) FILTER (WHERE full_) OVER (), 0)) / sum(w) FILTER (WHERE NOT full_) OVER () AS level FROM fill)
         WHERE n < (SELECT count(*) FROM s)),
t AS (SELECT key, source_size, CASE WHEN full_ THEN cap ELSE w * (total - coalesce(sum(cap) FILTER (WHERE full_) OVER (), 0))
             / sum(w) FILTER (WHERE NOT full_) OVER () END AS target FROM fill WHERE n = (SELECT count(*) FROM s)),
g AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
c AS (SELECT d.*, source_size, target, whole, target - whole * source_size AS need,
             sum(size) OVER (PARTITION BY key ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING) - size AS before
      FROM d JOIN g USING (key))
SELECT doc_id, size, source_size, round(target, 6) AS target,
       (size * (whole + CASE WHEN need > 0 AND need - before >= size / 2.0 THEN 1 ELSE 0 END))::BIGINT AS taken FROM c
"""
ORACLE["op5_source_mix"] = MIX_SQL.format(docs="documents")


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = pick(spark.read.parquet(f"{sf_dir}/pages.parquet"), "page_id", "url", "html")
    return warc.archived(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op6_warc"] = """
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
FROM m
"""


@query
def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.set_components(_documents(spark, sf_dir, "doc_id", "text"), jaccard.Likeness(4, 85, 100))
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op8_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    return pseudo_lm.score(docs, pseudo_lm.train(docs)).select("doc_id", "n_words", "log_prob", "mean_log_prob")


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).select("doc_id", "severity", "p_toxic", "toxic")


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.repeated_passages(_documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", "first_word", "n_words", "source_id")


@query
def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    sized = docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    cut = suffixes.without_repeats(sized, length=50)
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


#: Bytes as hexadecimal digits, all 50-byte strings of all documents, the bytes they cover, and what is left.
ORACLE["op11_suffix_dedup"] = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT r, doc_id, i, substr(h, 2 * i + 1, 100) AS k FROM (SELECT r, doc_id, h, unnest(range(len(h) // 2 - 49)) AS i FROM d WHERE len(h) >= 100)),
f AS (SELECT k, min(doc_id) AS first FROM s GROUP BY k),
g AS (SELECT r, i, max(i + 50) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS until
      FROM s JOIN f USING (k) WHERE doc_id > first),
runs AS (SELECT r, i, sum(CASE WHEN until IS NULL OR i > until THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS run FROM g),
spans AS (SELECT r, run, min(i) AS a, max(i) + 50 AS b FROM runs GROUP BY r, run),
pieces AS (SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS a, a AS b FROM spans
           UNION ALL SELECT r, max(b), NULL FROM spans GROUP BY r),
kept AS (SELECT r, string_agg(CASE WHEN b IS NULL THEN substr(h, 2 * a + 1) ELSE substr(h, 2 * a + 1, 2 * (b - a)) END, '' ORDER BY a) AS h
         FROM pieces p JOIN d USING (r) GROUP BY r),
n AS (SELECT r, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY r)
SELECT doc_id, len(d.h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN n USING (r) LEFT JOIN kept USING (r)
"""

#: Rows of {embeddings} whose vector is whole, its components scaled and rounded down.
_WHOLE_SQL = """SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pick(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.mine(rows.withColumn("label", moved))
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE["op12_hard_negatives"] = f"""
WITH w AS ({_WHOLE_SQL.format(scale=256)} AND label IS NOT NULL),
e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, v FROM w),
a AS (SELECT * FROM e WHERE vec_id % 50 = 0),
s AS (SELECT a.vec_id AS anchor_id, e.vec_id, a.label = e.label AS same, list_inner_product(a.v, e.v)::BIGINT AS score
      FROM a JOIN e ON a.vec_id <> e.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pick(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "label", "embedding")
    coded, codebooks = ball_kmeans.compress(rows)
    summed = ball_kmeans.label_errors(coded)
    code, digest = F.lower(F.hex("code")).alias("code"), F.lit(ball_kmeans.codebooks_digest(codebooks)).alias("codebooks_sha256")
    return summed.select("vec_id", code, "error", "label_error", digest)


def _codes_sql(rounds: int = 4, parts: int = 4, entries: int = 256) -> str:
    """Each round assigns every part to the nearest entry and averages the parts of each entry."""
    steps = [
        f"w AS ({_WHOLE_SQL.format(scale=1024)})",
        "v AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, vec_id, label, v FROM w)",
        f"x AS MATERIALIZED (SELECT r, p, list_slice(v, p * len(v) // {parts} + 1, (p + 1) * len(v) // {parts}) AS x FROM v, range({parts}) t(p))",
        f"c0 AS (SELECT p, r AS e, x AS c FROM x WHERE r < {entries})",
    ]
    for k in range(rounds + 1):
        square = "list_inner_product(x, x) + list_inner_product(c, c) - 2 * list_inner_product(x, c)"
        steps.append(f"a{k} AS MATERIALIZED (SELECT r, p, min(({square})::BIGINT * {entries} + e) AS best FROM x JOIN c{k} USING (p) GROUP BY r, p)")
        if k < rounds:
            steps.append(
                f"m{k} AS (SELECT p, e, list(floor(s / n) ORDER BY j) AS c FROM (SELECT p, best % {entries} AS e, j, sum(x[j]) AS s, count(*) AS n"
                f" FROM (SELECT p, best, x, unnest(range(1, len(x) + 1)) AS j FROM x JOIN a{k} USING (r, p)) GROUP BY ALL) GROUP BY p, e)"
            )
            steps.append(f"c{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m{k}.c, c{k}.c) AS c FROM c{k} LEFT JOIN m{k} USING (p, e))")
    return f"""WITH {", ".join(steps)},
    o AS (SELECT r, string_agg(printf('%02x', best % {entries}), '' ORDER BY p) AS code, sum(best // {entries})::BIGINT AS error FROM a{rounds} GROUP BY r),
    b AS (SELECT sha256(string_agg(c[j]::BIGINT::VARCHAR, ',' ORDER BY p, e, j)) AS codebooks_sha256
          FROM (SELECT p, e, c, unnest(range(1, len(c) + 1)) AS j FROM c{rounds}))
    SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM v JOIN o USING (r), b"""


ORACLE["op13_vector_codes"] = _codes_sql()
