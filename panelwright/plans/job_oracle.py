"""SQL of the queries in ``job_catalog``."""

from __future__ import annotations

from panelwright.specs import FACTORS

ORACLE: dict[str, str] = {}

_SOLD = """
sold AS (SELECT *, 'USA' || o_custkey AS barrid, CAST(o_orderdate AS DATE) AS date, l_linenumber - 1 AS line
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders),
recent AS (SELECT date FROM days WHERE date < (SELECT min(date) FROM days WHERE date >= DATE '1999-06-15') ORDER BY date DESC LIMIT 60),
newest AS (SELECT max(date) AS date FROM recent)
"""
_ASSETS = "SELECT date, barrid, max(o_totalprice) AS price, max(o_orderstatus) AS price_source FROM sold GROUP BY 1, 2"

ORACLE["archive_daily_scan"] = f"WITH {_SOLD} SELECT * FROM ({_ASSETS}) WHERE date IN (SELECT date FROM recent)"
ORACLE["archive_history_scan"] = f"WITH {_SOLD} SELECT date, barrid, round(sum(l_quantity), 2) AS daily_volume FROM sold GROUP BY 1, 2"
_RISK = "SELECT date, barrid, max(l_tax) AS yield, max(l_discount) + 1 AS specific_risk FROM sold GROUP BY 1, 2"
ORACLE["archive_many_scan"] = f"WITH {_SOLD} SELECT * FROM ({_RISK}) WHERE year(date) IN (1996, 1997)"
ORACLE["archive_latest_scan"] = f"""
WITH {_SOLD} SELECT date, barrid, max(l_tax) AS specific_return FROM sold WHERE date = (SELECT date FROM newest) GROUP BY 1, 2
"""
ORACLE["archive_listing"] = f"WITH {_SOLD} SELECT DISTINCT 'SMD_USSLOWL_100_' || strftime(date, '%y%m%d') || '.zip' AS name FROM sold"
ORACLE["strict_rename"] = "SELECT CAST(s_suppkey AS VARCHAR) AS id_text, s_name AS name FROM supplier"
ORACLE["unique_guard"] = "SELECT o_orderkey, o_totalprice AS price FROM orders"
ORACLE["mapped_members"] = f"""
WITH {_SOLD} SELECT barrid, 'T' || max(o_custkey) AS ticker FROM sold GROUP BY 1 HAVING min(date) <= DATE '1996-06-28'
"""
ORACLE["stored_years"] = """
SELECT CAST(y AS INTEGER) AS year, y IN (SELECT year(l_shipdate) FROM lineitem WHERE year(l_shipdate) BETWEEN 1995 AND 1997) AS stored
FROM range(1990, 2003) t(y)
"""
_WIDE = ", ".join(f"max(CASE WHEN {{on}} = {i} THEN {{value}} END) AS f{i}" for i in range(7))
ORACLE["exposures_job"] = f"WITH {_SOLD} SELECT date, barrid, {_WIDE.format(on='line', value='l_quantity')} FROM sold GROUP BY 1, 2"


def _cases(names, on: str) -> str:
    return f"CASE {on} " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names)) + " END"


ORACLE["covariances_job"] = f"""
WITH {_SOLD} SELECT date, {_cases(FACTORS[:7], 'line')} AS factor_1, {_WIDE.format(on='l_suppkey % 7', value='l_discount')}
FROM sold GROUP BY date, line
"""
ORACLE["risk_model_matrix"] = f"""
WITH {_SOLD},
f AS (SELECT least(l_partkey % 76, l_suppkey % 76) AS i, greatest(l_partkey % 76, l_suppkey % 76) AS j, max(l_discount) AS v FROM lineitem GROUP BY 1, 2),
x AS (SELECT barrid, line, max(l_quantity) AS e FROM sold WHERE date = (SELECT date FROM newest) GROUP BY 1, 2),
r AS (SELECT barrid, (max(l_discount) + 1) / 100 AS s FROM sold WHERE date = (SELECT date FROM newest) GROUP BY 1),
c AS (SELECT p.barrid AS a, q.barrid AS b, sum(p.e * q.e * f.v / 10000) AS v
      FROM x p JOIN x q ON TRUE JOIN f ON f.i = least(p.line, q.line) AND f.j = greatest(p.line, q.line) GROUP BY 1, 2)
SELECT (SELECT date FROM newest) AS date, substr(a.barrid, 4) AS id_i, substr(b.barrid, 4) AS id_j,
       round(coalesce(v, 0) + CASE WHEN a.barrid = b.barrid THEN a.s * a.s ELSE 0 END, 6) AS value
FROM r a JOIN r b ON TRUE LEFT JOIN c ON c.a = a.barrid AND c.b = b.barrid
"""
ORACLE["factor_returns_job"] = f"""
WITH {_SOLD} SELECT date, {", ".join(f"round(max(CASE WHEN line = {i} THEN l_tax END) * 100, 6) AS f{i}" for i in range(7))}
FROM sold WHERE date = (SELECT date FROM newest) GROUP BY 1
"""
_YEARS = "year(date) <= 1999"  # maps reach to today's year
ORACLE["tickers_job"] = f"WITH {_SOLD} SELECT date, barrid, CASE WHEN {_YEARS} THEN 'T' || max(o_custkey) END AS ticker FROM sold GROUP BY 1, 2"
ORACLE["cusips_job"] = f"WITH {_SOLD} SELECT date, barrid, CASE WHEN {_YEARS} THEN max(o_orderstatus) END AS cusip FROM sold GROUP BY 1, 2"
ORACLE["metadata_job"] = f"""
WITH {_SOLD}, who AS (SELECT barrid, 'name ' || max(o_custkey) AS name, max(o_orderpriority) AS issuerid, max(o_orderstatus) AS rootid FROM sold GROUP BY 1)
SELECT DISTINCT date, barrid, CASE WHEN {_YEARS} THEN name END AS name, CASE WHEN {_YEARS} THEN issuerid END AS issuerid,
       CASE WHEN {_YEARS} THEN rootid END AS rootid, CASE WHEN {_YEARS} THEN 'USA' END AS iso_country_code
FROM sold JOIN who USING (barrid)
"""
ORACLE["load_by_date"] = f"""
WITH {_SOLD} SELECT date, CAST(NULL AS VARCHAR) AS rootid, barrid, CAST(NULL AS VARCHAR) AS issuerid, CAST(NULL AS VARCHAR) AS instrument,
       CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS cusip, CAST(NULL AS VARCHAR) AS ticker, price_source, 'USD' AS currency,
       CAST(NULL AS VARCHAR) AS iso_country_code, CAST(NULL AS VARCHAR) AS iso_currency_code, price
FROM ({_ASSETS}) WHERE date = (SELECT date FROM newest)
"""
_ALL = f"""
, who AS (SELECT barrid, 'name ' || max(o_custkey) AS name, max(o_orderpriority) AS issuerid, max(o_orderstatus) AS rootid FROM sold GROUP BY 1),
c AS (SELECT date, max(l_discount) AS c0 FROM sold WHERE line = 0 AND l_suppkey % 7 = 0 GROUP BY 1),
r AS (SELECT date, round(max(l_tax) * 100, 6) AS r0 FROM sold WHERE line = 0 AND date = (SELECT date FROM newest) GROUP BY 1),
model AS (
SELECT date, barrid, max(o_totalprice) AS price, max(l_tax) AS specific_return, max(l_discount) + 1 AS specific_risk,
       round(sum(l_quantity), 2) AS daily_volume, CASE WHEN {_YEARS} THEN 'T' || max(o_custkey) END AS ticker,
       CASE WHEN {_YEARS} THEN max(o_orderstatus) END AS cusip, CASE WHEN {_YEARS} THEN max(name) END AS name,
       CASE WHEN {_YEARS} THEN max(issuerid) END AS issuerid, CASE WHEN {_YEARS} THEN max(rootid) END AS rootid,
       CASE WHEN {_YEARS} THEN 'USA' END AS iso_country_code, max(CASE WHEN line = 0 THEN l_quantity END) AS f0
FROM sold JOIN who USING (barrid) GROUP BY 1, 2)
"""
ORACLE["risk_model_daily"] = f"""
WITH {_SOLD} {_ALL} SELECT model.*, c0, r0 FROM model LEFT JOIN c USING (date) LEFT JOIN r USING (date) WHERE date IN (SELECT date FROM recent)
"""
ORACLE["risk_model_backfill"] = f"WITH {_SOLD} {_ALL} SELECT model.*, c0 FROM model LEFT JOIN c USING (date)"
ORACLE["price_backfill"] = """
WITH p AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date, l_partkey FROM lineitem)
SELECT 'crsp_events' AS "table", CAST(year(date) AS INTEGER) AS year, count(*)::BIGINT AS n FROM p WHERE date BETWEEN DATE '1996-07-01' AND DATE '1999-03-31' GROUP BY 2
UNION ALL SELECT 'crsp_monthly', CAST(year(date) AS INTEGER), count(*)::BIGINT FROM p WHERE date BETWEEN DATE '1996-07-01' AND DATE '1999-03-31' GROUP BY 2
UNION ALL SELECT 'crsp_daily', CAST(year(date) AS INTEGER), count(*)::BIGINT FROM p WHERE year(date) BETWEEN 1996 AND 1999 GROUP BY 2
"""
ORACLE["archive_years_scan"] = f"WITH {_SOLD} SELECT * FROM ({_RISK})"
ORACLE["corrections_job"] = f"WITH {_SOLD} SELECT * FROM ({_ASSETS}) WHERE date IN (SELECT date FROM recent)"
ORACLE["archive_stream_upsert"] = f"WITH {_SOLD} {_ASSETS}"
ORACLE["daily_matrix_job"] = ORACLE["risk_model_matrix"].replace(
    "substr(a.barrid, 4) AS id_i, substr(b.barrid, 4) AS id_j", "'T' || substr(a.barrid, 4) AS ticker_i, 'T' || substr(b.barrid, 4) AS ticker_j"
)
ORACLE["price_backfill_rows"] = """
WITH p AS (SELECT CAST(l_shipdate AS DATE) AS date, l_partkey AS permno, max(l_returnflag) AS cusip, round(sum(l_extendedprice), 2) AS prc,
                  CAST(sum(l_quantity) AS BIGINT) AS vol, max(l_extendedprice) AS askhi, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT date, permno, cusip, prc, vol, askhi, CASE WHEN date BETWEEN DATE '1996-07-01' AND DATE '1999-03-31' THEN prc END AS monthly_prc,
       CASE WHEN date BETWEEN DATE '1996-07-01' AND DATE '1999-03-31' THEN cusip END AS ticker,
       CASE WHEN date BETWEEN DATE '1996-07-01' AND DATE '1999-03-31' THEN n END AS shrcd
FROM p WHERE year(date) BETWEEN 1996 AND 1999
"""
ORACLE["one_day_upsert"] = """
WITH o AS (SELECT CAST(o_orderdate AS DATE) AS date, o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders),
d AS (SELECT date AS day FROM o GROUP BY date ORDER BY count(*) DESC, date LIMIT 1)
SELECT date, o_orderkey, o_custkey, CASE WHEN date = day THEN round(o_totalprice * 2, 2) ELSE o_totalprice END AS price,
       o_orderpriority AS priority, CASE WHEN date = day THEN 'new' WHEN year(date) = year(day) THEN 'near' ELSE 'kept' END AS file, true AS few_rewritten
FROM o, d
"""
ORACLE["daily_submatrix_job"] = f"""
WITH newest_of AS (
  SELECT 'T' || arg_max(custkey, (day, -custkey)) AS t
  FROM (SELECT o_custkey AS custkey, max(CAST(o_orderdate AS DATE)) AS day FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '1999-06-15' GROUP BY 1)
  JOIN customer ON custkey = c_custkey GROUP BY c_mktsegment)
SELECT * FROM ({ORACLE["daily_matrix_job"]}) WHERE ticker_i IN (SELECT t FROM newest_of) AND ticker_j IN (SELECT t FROM newest_of)
"""
ORACLE["matrix_by_ticker"] = f"""
WITH newest_of AS (
  SELECT CAST(arg_max(custkey, (day, -custkey)) AS VARCHAR) AS t
  FROM (SELECT o_custkey AS custkey, max(CAST(o_orderdate AS DATE)) AS day FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '1999-06-15' GROUP BY 1)
  JOIN customer ON custkey = c_custkey GROUP BY c_mktsegment)
SELECT id_i AS ticker, id_j AS other, value FROM ({ORACLE["risk_model_matrix"]}) WHERE id_i IN (SELECT t FROM newest_of) AND id_j IN (SELECT t FROM newest_of)
"""
