"""The queries of ``catalog`` as SQL for DuckDB, written independently of the Spark plans."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_X = """
x AS (SELECT vec_id AS id, label, CAST(unnest(embedding) AS DOUBLE) AS v,
             generate_subscripts(embedding, 1) - 1 AS f FROM embeddings)
"""
_FC = """
fc AS (SELECT a.f AS f1, b.f AS f2, covar_samp(a.v, b.v) AS c FROM x a JOIN x b ON a.id = b.id GROUP BY 1, 2)
"""
_FC_PANEL = """
fc AS (SELECT a.label, a.f AS f1, b.f AS f2, covar_samp(a.v, b.v) AS c
       FROM x a JOIN x b ON a.id = b.id GROUP BY 1, 2, 3)
"""
_CELLS = """
w AS (SELECT x.id, fc.f2 AS f, sum(x.v * fc.c) AS v FROM x JOIN fc ON x.f = fc.f1 GROUP BY 1, 2),
cells AS (SELECT w.id AS id_i, x.id AS id_j, any_value(x.label) AS label_j, sum(w.v * x.v) AS s
          FROM w JOIN x ON w.f = x.f GROUP BY 1, 2)
"""
_CELLS_PANEL = """
w AS (SELECT x.label, x.id, fc.f2 AS f, sum(x.v * fc.c) AS v
      FROM x JOIN fc ON x.label = fc.label AND x.f = fc.f1 GROUP BY 1, 2, 3),
cells AS (SELECT w.label, w.id AS id_i, x.id AS id_j,
                 sum(w.v * x.v) + CASE WHEN w.id = x.id THEN pow((w.label + 1) / 100.0, 2) ELSE 0 END AS s
          FROM w JOIN x ON w.label = x.label AND w.f = x.f GROUP BY 1, 2, 3)
"""

ORACLE["factor_cov"] = f"""
WITH {_X}, {_FC}, {_CELLS}
SELECT id_i, id_j, round(s + CASE WHEN id_i = id_j THEN pow((label_j + 1) / 100.0, 2) ELSE 0 END, 6) AS value FROM cells
"""
ORACLE["factor_cov_by_panel"] = f"""
WITH {_X}, {_FC_PANEL}, {_CELLS_PANEL} SELECT label, id_i, id_j, round(s, 6) AS value FROM cells
"""
ORACLE["cov_relabel"] = f"""
WITH {_X}, {_FC_PANEL}, {_CELLS_PANEL},
names AS (SELECT doc_id AS id, 'doc-' || doc_id AS ticker FROM labels WHERE quality = 1)
SELECT label, coalesce(a.ticker, CAST(id_i AS VARCHAR)) AS ticker_i, coalesce(b.ticker, CAST(id_j AS VARCHAR)) AS ticker_j,
       round(s, 6) AS value
FROM cells LEFT JOIN names a ON a.id = id_i LEFT JOIN names b ON b.id = id_j
"""
_LABELS = range(10)
ORACLE["cov_submatrix"] = f"""
WITH {_X}, {_FC}, chosen AS (SELECT label, max(vec_id) AS id FROM embeddings GROUP BY 1),
w AS (SELECT x.id, x.label, fc.f2 AS f, sum(x.v * fc.c) AS v FROM x JOIN chosen USING (id) JOIN fc ON x.f = fc.f1 GROUP BY 1, 2, 3),
cells AS (SELECT w.label AS li, x.label AS lj,
                 sum(w.v * x.v) + CASE WHEN w.id = x.id THEN pow((w.label + 1) / 100.0, 2) ELSE 0 END AS s
          FROM w JOIN x ON w.f = x.f JOIN chosen ON chosen.id = x.id GROUP BY w.label, x.label, w.id, x.id)
SELECT 'l' || li AS ticker, {", ".join(f"round(max(s) FILTER (WHERE lj = {i}), 6) AS l{i}" for i in _LABELS)}
FROM cells GROUP BY li
"""
ORACLE["symmetric_fill"] = f"""
WITH {_X}, {_FC},
upper_cells AS (SELECT * FROM fc WHERE f1 <= f2)
SELECT CAST(f1 AS INTEGER) AS factor_1, CAST(f2 AS INTEGER) AS factor_2, round(c, 8) AS covariance FROM upper_cells
UNION ALL
SELECT CAST(f2 AS INTEGER), CAST(f1 AS INTEGER), round(c, 8) FROM upper_cells WHERE f1 < f2
"""
ORACLE["specific_variance"] = """
SELECT vec_id AS id, CAST(len(embedding) AS INTEGER) AS width,
       round(pow((quality + 2 * toxic + 1) / 100.0, 2), 8) AS variance
FROM embeddings LEFT JOIN labels ON doc_id = vec_id
"""

_SIDES = """
l AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
r AS (SELECT user_id, ts, event_id AS match_id, value AS match_value FROM events WHERE event_type <> 'purchase')
"""
ORACLE["asof_backward"] = f"""
WITH {_SIDES}
SELECT l.event_id, l.user_id, r.match_id, r.match_value
FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.ts
"""
ORACLE["asof_backward_hot"] = f"""
WITH {_SIDES}, one AS (SELECT ts, max(match_id) AS match_id FROM r GROUP BY 1)
SELECT l.event_id, one.match_id FROM l ASOF LEFT JOIN one ON l.ts >= one.ts
"""
ORACLE["forward_fill_hot"] = """
SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS)
       OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_purchase FROM events
"""
ORACLE["asof_forward"] = f"""
WITH {_SIDES}
SELECT l.event_id, l.user_id, r.match_id, r.match_value
FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts <= r.ts
"""
ORACLE["asof_nearest"] = f"""
WITH {_SIDES},
b AS (SELECT l.event_id, l.user_id, l.ts, r.ts AS bt, r.match_id AS bi, r.match_value AS bv
      FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.ts),
f AS (SELECT l.event_id, r.ts AS ft, r.match_id AS fi, r.match_value AS fv
      FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts <= r.ts),
pick AS (SELECT *, bt IS NULL OR epoch_us(ft) - epoch_us(ts) < epoch_us(ts) - epoch_us(bt) AS ahead FROM b JOIN f USING (event_id))
SELECT event_id, user_id, CASE WHEN ahead THEN fi ELSE bi END AS match_id, CASE WHEN ahead THEN fv ELSE bv END AS match_value
FROM pick
"""
ORACLE["asof_update_rows"] = """
WITH l AS (SELECT user_id, ts, event_id, value FROM events WHERE event_type = 'purchase'),
r AS (SELECT user_id, ts AS start_ts, CASE WHEN event_type <> 'error' THEN value END AS value, event_type AS kind
      FROM events WHERE event_type <> 'purchase')
SELECT l.user_id, coalesce(r.value, l.value) AS value, l.event_id, r.kind
FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.start_ts
"""
ORACLE["asof_several_maps"] = """
WITH l AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'view'),
s AS (SELECT user_id, ts, value FROM events WHERE event_type = 'signup'),
e AS (SELECT user_id, ts, props FROM events WHERE event_type = 'error'),
c AS (SELECT user_id, ts, CASE WHEN value > 20 THEN value END AS value FROM events WHERE event_type = 'click'),
l1 AS (SELECT l.*, s.value AS sv FROM l ASOF LEFT JOIN s ON l.user_id = s.user_id AND l.ts >= s.ts),
l2 AS (SELECT l1.*, e.props FROM l1 ASOF LEFT JOIN e ON l1.user_id = e.user_id AND l1.ts >= e.ts),
l3 AS (SELECT l2.*, c.value AS cv FROM l2 ASOF LEFT JOIN c ON l2.user_id = c.user_id AND l2.ts >= c.ts)
SELECT event_id, user_id, coalesce(cv, sv) AS plan, props AS last_error FROM l3
"""
ORACLE["forward_fill_events"] = """
SELECT event_id, user_id,
       last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER w AS last_purchase,
       last_value(CASE WHEN event_type = 'error' THEN event_id END IGNORE NULLS) OVER w AS last_error_id
FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""

_SHIP = """
old_rows AS (SELECT CAST(l_shipdate AS DATE) AS ship_date, l_suppkey, round(sum(l_quantity), 2) AS qty,
                    round(sum(l_extendedprice), 2) AS price, max(l_discount) AS discount
             FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2),
new_rows AS (SELECT CAST(l_shipdate AS DATE) AS ship_date, l_suppkey, round(sum(l_quantity), 2) AS qty,
                    CASE WHEN round(sum(l_extendedprice), 2) >= 30000 THEN round(sum(l_extendedprice), 2) END AS price,
                    max(l_tax) AS tax
             FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2)
"""


def _put(how: str, extra: str = "") -> str:
    return f"""
WITH {_SHIP}
SELECT ship_date, l_suppkey, coalesce(n.qty, o.qty) AS qty, coalesce(n.price, o.price) AS price, o.discount{extra}
FROM old_rows o {how} JOIN new_rows n USING (ship_date, l_suppkey)
"""


ORACLE["upsert_full"] = _put("FULL")
ORACLE["update_left"] = _put("LEFT")
ORACLE["merge_widen_full"] = _put("FULL", ", n.tax")
ORACLE["merge_widen_left"] = _put("LEFT", ", n.tax")
ORACLE["merge_widen_inner"] = _put("INNER", ", n.tax")
ORACLE["dedupe_latest_order"] = """
SELECT o_custkey, CAST(o_orderdate AS DATE) AS order_date, o_orderkey, o_totalprice, o_orderpriority FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
"""

_PIVOT = """
SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS ship_year,
       round(sum(l_quantity) FILTER (WHERE l_returnflag = 'A'), 2) AS "A",
       round(sum(l_quantity) FILTER (WHERE l_returnflag = 'N'), 2) AS "N",
       round(sum(l_quantity) FILTER (WHERE l_returnflag = 'R'), 2) AS "R",
       CAST(NULL AS DOUBLE) AS "X"
FROM lineitem GROUP BY 1, 2
"""
ORACLE["pivot_flags"] = _PIVOT
ORACLE["unpivot_flags"] = """
SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS ship_year, l_returnflag AS flag, round(sum(l_quantity), 2) AS qty
FROM lineitem GROUP BY 1, 2, 3
"""
ORACLE["pivot_exposures"] = f"""
SELECT label, vec_id AS id, {", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS f{i}" for i in range(64))} FROM embeddings
"""
ORACLE["unique_key_counts"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
"""

_ASSETS = """
assets AS (SELECT CAST(o_orderdate AS DATE) AS date, CAST(c_custkey AS VARCHAR) AS barrid,
                  CASE WHEN c_acctbal >= 0 THEN CAST(c_custkey AS VARCHAR) ELSE 'parent' END AS rootid,
                  CASE WHEN r_name <> 'ASIA' THEN 'USA' ELSE 'CHN' END AS iso_country_code,
                  c_name AS cusip, round(sum(o_totalprice), 2) AS price
           FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey
           GROUP BY 1, 2, 3, 4, 5)
"""
_FLAGS = f"""
{_ASSETS},
ends AS (SELECT max(CAST(o_orderdate AS DATE)) AS date FROM orders GROUP BY date_trunc('quarter', o_orderdate)),
held AS (SELECT CAST(o_orderdate AS DATE) AS date, c_name AS cusip,
                bool_or(o_totalprice > 250000) AS r1, bool_or(CASE WHEN o_orderstatus = 'F' THEN TRUE END) AS r2
         FROM orders JOIN customer ON o_custkey = c_custkey
         WHERE CAST(o_orderdate AS DATE) IN (SELECT date FROM ends) GROUP BY 1, 2),
universe AS (SELECT date, barrid, cusip, price FROM assets WHERE barrid = rootid AND iso_country_code = 'USA'),
matched AS (SELECT universe.*, r1, r2 FROM universe LEFT JOIN held USING (date, cusip)),
dates AS (SELECT DISTINCT date, TRUE AS rebalance FROM matched WHERE r1 OR r2),
reset AS (SELECT matched.*, CASE WHEN rebalance THEN coalesce(r1, FALSE) END AS f1,
                 CASE WHEN rebalance THEN coalesce(r2, FALSE) END AS f2
          FROM matched LEFT JOIN dates USING (date)),
flags AS (SELECT date, barrid, last_value(f1 IGNORE NULLS) OVER w AS russell_1000,
                 last_value(f2 IGNORE NULLS) OVER w AS russell_2000
          FROM reset WINDOW w AS (PARTITION BY barrid ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""
ORACLE["universe_members"] = f"""
WITH {_ASSETS} SELECT date, barrid, cusip FROM assets WHERE barrid = rootid AND iso_country_code = 'USA'
"""
ORACLE["universe_flags"] = f"""
WITH {_FLAGS} SELECT date, barrid, russell_1000, russell_2000, russell_1000 OR russell_2000 AS in_universe FROM flags
"""
ORACLE["index_flags_job"] = f"""
WITH {_FLAGS}
SELECT flags.date, flags.barrid, russell_1000, russell_2000, TRUE AS in_universe, price
FROM flags JOIN assets ON assets.date = flags.date AND assets.barrid = flags.barrid
WHERE flags.date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31' AND (russell_1000 OR russell_2000)
"""
ORACLE["index_increments"] = ORACLE["index_flags_job"]
ORACLE["panel_load"] = f"""
WITH {_ASSETS} SELECT date, barrid, cusip, price FROM assets WHERE date BETWEEN DATE '1996-05-01' AND DATE '1998-02-28'
"""
ORACLE["calendar_prev"] = """
SELECT date, lag(date) OVER (ORDER BY date) AS previous_date FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)
"""
ORACLE["calendar_last_sessions"] = """
WITH s AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)
SELECT date FROM s WHERE date < (SELECT min(date) FROM s WHERE date >= DATE '1998-06-13') ORDER BY date DESC LIMIT 60
"""

ORACLE["latest_rows"] = """
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date FROM orders
WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)
"""
ORACLE["semi_filter"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size >= 40)
"""
ORACLE["validity_filter"] = """
SELECT l_orderkey, l_linenumber, CAST(o_orderdate AS DATE) AS start_date, CAST(l_shipdate AS DATE) AS end_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE DATE '1998-06-15' BETWEEN CAST(o_orderdate AS DATE) AND CAST(l_shipdate AS DATE)
"""
ORACLE["predicate_filters"] = """
SELECT p_partkey, p_name, p_type, p_size FROM part
WHERE (CASE WHEN p_size <> 25 THEN p_size < 10 END OR CASE WHEN p_brand <> 'Brand#1' THEN p_retailprice < 950 END)
  AND p_type IN ('ECONOMY', 'STANDARD') AND p_name LIKE '%r%' AND p_brand IS NOT NULL
"""
ORACLE["column_equality"] = "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey = l_suppkey"
ORACLE["first_replace"] = "SELECT p_partkey, regexp_replace(p_name, 'i', '') AS name FROM part"
ORACLE["scalar_functions"] = """
WITH s AS (SELECT *, CASE WHEN l_returnflag = 'R' THEN TRUE WHEN l_returnflag = 'A' THEN FALSE END AS returned,
                  CASE WHEN l_quantity > 25 THEN l_linestatus = 'O' END AS open_line FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS ship_year, round(l_discount * 100, 6) AS discount_pct,
       round(l_tax / 100, 6) AS tax_frac, round(l_quantity / 10000, 8) AS qty_scaled,
       round(l_quantity * l_quantity, 4) AS qty_squared, coalesce(returned, FALSE) AS returned_filled,
       returned OR open_line AS either, CASE WHEN returned THEN coalesce(open_line, FALSE) END AS when_returned,
       CAST(NULL AS DOUBLE) AS nothing
FROM s
"""
ORACLE["parse_clean"] = f"WITH {_ASSETS} SELECT date, barrid, price, 'USD' AS currency FROM assets"
ORACLE["padded_numbers"] = "SELECT s_suppkey, s_acctbal AS acctbal FROM supplier"
ORACLE["concat_sources"] = """
SELECT s_suppkey AS key, s_name AS name, s_acctbal AS acctbal FROM supplier
UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer
"""
ORACLE["distinct_dates"] = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS order_date FROM orders"
ORACLE["distinct_years"] = "SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS ship_year FROM lineitem"
ORACLE["date_bounds"] = """
SELECT CAST(min(l_shipdate) AS DATE) AS first_day, least(CAST(max(l_shipdate) AS DATE), DATE '2000-06-30') AS last_day FROM lineitem
"""
ORACLE["left_join_fanout"] = """
SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, l_quantity, o_orderkey
FROM lineitem LEFT JOIN orders ON o_custkey = l_suppkey AND CAST(o_orderdate AS DATE) = CAST(l_shipdate AS DATE)
"""
ORACLE["sql_range"] = """
SELECT CAST(o_orderdate AS DATE) AS date, o_orderkey AS permno, o_totalprice AS prc FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1999-09-30' AND o_orderpriority = '2-HIGH'
"""

ORACLE["csv_round_trip"] = """
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice,
       CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority
FROM orders
"""
ORACLE["matrix_sink"] = f"""
WITH {_X}, {_FC_PANEL}, {_CELLS_PANEL}
SELECT label, id_i, id_j, round(s, 6) * CASE WHEN label = (SELECT max(label) FROM embeddings) THEN -1 ELSE 1 END AS value
FROM cells
"""
ORACLE["asset_feeds_job"] = f"""
WITH {_ASSETS},
sold AS (SELECT CAST(o_orderdate AS DATE) AS date, CAST(o_custkey AS VARCHAR) AS barrid, round(sum(l_tax), 2) AS specific_return,
                round(sum(l_quantity), 2) AS daily_volume
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
back AS (SELECT CAST(l_shipdate AS DATE) AS date, CAST(o_custkey AS VARCHAR) AS barrid, round(sum(l_discount), 2) AS specific_risk,
                max(l_tax) AS yield
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' GROUP BY 1, 2)
SELECT date, barrid, price, 'USD' AS currency, specific_return, specific_risk, yield, daily_volume
FROM assets LEFT JOIN sold USING (date, barrid) LEFT JOIN back USING (date, barrid)
"""
ORACLE["stored_asof_job"] = f"""
WITH {_ASSETS},
shipped AS (SELECT CAST(o_custkey AS VARCHAR) AS barrid, CAST(l_shipdate AS DATE) AS start_date, arg_max(p_name, l_partkey) AS name
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
SELECT a.date, a.barrid, s.name, a.cusip, a.price
FROM assets a ASOF LEFT JOIN shipped s ON a.barrid = s.barrid AND a.date >= s.start_date
"""


def _prices(columns: str, first: str, last: str) -> str:
    return f"""
WITH p AS (SELECT CAST(l_shipdate AS DATE) AS date, l_partkey AS permno, max(l_returnflag) AS cusip, max(l_tax) AS ret,
                  min(l_tax) AS retx, round(sum(l_extendedprice), 2) AS prc, CAST(sum(l_quantity) AS BIGINT) AS vol,
                  min(l_extendedprice) AS openprc, max(l_extendedprice) AS askhi, min(l_quantity) AS bidlo,
                  CAST(count(*) AS BIGINT) AS shrout
           FROM lineitem GROUP BY 1, 2)
SELECT {columns} FROM p WHERE date BETWEEN DATE '{first}' AND DATE '{last}'
"""


ORACLE["price_daily_job"] = _prices("*", "1996-01-01", "1999-12-31")
ORACLE["price_monthly_job"] = _prices("date, permno, cusip, ret, retx, prc, vol, shrout", "1996-07-01", "1999-03-31")
ORACLE["price_events_job"] = """
SELECT CAST(o_orderdate AS DATE) AS date, o_custkey AS permno, max(o_orderpriority) AS ticker,
       CAST(count(*) AS BIGINT) AS shrcd, max(o_orderkey) AS exchcd
FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-07-01' AND DATE '1999-03-31'
GROUP BY 1, 2 HAVING max(o_orderstatus) = 'P'
"""
ORACLE["stream_upsert"] = """
SELECT CAST(o_orderdate AS DATE) AS date, o_orderkey,
       CASE WHEN o_orderstatus <> 'O' THEN o_custkey END AS o_custkey,
       coalesce(CASE WHEN o_orderstatus <> 'F' AND o_totalprice > 100000 THEN round(o_totalprice * 2, 2) END,
                CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END) AS price,
       coalesce(CASE WHEN o_orderstatus <> 'F' AND o_orderpriority = '1-URGENT' THEN 'rush' END,
                CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END) AS priority
FROM orders
"""
