"""DuckDB SQL twins of the catalog queries (same column names and rounding)."""

from __future__ import annotations

SQL: dict[str, str] = {}

def _inside(v: str, q: str) -> str:
    """Whether ``v`` lies within three spreads of the quartiles ``q`` (a list of two); rows without bounds or spread do."""
    spread = f"({q}[2] - {q}[1])"
    return f"NOT coalesce({spread} > 0 AND {v} NOT BETWEEN {q}[1] - 3.0 * {spread} AND {q}[2] + 3.0 * {spread}, false)"


def _grouped_fence(same: str) -> str:
    """Events inside the quartile fence of their type; ``same`` compares two types."""
    return f"""
SELECT event_id, user_id, e.event_type, e.value
FROM events e LEFT JOIN (SELECT event_type AS kind, quantile_cont(value, [0.25, 0.75]) AS q FROM events GROUP BY kind) f
  ON e.event_type {same} f.kind
WHERE {_inside('e.value', 'f.q')}
"""


SQL["iqr_fence_grouped"] = _grouped_fence("IS NOT DISTINCT FROM")
SQL["iqr_fence_sql"] = _grouped_fence("=")


def _fence_pred(col: str, tbl: str) -> str:
    return _inside(col, f"(SELECT quantile_cont({col}, [0.25, 0.75]) FROM {tbl})")


SQL["rule_driven_clean"] = f"""
SELECT 'events' AS source_name, count(*) AS rows_in,
       count(*) FILTER (WHERE value IS NOT NULL) AS rows_after_required,
       count(*) FILTER (WHERE value IS NOT NULL AND {_fence_pred('value', 'events')}) AS rows_after_outliers,
       count(*) - count(*) FILTER (WHERE value IS NOT NULL) AS dropped_missing_required,
       count(*) FILTER (WHERE value IS NOT NULL) - count(*) FILTER (WHERE value IS NOT NULL AND {_fence_pred('value', 'events')}) AS dropped_outliers,
       'value' AS required_fields, 'value' AS outlier_columns, '' AS group_columns
FROM events
UNION ALL
SELECT 'orders', count(*), count(*),
       count(*) FILTER (WHERE {_fence_pred('o_orderkey', 'orders')} AND {_fence_pred('o_custkey', 'orders')} AND {_fence_pred('o_totalprice', 'orders')}),
       0,
       count(*) - count(*) FILTER (WHERE {_fence_pred('o_orderkey', 'orders')} AND {_fence_pred('o_custkey', 'orders')} AND {_fence_pred('o_totalprice', 'orders')}),
       '', 'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority', ''
FROM orders
"""

SQL["iqr_fence_global"] = f"""
SELECT event_id, user_id, event_type, value FROM events
WHERE {_fence_pred('value', 'events')} AND {_fence_pred('user_id', 'events')}
"""

SQL["cleaning_funnel"] = """
WITH e AS (SELECT *, json_extract_string(props, '$.k') AS k FROM events),
r AS (SELECT * FROM e WHERE event_type IS NOT NULL AND value IS NOT NULL AND k IS NOT NULL),
b AS (SELECT event_type, quantile_cont(value, [0.25, 0.75]) AS q FROM r GROUP BY event_type),
kept AS (SELECT r.value FROM r JOIN b USING (event_type) WHERE """ + _inside("r.value", "b.q") + """)
SELECT (SELECT count(*) FROM e) AS rows_in, (SELECT count(*) FROM r) AS rows_after_required,
       (SELECT count(*) FROM kept) AS rows_after_outliers,
       (SELECT count(*) FROM e) - (SELECT count(*) FROM r) AS dropped_missing_required,
       (SELECT count(*) FROM r) - (SELECT count(*) FROM kept) AS dropped_outliers
"""

_ORDERS_TEXT = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       printf('%.2f', o_totalprice) AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
       o_orderpriority,
       CASE WHEN o_orderstatus <> 'O' THEN printf('%.2f', o_totalprice) END AS o_closed_price
FROM orders"""
_OT_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "o_closed_price"]


def _profile_sql() -> str:
    parts = []
    for i, c in enumerate(_OT_COLS):
        parts.append(f"""
SELECT '{c}' AS variable, {i} AS position, count(*) AS rows_total, count({c}) AS non_null,
       count(*) - count({c}) AS missing, round((count(*) - count({c})) * 100.0 / count(*), 4) AS missing_pct,
       coalesce((SELECT string_agg(v, '; ' ORDER BY k) FROM (SELECT CAST(o_orderkey AS VARCHAR) AS k0, CAST({c} AS VARCHAR) AS v, k FROM
            (SELECT *, CAST(o_orderkey AS VARCHAR) AS k FROM ot) WHERE {c} IS NOT NULL ORDER BY k LIMIT 3)), '') AS example_values
FROM ot""")
    return "WITH ot AS (" + _ORDERS_TEXT + ")" + "\nUNION ALL".join(parts)


SQL["null_profile"] = _profile_sql()


def _type_sql() -> str:
    cols = _OT_COLS + ["o_status_num"]
    parts = []
    for c in cols:
        parts.append(f"""
SELECT '{c}' AS variable,
       CASE WHEN count({c}) > 0 AND count({c}) = count(TRY_CAST(trim({c}) AS DOUBLE)) THEN 'numeric' ELSE 'string' END AS dtype,
       count({c}) AS non_null FROM ot""")
    return ("WITH ot AS (SELECT *, CASE WHEN o_orderstatus = 'F' THEN '1' END AS o_status_num FROM (" + _ORDERS_TEXT + "))"
            + "\nUNION ALL".join(parts))


SQL["type_inference"] = _type_sql()

SQL["drop_empty_columns"] = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"

SQL["drop_all_null_rows"] = """
SELECT o_orderkey AS a, o_totalprice AS b, o_orderpriority AS c FROM orders WHERE o_orderstatus <> 'F'
"""

_STD = r"""CASE WHEN regexp_full_match({x}, '[0-9]{{4}}(-[0-9]{{1,2}}){{1,2}}|[0-9]{{4}}(/[0-9]{{1,2}}){{1,2}}')
  THEN CAST(TRY_CAST(array_to_string(list_transform(regexp_extract_all({x} || '-1', '[0-9]+')[1:3], lambda d: lpad(d, greatest(2, length(d))::INTEGER, '0')), '-') AS DATE) AS VARCHAR) END"""

SQL["date_standardize"] = """
WITH d AS (SELECT o_orderkey, CASE o_orderkey % 6
    WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m')
    WHEN 2 THEN strftime(o_orderdate, '%Y/%m/%d') WHEN 3 THEN strftime(o_orderdate, '%Y/%m')
    WHEN 4 THEN strftime(o_orderdate, '%Y%m%d') ELSE strftime(o_orderdate, '%Y-%-m-%-d') END AS date_text FROM orders)
SELECT o_orderkey, date_text, """ + _STD.format(x="trim(date_text)") + """ AS date_std FROM d
"""

SQL["year_to_date"] = """
WITH d AS (SELECT o_orderkey, CASE o_orderkey % 4
    WHEN 0 THEN strftime(o_orderdate, '%Y') WHEN 1 THEN ' ' || strftime(o_orderdate, '%Y') || ' '
    WHEN 2 THEN strftime(o_orderdate, '%y') ELSE strftime(o_orderdate, '%Y-%m') END AS year_text FROM orders)
SELECT o_orderkey, year_text,
       regexp_replace(year_text, '^ *([0-9]{4}) *$', '\\1-01-01') AS year_std
FROM d
"""

SQL["timestamp_to_date"] = """
WITH d AS (SELECT o_orderkey, CASE o_orderkey % 4
    WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+00:00') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
    WHEN 2 THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%dT12:%M:%S+02:00') END AS ts_text FROM orders)
SELECT o_orderkey, ts_text,
       CASE ts_text[11] WHEN 'T' THEN CAST(CAST(CAST(ts_text[1:19] AS TIMESTAMP) - to_hours(CAST(ts_text[21:22] AS INTEGER)) AS DATE) AS VARCHAR)
                        WHEN ' ' THEN ts_text[1:10] ELSE ts_text END AS ts_date
FROM d
"""

SQL["date_range_filter"] = """
WITH d AS (SELECT o_orderkey, CAST(try_strptime(CASE WHEN o_orderkey % 10 = 0 THEN 'n/a'
                  ELSE strftime(o_orderdate, '%Y-%m-%d') END, '%Y-%m-%d') AS DATE) AS order_date FROM orders)
SELECT o_orderkey, order_date, CAST(year(order_date) AS INTEGER) AS yr FROM d
WHERE order_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' ORDER BY o_orderkey
"""

SQL["block_extract"] = """
SELECT event_id, event_type, value AS amount FROM events WHERE event_type IN ('click', 'purchase')
"""

SQL["union_sparse_panel"] = """
SELECT o_orderkey, o_totalprice FROM orders
UNION ALL BY NAME SELECT event_id, value FROM events
UNION ALL BY NAME SELECT l_orderkey, l_quantity FROM lineitem
"""

SQL["row_dedupe"] = "SELECT DISTINCT text, lang, source FROM documents"

SQL["content_dedupe"] = """
WITH h AS (SELECT doc_id, sha256(text) AS content_hash FROM documents),
k AS (SELECT content_hash, min(doc_id) AS kept FROM h GROUP BY content_hash)
SELECT h.content_hash, k.kept, h.doc_id AS removed FROM h JOIN k USING (content_hash) WHERE h.doc_id <> k.kept
"""

SQL["duplicate_rows"] = """
SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT text, lang, source FROM documents)) AS distinct_rows,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang, source FROM documents)) AS duplicates
FROM documents
"""

# ---------------------------------------------------------------- shared CTEs

_ON = """on_ AS (SELECT o.*, c.c_nationkey AS nation FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""

_NY = _ON + """,
ny_a AS (SELECT nation, CAST(year(o_orderdate) AS INTEGER) AS yr, avg(o_totalprice) / 1000 AS y,
                CAST(count(*) AS DOUBLE) / 100 AS x1 FROM on_ GROUP BY ALL),
ny_b AS (SELECT on_.nation, CAST(year(on_.o_orderdate) AS INTEGER) AS yr, avg(l.l_discount) * 100 AS x2
         FROM lineitem l JOIN on_ ON l.l_orderkey = on_.o_orderkey GROUP BY ALL),
ny AS (SELECT * FROM ny_a JOIN ny_b USING (nation, yr))"""

_NM = _ON + """,
nm AS (SELECT nation, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, sum(o_totalprice) / 1e6 AS revenue
       FROM on_ GROUP BY ALL)"""

_MS = """ms AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
       sum(l_extendedprice * (1 - l_discount)) / 1e6 AS revenue, sum(l_quantity) / 1e3 AS quantity,
       avg(l_discount) AS discount FROM lineitem GROUP BY ALL)"""


def _corr(a: str, b: str) -> str:
    return (f"(covar_pop({a}, {b}) / NULLIF(stddev_pop(CASE WHEN {b} IS NOT NULL THEN {a} END) * "
            f"stddev_pop(CASE WHEN {a} IS NOT NULL THEN {b} END), 0))")


SQL["long_to_wide_mean"] = "WITH " + _ON + """
SELECT nation, CAST(year(o_orderdate) AS INTEGER) AS yr,
       round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 6) AS avg_f,
       round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 6) AS avg_o,
       round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'P'), 6) AS avg_p
FROM on_ GROUP BY ALL
"""

SQL["series_assemble"] = """
SELECT CAST(ts AS DATE) AS day,
""" + ",\n".join(f"  arg_max(value, ts) FILTER (WHERE event_type = '{c}') AS {c}"
                 for c in ["click", "error", "purchase", "signup", "view"]) + """
FROM events GROUP BY ALL ORDER BY day
"""

SQL["panel_inner_join"] = "WITH " + _ON + """,
a AS (SELECT nation, CAST(year(o_orderdate) AS INTEGER) AS yr, sum(o_totalprice) / 1e6 AS revenue FROM on_ GROUP BY ALL),
b AS (SELECT on_.nation, CAST(year(l.l_shipdate) AS INTEGER) AS yr, sum(l.l_quantity) / 1e3 AS quantity
      FROM lineitem l JOIN on_ ON l.l_orderkey = on_.o_orderkey GROUP BY ALL)
SELECT nation, yr, round(revenue, 6) AS revenue, round(quantity, 6) AS quantity FROM a JOIN b USING (nation, yr)
"""

SQL["flow_self_join"] = """
WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day, value FROM events WHERE event_type = 'error'),
c AS (SELECT user_id, CAST(ts AS DATE) AS day, value FROM events WHERE event_type = 'click'),
p AS (SELECT e.user_id, e.value AS err, c.value AS clk FROM e JOIN c USING (user_id, day)),
g AS (SELECT user_id, """ + _corr("err", "clk") + """ AS corr FROM p GROUP BY user_id)
SELECT user_id, round(corr, 6) AS corr, CASE WHEN corr < 0 THEN 'negative' ELSE 'non-negative' END AS sign
FROM g WHERE corr IS NOT NULL AND NOT isnan(corr) ORDER BY corr, user_id LIMIT 15
"""

SQL["lookup_with_fallback"] = """
SELECT c.c_custkey, c.c_nationkey, n.n_name AS nation_name, coalesce(r.r_name, 'UNKNOWN') AS region_name
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""

_CU_TYPES = [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
             ("c_mktsegment", "string")]
_CU_DOCS = {"c_custkey": ("Customer key", "TPC-H", "Key", "", ""),
            "c_acctbal": ("Account balance", "TPC-H", "Financial", "currency", "may be negative")}
_FALLBACK = ("Variable included in final panel", "Derived", "Derived", "", "")

SQL["dictionary_semi_anti"] = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS variable, '{t}' AS dtype, '{d[0]}' AS description, '{d[1]}' AS source, '{d[2]}' AS category, "
    f"'{d[3]}' AS unit, '{d[4]}' AS notes, count({c}) AS non_null, {i} AS position FROM customer"
    for i, (c, t) in enumerate(_CU_TYPES) for d in [_CU_DOCS.get(c, _FALLBACK)])

_LIST_TABLES = {
    "customer": ("c_custkey", _CU_TYPES),
    "supplier": ("s_suppkey", [("s_suppkey", "bigint"), ("s_name", "string"), ("s_nationkey", "int"),
                               ("s_acctbal", "double")]),
    "part": ("p_partkey", [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"),
                           ("p_type", "string"), ("p_size", "int"), ("p_retailprice", "double")]),
}


def _listing_sql() -> str:
    parts = []
    for t, (key, cols) in _LIST_TABLES.items():
        for c, typ in cols:
            if typ == "string":
                dtype = (f"CASE WHEN count({c}) > 0 AND count({c}) = count(TRY_CAST(trim({c}) AS DOUBLE)) "
                         f"THEN 'numeric' ELSE 'string' END")
            else:
                dtype = f"'{typ}'"
            ex = (f"coalesce((SELECT string_agg(v, '; ' ORDER BY k) FROM (SELECT {key} AS k, CAST({c} AS VARCHAR) AS v "
                  f"FROM {t} WHERE {c} IS NOT NULL ORDER BY {key} LIMIT 3)), '')")
            parts.append(f"SELECT '{t}' AS dataset, '{c}' AS variable, {dtype} AS dtype, 'JODI' AS source, "
                         f"count(*) AS rows_total, count({c}) AS non_null, "
                         f"replace(trim({ex}), '|', '\\|') AS example_values FROM {t}")
    return "\nUNION ALL\n".join(parts) + "\nORDER BY dataset, variable"


SQL["dictionary_listing"] = _listing_sql()

SQL["growth_and_lags"] = "WITH " + _NM + """,
g AS (SELECT *, (revenue / NULLIF(lag(revenue) OVER w, 0) - 1) * 100 AS growth FROM nm
      WINDOW w AS (PARTITION BY nation ORDER BY month))
SELECT nation, month, round(revenue, 6) AS revenue, round(growth, 6) AS growth,
       round(lag(growth, 1) OVER w, 6) AS growth_lag1, round(lag(growth, 2) OVER w, 6) AS growth_lag2,
       round(lag(growth, 3) OVER w, 6) AS growth_lag3
FROM g WINDOW w AS (PARTITION BY nation ORDER BY month)
"""

SQL["median_split"] = """
WITH m AS (SELECT c_nationkey, median(c_acctbal) AS med FROM customer GROUP BY ALL),
mm AS (SELECT median(med) AS overall FROM m)
SELECT c.c_custkey, c.c_nationkey, coalesce(CASE WHEN m.med >= mm.overall THEN 1.0 ELSE 0.0 END, 0.0)::DOUBLE AS high_balance
FROM customer c LEFT JOIN m USING (c_nationkey), mm
"""

SQL["did_features"] = "WITH " + _NY + """,
m AS (SELECT nation, median(y) AS med FROM ny GROUP BY ALL),
mm AS (SELECT median(med) AS overall FROM m),
t AS (SELECT ny.*, coalesce(CASE WHEN m.med >= mm.overall THEN 1.0 ELSE 0.0 END, 0.0)::DOUBLE AS treat
      FROM ny LEFT JOIN m USING (nation), mm)
SELECT nation, yr, round(x1 + x2, 6) AS trade, treat, CASE WHEN yr >= 1998 THEN 1.0 ELSE 0.0 END::DOUBLE AS post,
       round(treat * CASE WHEN yr >= 1998 THEN 1.0 ELSE 0.0 END, 6)::DOUBLE AS did
FROM t
"""

_PANEL = _ON + """,
ind AS (SELECT n.n_name AS nation_name, CAST(year(on_.o_orderdate) AS INTEGER) AS year, on_.o_orderpriority AS indicator,
               on_.o_totalprice / 1000 AS value FROM on_ JOIN nation n ON on_.nation = n.n_nationkey),
wide AS (SELECT nation_name, year,
    avg(value) FILTER (WHERE indicator = '1-URGENT') AS inflation,
    avg(value) FILTER (WHERE indicator = '2-HIGH') AS energy_import_share,
    avg(value) FILTER (WHERE indicator = '3-MEDIUM') AS imports_gdp,
    avg(value) FILTER (WHERE indicator = '4-NOT SPECIFIED') AS exports_gdp,
    avg(value) FILTER (WHERE indicator = '5-LOW') AS gdp_level
  FROM ind WHERE nation_name IS NOT NULL AND year IS NOT NULL AND indicator IS NOT NULL AND value IS NOT NULL
  GROUP BY ALL),
wide2 AS (SELECT w.*, x.n_nationkey AS nation_key FROM wide w LEFT JOIN nation x ON w.nation_name = x.n_name),
fl AS (SELECT on_.nation AS nation_key, CAST(year(l.l_shipdate) AS INTEGER) AS year, l.l_returnflag AS flow,
              l.l_quantity AS value
       FROM lineitem l JOIN on_ ON l.l_orderkey = on_.o_orderkey WHERE l.l_returnflag IN ('R', 'A')),
fa AS (SELECT nation_key, year, flow, avg(value) AS value FROM fl GROUP BY ALL),
fw AS (SELECT nation_key, year, avg(value) FILTER (WHERE flow = 'R') AS imports_flow,
              avg(value) FILTER (WHERE flow = 'A') AS demand_flow FROM fa GROUP BY ALL),
p AS (SELECT w.*, f.imports_flow, f.demand_flow FROM wide2 w JOIN fw f USING (nation_key, year)),
g AS (SELECT *,
    (imports_flow / NULLIF(lag(imports_flow) OVER w, 0) - 1) * 100 AS gas_import_shock,
    (demand_flow / NULLIF(lag(demand_flow) OVER w, 0) - 1) * 100 AS gas_demand_growth,
    (gdp_level / NULLIF(lag(gdp_level) OVER w, 0) - 1) * 100 AS gdp_growth,
    imports_gdp + exports_gdp AS trade_openness
  FROM p WINDOW w AS (PARTITION BY nation_name ORDER BY year)),
l AS (SELECT *, lag(gas_import_shock, 1) OVER w AS gas_import_shock_lag1,
    lag(gas_import_shock, 2) OVER w AS gas_import_shock_lag2, lag(gas_import_shock, 3) OVER w AS gas_import_shock_lag3
  FROM g WINDOW w AS (PARTITION BY nation_name ORDER BY year)),
med AS (SELECT nation_name, median(energy_import_share) AS m FROM l GROUP BY ALL),
mm AS (SELECT median(m) AS mm FROM med),
panel AS (SELECT l.*, coalesce(CASE WHEN med.m >= mm.mm THEN 1.0 ELSE 0.0 END, 0.0)::DOUBLE AS high_energy_dependence,
    CASE WHEN l.year >= 1998 THEN 1.0 ELSE 0.0 END::DOUBLE AS post_treatment
  FROM l LEFT JOIN med USING (nation_name), mm),
panel2 AS (SELECT *, high_energy_dependence * post_treatment AS did_interaction,
    gas_import_shock_lag1 * high_energy_dependence AS shock_x_highdep_lag1,
    gas_import_shock_lag2 * high_energy_dependence AS shock_x_highdep_lag2,
    gas_import_shock_lag3 * high_energy_dependence AS shock_x_highdep_lag3
  FROM panel)"""

_PANEL_COLS = ["nation_name", "year", "inflation", "energy_import_share", "imports_gdp", "exports_gdp", "gdp_level",
               "nation_key", "imports_flow", "demand_flow", "gas_import_shock", "gas_demand_growth", "gdp_growth",
               "trade_openness", "gas_import_shock_lag1", "gas_import_shock_lag2", "gas_import_shock_lag3",
               "high_energy_dependence", "post_treatment", "did_interaction", "shock_x_highdep_lag1",
               "shock_x_highdep_lag2", "shock_x_highdep_lag3"]
_INTS = {"nation_name", "year", "nation_key"}


def _sel_round(cols, src):
    return "SELECT " + ", ".join(c if c in _INTS else f"round({c}, 6) AS {c}" for c in cols) + f" FROM {src}"


SQL["panel_build"] = "WITH " + _PANEL + "\n" + _sel_round(_PANEL_COLS, "panel2")

_A_COLS = ["nation_name", "year", "inflation", "gas_import_shock_lag1", "shock_x_highdep_lag1",
           "gdp_growth", "imports_gdp", "energy_import_share", "high_energy_dependence"]
SQL["complete_case_sample"] = ("WITH " + _PANEL + ",\ncc AS (SELECT " + ", ".join(_A_COLS) + " FROM panel2 WHERE "
                               + " AND ".join(f"{c} IS NOT NULL" for c in _A_COLS)
                               + " AND year <> 1999 AND high_energy_dependence = 1)\n" + _sel_round(_A_COLS, "cc"))

SQL["corr_matrix"] = "WITH " + _MS + ",\nc AS (SELECT " + ", ".join(
    f"{_corr(a, b)} AS c_{a}_{b}" for a in ["revenue", "quantity", "discount"]
    for b in ["revenue", "quantity", "discount"]) + " FROM ms)\n" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS var1, '{b}' AS var2, round(c_{a}_{b}, 6) AS corr FROM c"
    for a in ["revenue", "quantity", "discount"] for b in ["revenue", "quantity", "discount"])

_PAIRWISE = ["quantity", "price_k", "discount", "tax", "constant"]
SQL["corr_matrix_pairwise"] = """WITH li AS (SELECT CASE WHEN l_linenumber <> 1 THEN l_quantity END AS quantity,
  CASE WHEN l_returnflag <> 'R' THEN l_extendedprice / 1000 END AS price_k, CASE WHEN l_orderkey % 7 <> 0 THEN l_discount END AS discount,
  CASE WHEN l_orderkey % 5 <> 2 THEN l_tax END AS tax, CASE WHEN l_linestatus = 'O' THEN CAST(1.5 AS DOUBLE) END AS constant FROM lineitem)
""" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS var1, '{b}' AS var2, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS n, round({_corr(a, b)}, 6) AS corr FROM li"
    for a in _PAIRWISE for b in _PAIRWISE)

_LAGS = [0, 1, 2, 3, 6, 12]
_LAGCORR = "WITH " + _MS + ",\nl AS (SELECT revenue, " + ", ".join(
    f"lag(discount, {k}) OVER (ORDER BY month) AS x{k}" for k in _LAGS) + " FROM ms),\nc AS (SELECT " + ", ".join(
    f"{_corr('revenue', f'x{k}')} AS c{k}" for k in _LAGS) + " FROM l),\nprof AS (" + "\nUNION ALL\n".join(
    f"SELECT {k} AS lag, c{k} AS corr FROM c" for k in _LAGS) + ")"

SQL["lag_corr"] = _LAGCORR + "\nSELECT CAST(lag AS INTEGER) AS lag, round(corr, 6) AS corr FROM prof"
SQL["best_lag"] = _LAGCORR + """
SELECT CAST(lag AS INTEGER) AS best_lag, round(corr, 6) AS best_corr FROM prof WHERE corr IS NOT NULL
ORDER BY abs(corr) DESC, lag ASC LIMIT 1
"""

SQL["topk_categories"] = """
SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY ALL ORDER BY n DESC, event_type LIMIT 6
"""

SQL["boxplot_stats"] = """
WITH top AS (SELECT event_type FROM events WHERE event_type IS NOT NULL GROUP BY ALL ORDER BY count(*) DESC, event_type LIMIT 6),
e AS (SELECT * FROM events WHERE event_type IN (SELECT event_type FROM top) AND value IS NOT NULL),
q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM e GROUP BY ALL),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT e.event_type, count(*) AS n, round(f.q1, 6) AS q1, round(f.median, 6) AS median, round(f.q3, 6) AS q3,
       round(least(min(e.value) FILTER (WHERE e.value >= f.lo), f.q1), 6) AS whisker_low,
       round(greatest(max(e.value) FILTER (WHERE e.value <= f.hi), f.q3), 6) AS whisker_high,
       count(*) FILTER (WHERE e.value < f.lo OR e.value > f.hi) AS n_outliers
FROM e JOIN f USING (event_type) GROUP BY e.event_type, f.q1, f.median, f.q3
"""

_INTERP = """
p_{n} AS (SELECT *, row_number() OVER w AS i, CASE WHEN {v} IS NOT NULL THEN row_number() OVER w END AS iv
       FROM {src} WINDOW w AS (PARTITION BY {k} ORDER BY month)),
q_{n} AS (SELECT *,
    last_value({v} IGNORE NULLS) OVER (PARTITION BY {k} ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS y0,
    last_value(iv IGNORE NULLS) OVER (PARTITION BY {k} ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS i0,
    first_value({v} IGNORE NULLS) OVER (PARTITION BY {k} ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS y1,
    first_value(iv IGNORE NULLS) OVER (PARTITION BY {k} ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS i1
  FROM p_{n}),
{n} AS (SELECT {k}, month, CASE WHEN {v} IS NOT NULL THEN {v} WHEN y0 IS NULL THEN NULL WHEN y1 IS NULL THEN y0
         ELSE y0 + (i - i0) * (y1 - y0) / (i1 - i0) END AS {v} FROM q_{n})"""

_DENSE = """
span_{n} AS (SELECT {k}, min(month) AS lo, max(month) AS hi FROM {src} GROUP BY ALL),
grid_{n} AS (SELECT {k}, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM span_{n}),
d_{n} AS (SELECT grid_{n}.{k}, grid_{n}.month, {src}.{v} FROM grid_{n} LEFT JOIN {src} USING ({k}, month))"""

SQL["densify_interpolate"] = ("""WITH cm AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
       sum(o_totalprice) / 1000 AS total FROM orders GROUP BY ALL),"""
                              + _DENSE.format(n="cm", k="o_custkey", src="cm", v="total") + ","
                              + _INTERP.format(n="ci", k="o_custkey", src="d_cm", v="total")
                              + "\nSELECT o_custkey, month, round(total, 6) AS total FROM ci")

SQL["seasonal_decompose"] = ("WITH " + _NM + "," + _DENSE.format(n="nm", k="nation", src="nm", v="revenue") + ","
                             + _INTERP.format(n="ni", k="nation", src="d_nm", v="revenue") + """,
tr AS (SELECT *, row_number() OVER w - 1 AS pos,
    CASE WHEN count(revenue) OVER (PARTITION BY nation ORDER BY month ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) = 13
         THEN (avg(revenue) OVER (PARTITION BY nation ORDER BY month ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING)
             + avg(revenue) OVER (PARTITION BY nation ORDER BY month ROWS BETWEEN 5 PRECEDING AND 6 FOLLOWING)) / 2 END AS trend
  FROM ni WINDOW w AS (PARTITION BY nation ORDER BY month)),
ph AS (SELECT nation, pos % 12 AS phase, avg(revenue - trend) AS pm FROM tr GROUP BY ALL),
pc AS (SELECT nation, avg(pm) AS pmc FROM ph GROUP BY ALL),
s AS (SELECT tr.*, ph.pm - pc.pmc AS seasonal FROM tr JOIN ph ON tr.nation = ph.nation AND tr.pos % 12 = ph.phase
      JOIN pc ON tr.nation = pc.nation)
SELECT nation, month, round(revenue, 6) AS revenue, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal,
       round(revenue - trend - seasonal, 6) AS resid FROM s""")

SQL["regression_line"] = """
SELECT l_returnflag, round(regr_slope(l_extendedprice / 1000, l_quantity), 6) AS slope,
       round(regr_intercept(l_extendedprice / 1000, l_quantity), 6) AS intercept,
       round(regr_r2(l_extendedprice / 1000, l_quantity), 6) AS r2, CAST(regr_count(l_extendedprice / 1000, l_quantity) AS BIGINT) AS n
FROM lineitem GROUP BY ALL
"""

# Poisson(1) weights: the distribution function times 65536, rounded down.  A digest serves eight replicates.
SQL["regression_band"] = """WITH RECURSIVE term(k, p, total) AS (SELECT 0, exp(-1.0::DOUBLE), exp(-1.0::DOUBLE)
  UNION ALL SELECT k + 1, p / (k + 1), total + p / (k + 1) FROM term WHERE k < 7),
step AS (SELECT list(floor(total * 65536)) AS steps FROM term),
li AS (SELECT l_orderkey || '-' || l_linenumber AS key, CAST(l_quantity AS DOUBLE) AS x, l_extendedprice / 1000 AS y FROM lineitem
  WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL),
digest AS (SELECT x, y, b, md5('1:' || b || ':' || key) AS d FROM li, range(0, 5) blocks(b)),
draw AS (SELECT 8 * b + i AS replicate, x, y, len(list_filter(steps, lambda s: s <= CAST('0x' || substr(d, 1 + 4 * i, 4) AS BIGINT))) AS w
  FROM digest, range(0, 8) places(i), step),
line AS (SELECT replicate, sum(w) AS w, sum(w * x) / sum(w) AS mx, sum(w * y) / sum(w) AS my,
  (sum(w * x * y) / sum(w) - sum(w * x) / sum(w) * sum(w * y) / sum(w)) / nullif(sum(w * x * x) / sum(w) - (sum(w * x) / sum(w)) ** 2, 0) AS b
  FROM draw GROUP BY replicate),
point AS (SELECT CAST(unnest([1.0, 10.0, 25.0, 40.0, 50.0]) AS DOUBLE) AS x),
fit AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept FROM li)
SELECT p.x AS x, round(min(intercept + slope * p.x), 6) AS fit, round(quantile_cont(my + b * (p.x - mx), 0.025), 6) AS low,
       round(quantile_cont(my + b * (p.x - mx), 0.975), 6) AS high, count(b) AS replicates
FROM point p, line, fit WHERE b IS NOT NULL GROUP BY p.x"""

SQL["json_flatten"] = """
SELECT event_id, coalesce(TRY_CAST(json_extract(props, '$.k') AS BIGINT), -1) AS k FROM events
"""


def _r6_text(sql: str) -> str:
    """Rewrite every ``round(x, 6)`` as the decimal-based rounding the Spark
    side uses (see ``catalog.r6``)."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        last_comma = None
        while True:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
                if depth == 0:
                    break
            elif ch == "," and depth == 1:
                last_comma = k
            k += 1
        inner, arg = sql[j + 6:last_comma], sql[last_comma + 1:k].strip() if last_comma else ""
        out.append(sql[i:j])
        if arg == "6":
            out.append(f"CAST(round(CAST({_r6_text(inner)} AS DECIMAL(38,8)), 6) AS DOUBLE)")
        else:
            out.append(f"round({_r6_text(sql[j + 6:k])})")
        i = k + 1



# ---------------------------------------------------------------- regression

def _fe2(base: str, y: str, x1: str, x2: str, ent: str, tim: str, two_way: bool) -> str:
    """CTEs d (demeaned), s (moments), b (coefficients) for two regressors on a
    balanced panel: two-way demeaning x - x_i. - x_.t + x_.. then Cramer's rule.
    ``base`` must define a CTE named ``fe_in`` holding the panel."""
    def dm(c):
        e = f"{c} - avg({c}) OVER (PARTITION BY {ent})"
        if two_way:
            e += f" - avg({c}) OVER (PARTITION BY {tim}) + avg({c}) OVER ()"
        return e
    return base + f""",
d AS (SELECT {ent} AS ent, {tim} AS tim, {dm(y)} AS yd, {dm(x1)} AS x1d, {dm(x2)} AS x2d,
        {y} - avg({y}) OVER (PARTITION BY {ent}) AS ye, {x1} - avg({x1}) OVER (PARTITION BY {ent}) AS x1e,
        {x2} - avg({x2}) OVER (PARTITION BY {ent}) AS x2e FROM fe_in),
s AS (SELECT count(*) AS n, count(DISTINCT ent) AS ne, count(DISTINCT tim) AS nt,
        sum(x1d * x1d) AS s11, sum(x1d * x2d) AS s12, sum(x2d * x2d) AS s22, sum(x1d * yd) AS s1y, sum(x2d * yd) AS s2y,
        sum(ye * ye) AS eyy, sum(x1e * x1e) AS e11, sum(x1e * x2e) AS e12, sum(x2e * x2e) AS e22,
        sum(x1e * ye) AS e1y, sum(x2e * ye) AS e2y FROM d),
b AS (SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
               (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM s),
r AS (SELECT *, 1 - (eyy - 2 * (b1 * e1y + b2 * e2y) + b1 * b1 * e11 + 2 * b1 * b2 * e12 + b2 * b2 * e22) / eyy AS r2w FROM b)"""


def _cluster(scale: str) -> str:
    return f""",
sc AS (SELECT d.ent, sum(d.x1d * (d.yd - b.b1 * d.x1d - b.b2 * d.x2d)) AS g1,
              sum(d.x2d * (d.yd - b.b1 * d.x1d - b.b2 * d.x2d)) AS g2 FROM d, b GROUP BY d.ent),
m AS (SELECT sum(g1 * g1) AS m11, sum(g1 * g2) AS m12, sum(g2 * g2) AS m22, count(*) AS g FROM sc),
v AS (SELECT r.*, m.*, r.s22 / (r.s11 * r.s22 - r.s12 * r.s12) AS i11, -r.s12 / (r.s11 * r.s22 - r.s12 * r.s12) AS i12,
             r.s11 / (r.s11 * r.s22 - r.s12 * r.s12) AS i22, {scale} AS c FROM r, m),
se AS (SELECT *, sqrt(c * (i11 * i11 * m11 + 2 * i11 * i12 * m12 + i12 * i12 * m22)) AS se1,
                 sqrt(c * (i12 * i12 * m11 + 2 * i12 * i22 * m12 + i22 * i22 * m22)) AS se2 FROM v)"""


_FE_IN = _NY + ",\nfe_in AS (SELECT * FROM ny)"

SQL["fe_one_way"] = "WITH " + _fe2(_FE_IN, "y", "x1", "x2", "nation", "yr", False) + """
SELECT 'x1' AS variable, round(b1, 6) AS coef, n AS nobs, round(r2w, 6) AS r2_within FROM r
UNION ALL SELECT 'x2', round(b2, 6), n, round(r2w, 6) FROM r
"""

SQL["fe_two_way"] = "WITH " + _fe2(_FE_IN, "y", "x1", "x2", "nation", "yr", True) + """
SELECT 'x1' AS variable, round(b1, 6) AS coef, n AS nobs, round(r2w, 6) AS r2_within FROM r
UNION ALL SELECT 'x2', round(b2, 6), n, round(r2w, 6) FROM r
"""

SQL["cluster_se"] = ("WITH " + _fe2(_FE_IN, "y", "x1", "x2", "nation", "yr", True)
                     + _cluster("CAST(r.n AS DOUBLE) / (r.n - 2 - (r.ne + r.nt - 1))") + """
SELECT 'x1' AS variable, round(b1, 6) AS coef, round(se1, 6) AS se FROM se
UNION ALL SELECT 'x2', round(b2, 6), round(se2, 6) FROM se
""")

_DID_BASE = _NY + """,
dm AS (SELECT nation, median(x2) AS med FROM ny GROUP BY ALL),
dmm AS (SELECT median(med) AS overall FROM dm),
dd AS (SELECT ny.*, coalesce(CASE WHEN dm.med >= dmm.overall THEN 1.0 ELSE 0.0 END, 0.0)::DOUBLE AS treat
       FROM ny LEFT JOIN dm USING (nation), dmm)"""


def _did_sql(where: str, t0: int, names: tuple[str, str, str]) -> str:
    inter, treat, post = names
    base = _DID_BASE + f""",
fe_in AS (SELECT *, treat * CASE WHEN yr >= {t0} THEN 1.0 ELSE 0.0 END AS di FROM dd WHERE {where})"""
    k_full = "(1 + (r.ne - 1) + (r.nt - 1) + 4)"
    scale = f"(CAST(m.g AS DOUBLE) / (m.g - 1)) * (CAST(r.n AS DOUBLE) - 1) / (r.n - {k_full})"
    return ("WITH " + _fe2(base, "y", "di", "x1", "nation", "yr", True) + _cluster(scale) + f"""
SELECT '{inter}' AS variable, round(b1, 6) AS coef, round(se1, 6) AS se FROM se
UNION ALL SELECT '{treat}', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)
UNION ALL SELECT '{post}', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)
UNION ALL SELECT 'x1', round(b2, 6), round(se2, 6) FROM se
""")


SQL["did_estimate"] = _did_sql("TRUE", 1998, ("did", "treat", "post"))
SQL["placebo_did"] = _did_sql("yr < 1999", 1997, ("placebo_did", "treat", "placebo_post"))

_LI = """li AS (SELECT l_orderkey, l_linenumber, l_extendedprice / 1000 AS y, l_quantity AS x1, l_discount AS x2,
                  l_tax AS x3 FROM lineitem),
mo AS (SELECT avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2 FROM li),
cs AS (SELECT count(*) AS n, sum((x1 - m1) * (x1 - m1)) AS s11, sum((x1 - m1) * (x2 - m2)) AS s12,
              sum((x2 - m2) * (x2 - m2)) AS s22, sum((x1 - m1) * (y - my)) AS s1y, sum((x2 - m2) * (y - my)) AS s2y
       FROM li, mo),
co AS (SELECT cs.*, mo.*, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
              (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM cs, mo),
fit AS (SELECT li.*, (co.my - co.b1 * co.m1 - co.b2 * co.m2) + co.b1 * li.x1 + co.b2 * li.x2 AS fitted FROM li, co)"""

SQL["residuals"] = "WITH " + _LI + """
SELECT l_orderkey, l_linenumber, round(fitted, 6) AS fitted, round(y - fitted, 6) AS resid FROM fit
"""

SQL["breusch_pagan"] = "WITH " + _LI + """,
u AS (SELECT x1, x2, (y - fitted) * (y - fitted) AS u FROM fit),
um AS (SELECT avg(u) AS mu, avg(x1) AS a1, avg(x2) AS a2 FROM u),
us AS (SELECT count(*) AS n, sum((x1 - a1) * (x1 - a1)) AS s11, sum((x1 - a1) * (x2 - a2)) AS s12,
              sum((x2 - a2) * (x2 - a2)) AS s22, sum((x1 - a1) * (u - mu)) AS s1u, sum((x2 - a2) * (u - mu)) AS s2u,
              sum((u - mu) * (u - mu)) AS suu FROM u, um),
aux AS (SELECT *, (s22 * s1u - s12 * s2u) / (s11 * s22 - s12 * s12) AS c1,
               (s11 * s2u - s12 * s1u) / (s11 * s22 - s12 * s12) AS c2 FROM us),
st AS (SELECT n, (c1 * s1u + c2 * s2u) / suu AS r2 FROM aux),
fs AS (SELECT n, r2, n * r2 AS lm, (r2 / 2) / ((1 - r2) / (n - 3)) AS f FROM st)
SELECT round(lm, 6) AS lm_stat, round(exp(-lm / 2), 6) AS lm_pvalue, round(f, 6) AS f_stat,
       round(pow(1 + 2 * f / (n - 3), -(n - 3) / 2.0), 6) AS f_pvalue, n AS nobs FROM fs
"""

SQL["vif"] = """
WITH g AS (SELECT sum(l_quantity * l_quantity) AS a, sum(l_quantity * l_discount) AS b, sum(l_quantity * l_tax) AS c,
                  sum(l_discount * l_discount) AS d, sum(l_discount * l_tax) AS e, sum(l_tax * l_tax) AS f FROM lineitem),
det AS (SELECT *, a * (d * f - e * e) - b * (b * f - e * c) + c * (b * e - d * c) AS dt FROM g)
SELECT 'l_quantity' AS variable, round(a * (d * f - e * e) / dt, 6) AS vif FROM det
UNION ALL SELECT 'l_discount', round(d * (a * f - c * c) / dt, 6) FROM det
UNION ALL SELECT 'l_tax', round(f * (a * d - b * b) / dt, 6) FROM det
"""



# ---------------------------------------------------------------- stage compositions

_DATED = """d AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS tp, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+00:00') AS fa FROM orders)"""
_FA = """COALESCE(strftime(try_strptime(fa, '%Y-%m-%dT%H:%M:%S%z'), '%Y-%m-%d'),
         strftime(TRY_CAST(fa AS TIMESTAMP), '%Y-%m-%d'), fa)"""

SQL["date_columns_standardize"] = ("WITH " + _DATED + "\nSELECT o_orderkey, " + _STD.format(x="trim(tp)")
                                   + " AS TIME_PERIOD, o_totalprice, " + _FA + " AS fetched_at_utc FROM d")

SQL["date_harmonize"] = ("WITH " + _DATED + "\nSELECT " + _STD.format(x="trim(tp)")
                         + " AS date, o_orderkey, o_totalprice, " + _FA + " AS fetched_date FROM d")

_MERGED = """u AS (
  SELECT lang, source, NULL AS o_orderstatus, NULL AS o_orderpriority, NULL AS event_type, CAST(NULL AS BIGINT) AS event_value FROM documents
  UNION ALL SELECT NULL, NULL, o_orderstatus, o_orderpriority, NULL, NULL FROM orders
  UNION ALL SELECT NULL, NULL, NULL, NULL, CASE WHEN event_type IN ('click', 'purchase') THEN event_type END,
                   CASE WHEN event_type IN ('click', 'purchase') THEN CAST(floor(value) AS BIGINT) END FROM events),
k AS (SELECT * FROM u WHERE coalesce(lang, source, o_orderstatus, o_orderpriority, event_type, CAST(event_value AS VARCHAR)) IS NOT NULL)"""
SQL["final_panel_merge"] = "WITH " + _MERGED + "\nSELECT DISTINCT * FROM k"
SQL["final_panel_audit"] = "WITH " + _MERGED + """,
c AS (SELECT (SELECT count(*) FROM u) AS n, (SELECT count(*) FROM k) AS kept, (SELECT count(*) FROM (SELECT DISTINCT * FROM k)) AS rows_out)
SELECT n AS rows_in, n - kept AS dropped_all_null_rows, 'obs_status' AS empty_columns, kept - rows_out AS duplicates_removed, rows_out FROM c
"""

SQL["csv_typed"] = """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 10 <> 3 THEN round(o_totalprice, 6) END AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       'says "' || o_orderpriority || '", often' AS o_note, CAST(NULL AS INTEGER) AS o_closed FROM orders
"""
SQL["csv_lenient"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 10 > 1
"""
SQL["csv_rejects"] = """
SELECT count(*) AS rows_read, count(*) FILTER (WHERE o_orderkey % 10 <= 1) AS rows_rejected, count(*) FILTER (WHERE o_orderkey % 10 > 1) AS rows_delivered
FROM orders
"""
SQL["provenance_scan"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS VARCHAR) AS "SOURCE_FILE_YEAR",
       'orders_yearly' AS "SOURCE_GROUP" FROM orders
"""


def _audit_line(name: str, table: str, required: list[str], values: list[str], groups: list[str]) -> str:
    ok = " AND ".join(f"{c} IS NOT NULL" for c in required)
    by = f"PARTITION BY {', '.join(groups)}" if groups else ""
    inside = " AND ".join(_inside(v, f"q_{v}") for v in values)
    quartiles = ", ".join(f"quantile_cont({v}, [0.25, 0.75]) OVER ({by}) AS q_{v}" for v in values)
    listed = lambda xs: ",".join(xs)
    return f"""SELECT '{name}.csv' AS source_name, (SELECT count(*) FROM {table}) AS rows_in, count(*) AS rows_after_required,
       count(*) FILTER (WHERE {inside}) AS rows_after_outliers, (SELECT count(*) FROM {table}) - count(*) AS dropped_missing_required,
       count(*) - count(*) FILTER (WHERE {inside}) AS dropped_outliers, '{listed(required)}' AS required_fields,
       '{listed(values)}' AS outlier_columns, '{listed(groups)}' AS group_columns
FROM (SELECT *, {quartiles} FROM {table} WHERE {ok})"""


SQL["stage_audit"] = "WITH " + _MS + """,
macro AS (SELECT month AS date, CASE WHEN month(month) <> 5 THEN revenue END AS cpi_all_items, discount AS policy_rate, quantity AS industrial_production FROM ms),
world AS (SELECT l_returnflag AS REF_AREA, strftime(l_shipdate, '%Y-%m') AS TIME_PERIOD, l_linestatus AS ENERGY_PRODUCT, l_linenumber AS FLOW_BREAKDOWN,
                 'KTOE' AS UNIT_MEASURE, CASE WHEN l_quantity > 2 THEN pow(l_quantity, 6) END AS OBS_VALUE FROM lineitem),
wdi AS (SELECT event_type AS indicator_id, user_id AS country_iso3, year(ts) AS year, value FROM events)
""" + "\nUNION ALL ".join([
    _audit_line("fred_macro_raw", "macro", ["date", "cpi_all_items", "policy_rate", "industrial_production"],
                ["cpi_all_items", "policy_rate", "industrial_production"], []),
    _audit_line("staging_world_newformat", "world", ["REF_AREA", "TIME_PERIOD", "ENERGY_PRODUCT", "FLOW_BREAKDOWN", "UNIT_MEASURE", "OBS_VALUE"],
                ["OBS_VALUE"], ["ENERGY_PRODUCT", "FLOW_BREAKDOWN", "UNIT_MEASURE"]),
    _audit_line("world_bank_wdi_raw", "wdi", ["indicator_id", "country_iso3", "year", "value"], ["value"], ["indicator_id"])])

def _fingerprint_sql(name: str, table: str, cols: str, fields: list[str]) -> str:
    row = " || '|' || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in fields)
    total = [f"CAST(sum(CAST('0x' || substr(d, {a}, 15) AS HUGEINT)) AS VARCHAR)" for a in (1, 17)]
    return (f"SELECT '{name}' AS dataset, '{cols}' AS columns, CAST(count(*) AS BIGINT) AS rows, {total[0]} || ':' || {total[1]} AS fingerprint "
            f"FROM (SELECT md5({row}) AS d FROM {table}) GROUP BY ALL")


SQL["dataset_fingerprint"] = "\nUNION ALL\n".join(
    _fingerprint_sql(t, t, k, c) for t, all_, key in (("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"], "o_orderkey"),
                                                      ("documents", ["doc_id", "text", "lang", "source"], "doc_id"))
    for k, c in (("all", all_), ("key", [key])))

SQL["dictionary_datasets"] = """
SELECT 'customer' AS dataset, 'JODI' AS source, count(*) AS rows_total FROM customer
UNION ALL SELECT 'part', 'JODI', count(*) FROM part
UNION ALL SELECT 'supplier', 'JODI', count(*) FROM supplier
ORDER BY dataset
"""

SQL["distinct_keys"] = "SELECT DISTINCT event_type FROM events ORDER BY event_type"

SQL["energy_block"] = """
SELECT strftime(ts, '%Y-%m') AS time_period, CAST(user_id AS VARCHAR) AS ref_area, event_type AS flow_breakdown,
       value AS obs_value, 'units' AS unit_measure, CAST(try_strptime(strftime(ts, '%Y-%m'), '%Y-%m') AS DATE) AS time
FROM events WHERE value IS NOT NULL
"""

SQL["macro_block"] = """
SELECT CAST(o_orderdate AS DATE) AS date, round(o_totalprice / 1000, 6) AS cpi_all_items,
       round(CAST(length(o_orderpriority) AS DOUBLE), 6) AS policy_rate,
       round(CAST(o_custkey AS DOUBLE), 6) AS industrial_production
FROM orders WHERE o_orderstatus <> 'F'
"""



_NMF = _ON + """,
nm0 AS (SELECT nation, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, sum(o_totalprice) / 1e6 AS y,
               CAST(count(*) AS DOUBLE) / 100 AS x1, CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) / 100 AS x2
        FROM on_ GROUP BY ALL),
cal AS (SELECT CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM nm0),
grid AS (SELECT n.nation, cal.month FROM (SELECT DISTINCT nation FROM nm0) n, cal),
fe_in AS (SELECT g.nation, g.month, coalesce(nm0.y, 0.0) AS y, coalesce(nm0.x1, 0.0) AS x1, coalesce(nm0.x2, 0.0) AS x2
          FROM grid g LEFT JOIN nm0 USING (nation, month))"""

SQL["fe_two_way_monthly"] = ("WITH " + _fe2(_NMF, "y", "x1", "x2", "nation", "month", True)
                             + _cluster("CAST(r.n AS DOUBLE) / (r.n - 2 - (r.ne + r.nt - 1))") + """
SELECT 'x1' AS variable, round(b1, 6) AS coef, round(se1, 6) AS se, n AS nobs, round(r2w, 6) AS r2_within FROM se
UNION ALL SELECT 'x2', round(b2, 6), round(se2, 6), n, round(r2w, 6) FROM se
""")


SQL["iqr_fence_skewsafe"] = SQL["iqr_fence_grouped"]



# ---------------------------------------------------------------- Q-Q table

def _horner(coefs, x: str) -> str:
    acc = repr(coefs[0])
    for c in coefs[1:]:
        acc = f"({acc} * {x} + {c!r})"
    return acc


def _ppf_sql(p: str) -> str:
    from panelforge.plans.regression import _PPF_A, _PPF_B, _PPF_C, _PPF_D, _PPF_LOW
    q, r = f"({p} - 0.5)", f"(({p} - 0.5) * ({p} - 0.5))"
    ql, qu = f"sqrt(-2.0 * ln({p}))", f"sqrt(-2.0 * ln(1.0 - {p}))"
    central = f"{q} * {_horner(_PPF_A, r)} / ({_horner(_PPF_B, r)} * {r} + 1.0)"
    lower = f"{_horner(_PPF_C, ql)} / ({_horner(_PPF_D, ql)} * {ql} + 1.0)"
    upper = f"-{_horner(_PPF_C, qu)} / ({_horner(_PPF_D, qu)} * {qu} + 1.0)"
    return (f"CASE WHEN {p} < {_PPF_LOW!r} THEN {lower} WHEN {p} > {1 - _PPF_LOW!r} THEN {upper} "
            f"ELSE {central} END")


_QQ_POINTS = """,
rk AS (SELECT y - fitted AS osr, row_number() OVER (ORDER BY y - fitted) AS i, count(*) OVER () AS n FROM fit),
pm AS (SELECT i, osr, CASE WHEN i = n THEN pow(0.5, 1.0 / n) WHEN i = 1 THEN 1.0 - pow(0.5, 1.0 / n)
                      ELSE (i - 0.3175) / (n + 0.365) END AS m FROM rk),
qq AS (SELECT i, """ + _ppf_sql("m") + """ AS osm, osr FROM pm)"""

_QQ = "WITH " + _LI + _QQ_POINTS

_FE_RESID = "WITH " + _fe2(_FE_IN, "y", "x1", "x2", "nation", "yr", True) + """,
fit AS (SELECT nation, yr, b1 * x1 + b2 * x2 AS without_effects, yd AS y, b1 * x1d + b2 * x2d AS fitted
        FROM fe_in JOIN d ON ent = nation AND tim = yr, b)"""
SQL["fe_residuals"] = _FE_RESID + """
SELECT nation, yr, round(without_effects, 6) AS fitted, round(y - fit.fitted, 6) AS resid FROM fit
"""
SQL["fe_qq"] = _FE_RESID + _QQ_POINTS + "\nSELECT i, round(osm, 6) AS osm, round(osr, 6) AS osr FROM qq"

SQL["qq_table"] = _QQ + "\nSELECT i, round(osm, 6) AS osm, round(osr, 6) AS osr FROM qq"
SQL["qq_fit"] = _QQ + """
SELECT round(regr_slope(osr, osm), 6) AS slope, round(regr_intercept(osr, osm), 6) AS intercept,
       round(corr(osm, osr), 6) AS r FROM qq
"""


SQL["json_pages"] = """
SELECT CAST(user_id AS VARCHAR) AS country_iso3, event_type AS country_name, strftime(ts, '%Y') AS year,
       value, '' AS obs_status, '' AS decimal, '2024-01-01T00:00:00+00:00' AS fetched_at_utc
FROM events
"""


SQL["eda_summary"] = _LAGCORR + """,
c0 AS (SELECT """ + _corr("revenue", "discount") + """ AS c FROM ms),
best AS (SELECT lag, corr FROM prof WHERE corr IS NOT NULL ORDER BY abs(corr) DESC, lag LIMIT 1),
top AS (SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY ALL
        ORDER BY n DESC, event_type LIMIT 4),
e AS (SELECT user_id, CAST(ts AS DATE) AS day, value FROM events WHERE event_type = 'error'),
k AS (SELECT user_id, CAST(ts AS DATE) AS day, value FROM events WHERE event_type = 'click'),
g AS (SELECT e.user_id, """ + _corr("e.value", "k.value") + """ AS c FROM e JOIN k USING (user_id, day) GROUP BY e.user_id)
SELECT 'corr_revenue_discount' AS metric, printf('%.6f', round((SELECT c FROM c0), 6)) AS value
UNION ALL SELECT 'best_lag', CAST((SELECT lag FROM best) AS VARCHAR)
UNION ALL SELECT 'best_lag_abs_corr', printf('%.6f', round(abs((SELECT corr FROM best)), 6))
UNION ALL SELECT 'top_flows', (SELECT string_agg(event_type, ', ' ORDER BY n DESC, event_type) FROM top)
UNION ALL SELECT 'group_corr_count', CAST((SELECT count(*) FROM g WHERE c IS NOT NULL AND NOT isnan(c)) AS VARCHAR)
UNION ALL SELECT 'macro_rows', CAST((SELECT count(*) FROM ms) AS VARCHAR)
UNION ALL SELECT 'energy_rows', CAST((SELECT count(*) FROM events WHERE value IS NOT NULL) AS VARCHAR)
"""



# ---------------------------------------------------------------- k-regressor fits (balanced panel)

def _det(m: list[list[str]]) -> str:
    if len(m) == 1:
        return m[0][0]
    terms = []
    for j in range(len(m)):
        minor = [row[:j] + row[j + 1:] for row in m[1:]]
        sign = "+" if j % 2 == 0 else "-"
        terms.append(f"{sign} {m[0][j]} * ({_det(minor)})")
    return "(" + " ".join(terms) + ")"


def _fek_sql(base: str, y: str, xs: list[str], ent: str, tim: str, scale: str, pre: str = "",
             src: str = "fe_in") -> str:
    """CTEs for a two-way FE fit with k regressors on a balanced panel (CTE
    ``src``): two-way demeaning, moments, inverse by cofactors, coefficients,
    cluster scores by entity, sandwich with ``scale``.  Leaves CTE
    ``{pre}fit_out`` with b{j}, se{j}, n; ``pre`` keeps several fits apart."""
    k = len(xs)
    dm = lambda c: (f"{c} - avg({c}) OVER (PARTITION BY {ent}) - avg({c}) OVER (PARTITION BY {tim}) "  # noqa: E731
                    f"+ avg({c}) OVER ()")
    cols = ", ".join([f"{ent} AS ent", f"{tim} AS tim", f"{dm(y)} AS yd"] + [f"{dm(x)} AS x{j}d" for j, x in enumerate(xs)])
    mom = ", ".join(["count(*) AS n", "count(DISTINCT ent) AS ne", "count(DISTINCT tim) AS nt"]
                    + [f"sum(x{i}d * x{j}d) AS s{i}_{j}" for i in range(k) for j in range(k)]
                    + [f"sum(x{i}d * yd) AS sy{i}" for i in range(k)])
    m = [[f"s{i}_{j}" for j in range(k)] for i in range(k)]
    det = _det(m)
    inv = []
    for i in range(k):
        for j in range(k):
            minor = [row[:i] + row[i + 1:] for r_, row in enumerate(m) if r_ != j]
            sign = "" if (i + j) % 2 == 0 else "-"
            inv.append(f"{sign}({_det(minor)}) / dt AS i{i}_{j}")
    beta = ", ".join(" + ".join(f"i{i}_{j} * sy{j}" for j in range(k)) + f" AS b{i}" for i in range(k))
    resid = "d.yd - " + " - ".join(f"v.b{j} * d.x{j}d" for j in range(k))
    scores = ", ".join(f"sum(d.x{j}d * ({resid})) AS g{j}" for j in range(k))
    meat = ", ".join(f"sum(g{a} * g{b}) AS m{a}_{b}" for a in range(k) for b in range(k))
    var = ", ".join("sqrt(c * (" + " + ".join(f"i{j}_{a} * m{a}_{b} * i{b}_{j}" for a in range(k) for b in range(k))
                    + f")) AS se{j}" for j in range(k))
    p = pre
    return base + f""",
{p}d AS (SELECT {cols} FROM {src}),
{p}s AS (SELECT {mom} FROM {p}d),
{p}dtab AS (SELECT *, {det} AS dt FROM {p}s),
{p}inv AS (SELECT *, {", ".join(inv)} FROM {p}dtab),
{p}v AS (SELECT *, {beta} FROM {p}inv),
{p}sc AS (SELECT d.ent, {scores} FROM {p}d d, {p}v v GROUP BY d.ent),
{p}mt AS (SELECT {meat}, count(*) AS g FROM {p}sc),
{p}vc AS (SELECT v.*, mt.*, {scale} AS c FROM {p}v v, {p}mt mt),
{p}fit_out AS (SELECT *, {var} FROM {p}vc)"""


_A_REGS = ["gas_import_shock_lag1", "shock_x_highdep_lag1", "gdp_growth", "imports_gdp"]
_B_REGS = ["did_interaction", "high_energy_dependence", "post_treatment", "gas_import_shock_lag1",
           "gdp_growth", "imports_gdp"]


def _model_sql(regs_fit: list[str], regs_all: list[str], cc_cols: list[str], scale: str) -> str:
    base = ("WITH " + _PANEL + ",\nfe_in AS (SELECT * FROM panel2 WHERE "
            + " AND ".join(f"{c} IS NOT NULL" for c in cc_cols) + ")")
    sql = _fek_sql(base, "inflation", regs_fit, "nation_name", "year", scale)
    parts = []
    for v in regs_all:
        if v in regs_fit:
            j = regs_fit.index(v)
            parts.append(f"SELECT '{v}' AS variable, round(b{j}, 6) AS coef, round(se{j}, 6) AS se, "
                         f"round(b{j} / se{j}, 6) AS t, n AS nobs FROM fit_out")
        else:
            parts.append(f"SELECT '{v}', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), n FROM fit_out")
    return sql + "\n" + "\nUNION ALL ".join(parts)


SQL["model_a_fit"] = _model_sql(
    _A_REGS, _A_REGS, ["nation_name", "year", "inflation"] + _A_REGS + ["energy_import_share", "high_energy_dependence"],
    "CAST(n AS DOUBLE) / (n - 4 - (ne + nt - 1))")
SQL["model_b_fit"] = _model_sql(
    ["did_interaction", "gas_import_shock_lag1", "gdp_growth", "imports_gdp"], _B_REGS,
    ["nation_name", "year", "inflation"] + _B_REGS,
    "(CAST(g AS DOUBLE) / (g - 1)) * (CAST(n AS DOUBLE) - 1) / (n - (1 + (ne - 1) + (nt - 1) + 6))")



def _inv_exprs(sym: str, k: int, det_name: str, out: str) -> tuple[str, list[str]]:
    """(determinant, inverse entries) of the symmetric k x k matrix whose
    entries are columns ``{sym}{i}_{j}``, by cofactors."""
    m = [[f"{sym}{min(i, j)}_{max(i, j)}" for j in range(k)] for i in range(k)]
    inv = []
    for i in range(k):
        for j in range(k):
            minor = [row[:i] + row[i + 1:] for r_, row in enumerate(m) if r_ != j]
            sign = "" if (i + j) % 2 == 0 else "-"
            inv.append(f"{sign}({_det(minor)}) / {det_name} AS {out}{i}_{j}")
    return _det(m), inv


def _notes_ctes() -> str:
    k = 4
    xs = _A_REGS
    cc = ["nation_name", "year", "inflation"] + _A_REGS + ["energy_import_share", "high_energy_dependence"]
    base = "WITH " + _PANEL + ",\nfe_in AS (SELECT * FROM panel2 WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in cc) + ")"
    a = _fek_sql(base, "inflation", xs, "nation_name", "year", "CAST(n AS DOUBLE) / (n - 4 - (ne + nt - 1))")
    # within R2: entity-demeaned moments with the two-way coefficients
    ed = lambda c: f"{c} - avg({c}) OVER (PARTITION BY nation_name)"
    ecols = ", ".join([f"{ed('inflation')} AS ye"] + [f"{ed(x)} AS e{j}" for j, x in enumerate(xs)])
    emom = ", ".join(["sum(ye * ye) AS eyy"] + [f"sum(e{j} * ye) AS ey{j}" for j in range(k)]
                     + [f"sum(e{i} * e{j}) AS ee{i}_{j}" for i in range(k) for j in range(k)])
    ssr_w = ("eyy - 2 * (" + " + ".join(f"b{j} * ey{j}" for j in range(k)) + ") + "
             + " + ".join(f"b{i} * b{j} * ee{i}_{j}" for i in range(k) for j in range(k)))
    # Breusch-Pagan on the same sample: centred OLS with intercept, then e^2 on [1, X]
    cx = ", ".join(["inflation - avg(inflation) OVER () AS cy"] + [f"{x} - avg({x}) OVER () AS c{j}" for j, x in enumerate(xs)])
    cmom = ", ".join([f"sum(c{i} * c{j}) AS p{i}_{j}" for i in range(k) for j in range(i, k)]
                     + [f"sum(c{j} * cy) AS py{j}" for j in range(k)])
    pdet, pinv = _inv_exprs("p", k, "pdt", "q")
    pbeta = ", ".join(" + ".join(f"q{i}_{j} * py{j}" for j in range(k)) + f" AS pb{i}" for i in range(k))
    uexpr = "(cy - " + " - ".join(f"pb{j} * c{j}" for j in range(k)) + ")"
    # VIF: uncentred Gram of the regressors, vif_j = G_jj * inv(G)_jj
    gmom = ", ".join(f"sum({xs[i]} * {xs[j]}) AS g{i}_{j}" for i in range(k) for j in range(i, k))
    gdet, ginv = _inv_exprs("g", k, "gdt", "h")
    vifs = ", ".join(f"g{j}_{j} * h{j}_{j}" for j in range(k))
    # Model B R2: residual SS of the identified DiD regressors / centred total SS
    b_fit = ["did_interaction", "gas_import_shock_lag1", "gdp_growth", "imports_gdp"]
    bcc = ["nation_name", "year", "inflation"] + _B_REGS
    return a + f""",
ew AS (SELECT {ecols} FROM fe_in),
em AS (SELECT {emom} FROM ew),
r2a AS (SELECT n AS na, 1 - ({ssr_w}) / eyy AS r2w FROM fit_out, em),
cw AS (SELECT {cx} FROM fe_in),
cm AS (SELECT {cmom} FROM cw),
cd AS (SELECT *, {pdet} AS pdt FROM cm),
ci AS (SELECT *, {", ".join(pinv)} FROM cd),
cb AS (SELECT *, {pbeta} FROM ci),
uu AS (SELECT cw.*, {uexpr} * {uexpr} AS u FROM cw, cb),
um AS (SELECT u - avg(u) OVER () AS uc, {", ".join(f"c{j}" for j in range(k))} FROM uu),
ua AS (SELECT count(*) AS nu, sum(uc * uc) AS suu, {", ".join(f"sum(c{j} * uc) AS pu{j}" for j in range(k))} FROM um),
bp AS (SELECT nu * ({" + ".join(f"({' + '.join(f'q{i}_{j} * pu{j}' for j in range(k))}) * pu{i}" for i in range(k))}) / suu AS lm
       FROM ua, cb),
gm AS (SELECT {gmom} FROM fe_in),
gd AS (SELECT *, {gdet} AS gdt FROM gm),
gi AS (SELECT *, {", ".join(ginv)} FROM gd),
vf AS (SELECT greatest({vifs}) AS max_vif FROM gi),
b_in AS (SELECT * FROM panel2 WHERE {" AND ".join(f"{c} IS NOT NULL" for c in bcc)}),
b2 AS (SELECT {", ".join([f"{c} - avg({c}) OVER (PARTITION BY nation_name) - avg({c}) OVER (PARTITION BY year) + avg({c}) OVER () AS {c}"
                          for c in ["inflation"] + b_fit])}, inflation - avg(inflation) OVER () AS yc FROM b_in),
bmom AS (SELECT count(*) AS nb, sum(inflation * inflation) AS syy, sum(yc * yc) AS tss,
         {", ".join([f"sum({b_fit[i]} * {b_fit[j]}) AS z{i}_{j}" for i in range(k) for j in range(i, k)]
                    + [f"sum({b_fit[j]} * inflation) AS zy{j}" for j in range(k)])} FROM b2),
bdet AS (SELECT *, {_inv_exprs("z", k, "zdt", "w")[0]} AS zdt FROM bmom),
binv AS (SELECT *, {", ".join(_inv_exprs("z", k, "zdt", "w")[1])} FROM bdet),
r2b AS (SELECT nb, 1 - (syy - ({" + ".join(f"({' + '.join(f'w{i}_{j} * zy{j}' for j in range(k))}) * zy{i}" for i in range(k))})) / tss AS r2 FROM binv)"""


def _notes_sql() -> str:
    return _notes_ctes() + """
SELECT 'Model A entity FE' AS metric, 'Yes' AS value
UNION ALL SELECT 'Model A time FE', 'Yes'
UNION ALL SELECT 'Model A clustered SE', 'Yes (entity)'
UNION ALL SELECT 'Model A observations', CAST((SELECT na FROM r2a) AS VARCHAR)
UNION ALL SELECT 'Model A R2 within', printf('%.6f', round((SELECT r2w FROM r2a), 6))
UNION ALL SELECT 'Model B country FE', 'Yes'
UNION ALL SELECT 'Model B year FE', 'Yes'
UNION ALL SELECT 'Model B clustered SE', 'Yes (country)'
UNION ALL SELECT 'Model B observations', CAST((SELECT nb FROM r2b) AS VARCHAR)
UNION ALL SELECT 'Model B R2', printf('%.6f', round((SELECT r2 FROM r2b), 6))
UNION ALL SELECT 'BP p-value', printf('%.6f', round((SELECT exp(-lm / 2) * (1 + lm / 2) FROM bp), 6))
UNION ALL SELECT 'Max VIF', printf('%.6f', round((SELECT max_vif FROM vf), 6))
"""


SQL["model_notes"] = _notes_sql()



def _robustness_sql() -> str:
    panel_scale = "CAST(n AS DOUBLE) / (n - {k} - (ne + nt - 1))"
    lag_cols = lambda lag: ["nation_name", "year", "inflation", f"gas_import_shock_lag{lag}",
                            f"shock_x_highdep_lag{lag}", "gdp_growth", "imports_gdp", "energy_import_share",
                            "high_energy_dependence"]
    regs = lambda lag: [f"gas_import_shock_lag{lag}", f"shock_x_highdep_lag{lag}", "gdp_growth", "imports_gdp"]
    sub = ["gas_import_shock_lag1", "gdp_growth", "imports_gdp"]
    specs = [  # (check, variable, prefix, sample filter, columns required, regressors, scale)
        ("Alternative lag 2", "gas_import_shock_lag2", "r1", "TRUE", lag_cols(2), regs(2), panel_scale.format(k=4)),
        ("Alternative lag 3", "gas_import_shock_lag3", "r2", "TRUE", lag_cols(3), regs(3), panel_scale.format(k=4)),
        ("Exclude year 1999", "gas_import_shock_lag1", "r3", "year <> 1999", lag_cols(1), regs(1), panel_scale.format(k=4)),
        ("Subsample high dependence", "gas_import_shock_lag1", "r4", "high_energy_dependence = 1", lag_cols(1), sub,
         panel_scale.format(k=3)),
        ("Subsample low dependence", "gas_import_shock_lag1", "r5", "high_energy_dependence = 0", lag_cols(1), sub,
         panel_scale.format(k=3)),
    ]
    sql = "WITH " + _PANEL
    selects = []
    for check, var, pre, where, cc, xs, scale in specs:
        sql += (f",\n{pre}in AS (SELECT * FROM panel2 WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in cc)
                + f" AND {where})")
        sql = _fek_sql(sql, "inflation", xs, "nation_name", "year", scale, pre=pre, src=f"{pre}in")
        j = xs.index(var)
        selects.append(f"SELECT '{check}' AS check, '{var}' AS variable, round(b{j}, 6) AS coef, "
                       f"round(se{j}, 6) AS se, n AS nobs FROM {pre}fit_out")
    pcols = ["nation_name", "year", "inflation", "high_energy_dependence", "gas_import_shock_lag1",
             "gdp_growth", "imports_gdp"]
    sql += (",\nr6in AS (SELECT *, high_energy_dependence * CASE WHEN year >= 1999 THEN 1.0 ELSE 0.0 END "
            "AS placebo_interaction FROM panel2 WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in pcols)
            + " AND year < 2000)")
    sql = _fek_sql(sql, "inflation", ["placebo_interaction", "gas_import_shock_lag1", "gdp_growth", "imports_gdp"],
                   "nation_name", "year",
                   "(CAST(g AS DOUBLE) / (g - 1)) * (CAST(n AS DOUBLE) - 1) / (n - (1 + (ne - 1) + (nt - 1) + 6))",
                   pre="r6", src="r6in")
    selects.append("SELECT 'Placebo DiD pre-treatment', 'placebo_interaction', round(b0, 6), round(se0, 6), n "
                   "FROM r6fit_out")
    return sql + "\n" + "\nUNION ALL ".join(selects)


SQL["robustness_coefs"] = _robustness_sql()

# ---------------------------------------------------------------- p-values and the tables that show them

# Tails by Simpson's rule over 2000 strips, independently of the continued fractions in the library: Student's t as the
# integral of cos^(df - 1) up to atan(|t| / sqrt(df)), the normal one of its density up to 12.
_STRIPS = "range(0, 2001) strips(i)"
_WEIGHT = "(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) / 6000.0"


def _t_tail(t: str, df: str) -> str:
    top = f"atan(abs({t}) / sqrt({df}))"
    return (f"1 - 2 * exp(lgamma(({df} + 1) / 2.0) - lgamma({df} / 2.0)) / sqrt(pi()) * {top} * "
            f"sum({_WEIGHT} * pow(cos({top} * i / 2000.0), {df} - 1))")


def _normal_tail(z: str) -> str:
    top = f"least(abs({z}), 12)"
    return f"1 - 2 / sqrt(2 * pi()) * {top} * sum({_WEIGHT} * exp(-pow({top} * i / 2000.0, 2) / 2))"


def _tail_ctes(fits: list[tuple[str, str, int, int, str]]) -> str:
    """CTE ``{name}`` (coef, se, t, p, n) of regressor j in ``fit`` of k regressors, for each (name, fit, j, k, distribution)."""
    out = ""
    for name, fit, j, k, dist in fits:
        tail = _normal_tail("tt") if dist == "normal" else _t_tail("tt", "df")
        out += (f",\n{name}_in AS (SELECT b{j} AS coef, se{j} AS se, b{j} / se{j} AS tt, CAST(n - {k} - (ne + nt - 1) AS DOUBLE) AS df, n FROM {fit}),\n"
                f"{name} AS (SELECT coef, se, tt AS t, {tail} AS p, n FROM {name}_in, {_STRIPS} GROUP BY coef, se, tt, df, n)")
    return out


_B_FIT = ["did_interaction", "gas_import_shock_lag1", "gdp_growth", "imports_gdp"]


def _both_models(ctes: str) -> str:
    """``ctes`` with model A as ``fit_out``, then model B as ``mbfit_out`` and the coefficients of both (ca.., cb..)."""
    ctes += ",\nmb_in AS (SELECT * FROM panel2 WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in ["nation_name", "year", "inflation"] + _B_REGS) + ")"
    ctes = _fek_sql(ctes, "inflation", _B_FIT, "nation_name", "year",
                    "(CAST(g AS DOUBLE) / (g - 1)) * (CAST(n AS DOUBLE) - 1) / (n - (1 + (ne - 1) + (nt - 1) + 6))", pre="mb", src="mb_in")
    ctes += _tail_ctes([(f"ca{j}", "fit_out", j, 4, "t") for j in range(4)] + [(f"cb{j}", "mbfit_out", j, 4, "normal") for j in range(4)])
    for m, names, cte in (("ta", _A_REGS, "ca"), ("tb", _B_FIT, "cb")):
        ctes += f",\n{m} AS (" + " UNION ALL ".join(f"SELECT '{v}' AS variable, coef, se, t, p FROM {cte}{j}" for j, v in enumerate(names))
        ctes += "".join(f" UNION ALL SELECT '{v}', NULL, NULL, NULL, NULL" for v in (_B_REGS if m == "tb" else []) if v not in names) + ")"
    return ctes


_MARKED = ("coalesce(printf('%.4f', {0}.coef) || CASE WHEN {0}.p < 0.01 THEN '***' WHEN {0}.p < 0.05 THEN '**' "
           "WHEN {0}.p < 0.1 THEN '*' ELSE '' END, '')")


def _table_sql() -> str:
    cols = ", ".join(f"round({m}.{c}, 6) AS {c}_{name}" for m, name in (("ta", "model_a"), ("tb", "model_b")) for c in ("coef", "se", "t", "p"))
    marks = ", ".join(f"CASE WHEN {m}.variable IS NOT NULL THEN {_MARKED.format(m)} END AS coef_{name}_fmt" for m, name in (("ta", "model_a"), ("tb", "model_b")))
    return (_both_models(_notes_ctes())
            + f"\nSELECT coalesce(ta.variable, tb.variable) AS variable, {cols}, {marks} FROM ta FULL JOIN tb ON ta.variable = tb.variable")


SQL["regression_table"] = _table_sql()


def _publication_sql() -> str:
    terms = [("gas_import_shock_lag1", "Gas import shock (t-1)"), ("shock_x_highdep_lag1", "Shock x high energy dependence"),
             ("did_interaction", "High dependence x Post-2022"), ("high_energy_dependence", "High energy dependence"),
             ("post_treatment", "Post-treatment"), ("gdp_growth", "GDP growth"), ("imports_gdp", "Imports (% GDP)")]
    listed = ", ".join(f"({2 * i}, '{v}', '{label}')" for i, (v, label) in enumerate(terms))
    spread = "coalesce('(' || printf('%.4f', {0}.se) || ')', '')"
    return _both_models(_notes_ctes()) + f""",
listed(place, variable, label) AS (VALUES {listed}),
body AS (SELECT place, label, {_MARKED.format("ta")} AS a, {_MARKED.format("tb")} AS b, {spread.format("ta")} AS sa, {spread.format("tb")} AS sb
         FROM listed LEFT JOIN ta USING (variable) LEFT JOIN tb USING (variable))
SELECT place AS row_order, label AS term, a AS model_fe, b AS model_did FROM body
UNION ALL SELECT place + 1, '', sa, sb FROM body
UNION ALL SELECT 14, 'Country fixed effects', 'Yes', 'Yes'
UNION ALL SELECT 15, 'Year fixed effects', 'Yes', 'Yes'
UNION ALL SELECT 16, 'Clustered standard errors', 'Country', 'Country'
UNION ALL SELECT 17, 'Observations', CAST((SELECT na FROM r2a) AS VARCHAR), CAST((SELECT nb FROM r2b) AS VARCHAR)
UNION ALL SELECT 18, 'R-squared', printf('%.4f', (SELECT r2w FROM r2a)), printf('%.4f', (SELECT r2 FROM r2b))
"""


SQL["publication_rows"] = _publication_sql()


def _grid_sql() -> str:
    base, _, _ = _robustness_sql().rpartition("\nSELECT 'Alternative lag 2'")
    rows = [("Alternative lag 2", "gas_import_shock_lag2", "r1", 4, "t"), ("Alternative lag 3", "gas_import_shock_lag3", "r2", 4, "t"),
            ("Exclude year 1999", "gas_import_shock_lag1", "r3", 4, "t"), ("Subsample high dependence", "gas_import_shock_lag1", "r4", 3, "t"),
            ("Subsample low dependence", "gas_import_shock_lag1", "r5", 3, "t"), ("Placebo DiD pre-treatment", "placebo_interaction", "r6", 4, "normal")]
    base += _tail_ctes([(f"{pre}p", f"{pre}fit_out", 0, k, dist) for _, _, pre, k, dist in rows])
    return base + "\n" + "\nUNION ALL ".join(
        f"SELECT '{check}' AS check, '{v}' AS variable, round(coef, 6) AS coef, round(p, 6) AS p_value, CAST(n AS DOUBLE) AS nobs FROM {pre}p" for check, v, pre, _, _ in rows)


SQL["robustness_grid"] = _grid_sql()


SQL = {k: _r6_text(v) for k, v in SQL.items()}
