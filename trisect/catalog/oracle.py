"""The same results as the catalog queries, as SQL for an independent engine."""

from __future__ import annotations

import math
from collections.abc import Sequence

from trisect.operators.joint_drift import fourier_features

ORACLE: dict[str, str] = {}

LINE_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
PRICES = ("l_quantity", "l_extendedprice", "l_discount")
DEFAULT_CUT = "TIMESTAMP '1999-01-01'"


def digits(expression: str, name: str) -> str:
    return f"CAST(printf('%.7e', CAST({expression} AS DOUBLE)) AS DOUBLE) AS {name}"


# Distinct entities

ORACLE["monthly_distinct"] = """
SELECT date_trunc('month', o_orderdate) AS month,
       count(DISTINCT row(o_custkey, o_orderpriority)) AS distinct_entities
FROM orders GROUP BY 1 ORDER BY 1"""

ORACLE["monthly_distinct_range"] = """
SELECT date_trunc('month', o_orderdate) AS month,
       count(DISTINCT row(o_custkey, o_orderpriority)) AS distinct_entities
FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1997-03-15' AND TIMESTAMP '1999-06-30'
GROUP BY 1 ORDER BY 1"""


# Splits


def tie(columns: Sequence[str]) -> str:
    """The row hash: parts with their lengths, nulls as n, and the seed."""
    parts = [f"coalesce(length({c}::VARCHAR) || ':' || {c}::VARCHAR, 'n')" for c in columns]
    return f"md5({' || '.join([*parts, chr(39) + 'seed:42' + chr(39)])})"


def stratified(table: str, key: Sequence[str], strata: Sequence[str], by: Sequence[str], sizes, columns: str) -> str:
    """Quotas by largest remainder, then the hash order of each stratum."""
    train, test, backtest = sizes
    s, parts = ", ".join(strata), f"PARTITION BY {', '.join(by)}" if by else ""
    line_tie = tie(strata)

    def quota(source: str, count: str, share: float, name: str) -> str:
        return f"""
  (WITH d AS (SELECT *, sum({count}) OVER ({parts}) AS total,
                     ceil({share!r}::DOUBLE * sum({count}) OVER ({parts}))::HUGEINT AS draws FROM {source}),
        e AS (SELECT *, ({count} * draws) // greatest(total, 1) AS whole, ({count} * draws) % greatest(total, 1) AS rem FROM d),
        f AS (SELECT *, draws - sum(whole) OVER ({parts}) AS spare,
                     row_number() OVER ({parts} ORDER BY rem DESC, {line_tie}) AS line FROM e)
   SELECT * EXCLUDE (total, draws, whole, rem, spare, line), whole + (line <= spare)::INT AS {name} FROM f)"""

    return f"""
WITH strata AS (SELECT {s}, count(*) AS n FROM {table} GROUP BY {s}),
first AS {quota('strata', 'n', backtest, 'nb')},
rest AS (SELECT *, n - nb AS r FROM first),
second AS {quota('rest', 'r', test / (train + test), 'nt')},
ranked AS (SELECT *, row_number() OVER (PARTITION BY {s} ORDER BY {tie(key)}) AS place
           FROM {table}),
assigned AS (
  SELECT ranked.*, CASE WHEN place <= nb THEN 'backtest' WHEN place <= nb + nt THEN 'test' ELSE 'train' END AS subset
  FROM ranked JOIN second USING ({s}))
SELECT {columns} FROM assigned"""


SIZES = (0.6, 0.2, 0.2)
ORACLE["split_random_stratified"] = stratified(
    "orders", ["o_orderkey"], ["o_orderstatus", "o_orderpriority"], [], SIZES, "o_orderkey, subset"
)
ORACLE["split_random_within_group"] = stratified(
    "lineitem", LINE_KEY.split(", "), ["l_returnflag", "l_linestatus"], ["l_returnflag"], SIZES, f"{LINE_KEY}, subset"
)
ORACLE["split_sizes"] = stratified(
    "orders", ["o_orderkey"], ["o_orderstatus"], [], (0.7, 0.2, 0.1), "subset, o_orderstatus, count(*) AS n"
) + " GROUP BY subset, o_orderstatus"

ORACLE["split_random_hash"] = f"""
WITH h AS (SELECT o_orderkey, ('0x' || substr({tie(['o_orderkey'])}, 1, 8))::BIGINT AS place FROM orders)
SELECT o_orderkey, CASE WHEN place < 2576980377 THEN 'train' WHEN place < 3435973836 THEN 'test' ELSE 'backtest' END AS subset
FROM h"""


def chronological(table: str, time: str, key: Sequence[str], by: str, first: str, second: str) -> str:
    parts = f"PARTITION BY {by}" if by else ""
    return f"""
  SELECT *, CASE WHEN place <= floor({first} * n) THEN 'train' WHEN place <= floor(({second}) * n) THEN 'test'
                 ELSE 'backtest' END AS subset
  FROM (SELECT *, row_number() OVER ({parts} ORDER BY {time} NULLS LAST, {tie(key)}) AS place,
               count(*) OVER ({parts}) AS n FROM {table})"""


SEVENTY, NINETY = "0.7::DOUBLE", "0.7::DOUBLE + 0.2::DOUBLE"
ORACLE["split_time_fraction"] = (
    f"SELECT event_id, subset FROM ({chronological('events', 'ts', ['event_id'], '', SEVENTY, NINETY)})"
)
ORACLE["split_within_group"] = (
    f"SELECT {LINE_KEY}, subset FROM "
    f"({chronological('lineitem', 'l_shipdate', LINE_KEY.split(', '), 'l_returnflag', SEVENTY, NINETY)})"
)
ORACLE["split_blockwise"] = f"""
WITH blocks AS (SELECT *, (row_number() OVER (ORDER BY event_id) - 1) // 1000 AS block FROM events)
SELECT event_id, block, subset FROM ({chronological('blocks', 'ts', ['event_id'], 'block', SEVENTY, NINETY)})"""

CUTS = """CASE WHEN o_orderdate <= TIMESTAMP '1998-01-01' THEN 'train'
     WHEN o_orderdate <= TIMESTAMP '2000-01-01' THEN 'test' ELSE 'backtest' END"""
ORACLE["split_time_cut"] = f"SELECT o_orderkey, {CUTS} AS subset FROM orders"

ORACLE["split_metric"] = """
WITH q AS (SELECT quantile_cont(o_totalprice, 0.6) AS q1, quantile_cont(o_totalprice, 0.8) AS q2 FROM orders)
SELECT o_orderkey, CASE WHEN o_totalprice <= q1 THEN 'train' WHEN o_totalprice <= q2 THEN 'test' ELSE 'backtest' END AS subset
FROM orders, q"""
ORACLE["split_metric_within_group"] = """
WITH q AS (SELECT o_orderpriority, quantile_cont(o_totalprice, 0.6) AS q1, quantile_cont(o_totalprice, 0.8) AS q2
           FROM orders GROUP BY 1)
SELECT o_orderkey, CASE WHEN o_totalprice <= q1 THEN 'train' WHEN o_totalprice <= q2 THEN 'test' ELSE 'backtest' END AS subset
FROM orders JOIN q USING (o_orderpriority)"""


# Drift

DECILES = "[" + ", ".join(repr(i / 10) for i in range(11)) + "]"


def sides(table: str, columns: Sequence[str], is_ref: str) -> str:
    return " UNION ALL ".join(
        f"SELECT ({is_ref}) AS is_ref, '{c}' AS col, {c}::DOUBLE AS value FROM {table}" for c in columns
    )


def drift_ctes(source: str, open_ends: bool = False) -> str:
    """Common tables: v values, e edges, h bin counts, d divergences, k KS, m moments."""
    inside = "TRUE" if open_ends else "value BETWEEN e[1] AND e[11]"
    place = "len(list_filter(e[2:10], lambda z: z <= value))"
    return f"""v AS ({source}),
e AS (SELECT col, quantile_cont(value, {DECILES}) AS e FROM v WHERE is_ref GROUP BY col),
h AS (SELECT col, CASE WHEN {inside} THEN {place} END AS bin, count(*) FILTER (is_ref) AS n_ref,
             count(*) FILTER (NOT is_ref) AS n_cur
      FROM v JOIN e USING (col) GROUP BY 1, 2),
{divergence_ctes('h')},
c AS (SELECT col, value, count(*) FILTER (is_ref) AS a, count(*) FILTER (NOT is_ref) AS b FROM v GROUP BY 1, 2),
r AS (SELECT col, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER (PARTITION BY col) AS na,
             sum(b) OVER (PARTITION BY col) AS nb FROM c WINDOW w AS (PARTITION BY col ORDER BY value)),
k0 AS (SELECT col, max(abs(ca::DOUBLE / na - cb::DOUBLE / nb)) AS ks_stat, max(na)::BIGINT AS n_ref, max(nb)::BIGINT AS n_cur
       FROM r GROUP BY col),
k AS (SELECT *, 2 * list_sum(list_transform(range(1, 101), lambda i: (CASE WHEN i % 2 = 1 THEN 1.0 ELSE -1.0 END)::DOUBLE
             * exp(-2.0::DOUBLE * i * i * ks_stat * ks_stat * (n_ref::DOUBLE * n_cur / (n_ref + n_cur))))) AS ks_pvalue FROM k0),
m AS (SELECT col, avg(value) FILTER (is_ref) - avg(value) FILTER (NOT is_ref) AS mean_diff,
             var_samp(value) FILTER (is_ref) - var_samp(value) FILTER (NOT is_ref) AS var_diff FROM v GROUP BY col)"""


def divergence_ctes(counts: str, by: str = "col") -> str:
    """PSI and Jensen-Shannon from bin counts; a null bin holds the values outside the edges."""
    eps = lambda x: f"(CASE WHEN {x} = 0 THEN 1e-8::DOUBLE ELSE {x} END)"
    return f"""s0 AS (SELECT *, n_ref::DOUBLE / sum(n_ref) OVER (PARTITION BY {by}) AS p,
              n_cur::DOUBLE / sum(n_cur) OVER (PARTITION BY {by}) AS q FROM {counts}),
s1 AS (SELECT *, p / sum(p) OVER w AS p1, q / sum(q) OVER w AS q1, (p + q) / sum(p + q) OVER w AS m1
       FROM s0 WHERE bin IS NOT NULL WINDOW w AS (PARTITION BY {by})),
d AS (SELECT {by}, sum(({eps('p')} - {eps('q')}) * ln({eps('p')} / {eps('q')})) AS psi,
             sum((CASE WHEN p1 > 0 THEN p1 * ln(p1 / m1) ELSE 0 END + CASE WHEN q1 > 0 THEN q1 * ln(q1 / m1) ELSE 0 END) / 2)
               AS js_divergence
      FROM s1 GROUP BY {by})"""


LINES = sides("lineitem", PRICES, f"l_shipdate < {DEFAULT_CUT}")
ORDERS = sides("orders", ["o_totalprice"], f"o_orderdate < {DEFAULT_CUT}")
STATISTICS = ", ".join(
    digits(c, c) for c in ("psi", "js_divergence", "ks_stat", "ks_pvalue", "mean_diff", "var_diff")
)
REPORT = f'SELECT col AS "column", {STATISTICS} FROM d JOIN k USING (col) JOIN m USING (col)'

ORACLE["quantile_edges"] = f"""
WITH v AS ({LINES}), q AS (SELECT col, quantile_cont(value, {DECILES}) AS e FROM v GROUP BY col)
SELECT col AS "column", i::INT AS i, round(e[i + 1], 6) AS quantile FROM q, range(11) t(i)"""
ORACLE["histogram_by_edges"] = f'WITH {drift_ctes(LINES)} SELECT col AS "column", bin::INT AS bin, n_ref, n_cur FROM h'
ORACLE["psi"] = f'WITH {drift_ctes(LINES)} SELECT col AS "column", {digits("psi", "psi")} FROM d'
ORACLE["psi_open_ends"] = f'WITH {drift_ctes(ORDERS, True)} SELECT col AS "column", {digits("psi", "psi")} FROM d'
ORACLE["psi_categories"] = f"""
WITH v AS (SELECT l_shipdate < {DEFAULT_CUT} AS is_ref, 'l_returnflag' AS col, l_returnflag AS bin FROM lineitem
           UNION ALL SELECT l_shipdate < {DEFAULT_CUT}, 'l_linestatus', l_linestatus FROM lineitem),
h AS (SELECT col, bin, count(*) FILTER (is_ref) AS n_ref, count(*) FILTER (NOT is_ref) AS n_cur FROM v GROUP BY 1, 2),
{divergence_ctes('h')}
SELECT col AS "column", {digits('psi', 'psi')}, {digits('js_divergence', 'js_divergence')} FROM d"""
ORACLE["js_divergence"] = (
    f'WITH {drift_ctes(LINES)} SELECT col AS "column", {digits("js_divergence", "js_divergence")} FROM d'
)
ORACLE["ks_stat"] = f'WITH {drift_ctes(LINES)} SELECT col AS "column", {digits("ks_stat", "ks_stat")} FROM k'
ORACLE["ks_pvalue"] = (
    f'WITH {drift_ctes(ORDERS)} SELECT col AS "column", {digits("ks_pvalue", "ks_pvalue")}, n_ref, n_cur FROM k'
)
ORACLE["mean_var_diff"] = (
    f'WITH {drift_ctes(LINES)} SELECT col AS "column", {digits("mean_diff", "mean_diff")}, '
    f'{digits("var_diff", "var_diff")} FROM m'
)
ORACLE["stability_report"] = f"WITH {drift_ctes(LINES)} {REPORT}"
SPLIT_ROWS = chronological("orders", "o_orderdate", ["o_orderkey"], "", "0.6::DOUBLE", "0.6::DOUBLE + 0.2::DOUBLE")
SPLIT_SIDES = (
    f"SELECT subset = 'train' AS is_ref, 'o_totalprice' AS col, o_totalprice AS value "
    f"FROM ({SPLIT_ROWS}) WHERE subset IN ('train', 'test')"
)
ORACLE["split_stability"] = f"WITH {drift_ctes(SPLIT_SIDES)} {REPORT}"
ALERT_SIDES = sides("orders", ["o_totalprice", "o_custkey"], "o_orderstatus = 'F'")
ORACLE["drift_alert"] = f"""
WITH {drift_ctes(ALERT_SIDES)}
SELECT col AS "column", {STATISTICS}, psi > 0.2 OR ks_stat > 0.1 AS alert
FROM d JOIN k USING (col) JOIN m USING (col)"""
ORACLE["drift_by_period"] = f"""
WITH v AS (SELECT date_trunc('year', o_orderdate) AS period, o_orderdate < TIMESTAMP '1996-01-01' AS is_ref,
                  o_totalprice AS value FROM orders),
e AS (SELECT quantile_cont(value, {DECILES}) AS e FROM v WHERE is_ref),
b AS (SELECT period, is_ref, CASE WHEN value BETWEEN e[1] AND e[11] THEN len(list_filter(e[2:10], lambda z: z <= value)) END AS bin
      FROM v, e),
ref AS (SELECT bin, count(*) AS n FROM b WHERE is_ref GROUP BY bin),
u AS (SELECT period, bin, 0 AS n_ref, count(*) AS n_cur FROM b GROUP BY 1, 2
      UNION ALL SELECT period, bin, n, 0 FROM (SELECT DISTINCT period FROM b), ref),
h AS (SELECT period, bin, sum(n_ref) AS n_ref, sum(n_cur) AS n_cur FROM u GROUP BY 1, 2),
{divergence_ctes('h', 'period')}
SELECT period, 'o_totalprice' AS "column", {digits('psi', 'psi')}, {digits('js_divergence', 'js_divergence')} FROM d"""


WEIGHTS, PHASES = fourier_features(len(PRICES), 16, 7)


def mean_cosine(j: int) -> str:
    parts = [f"({c} - avg_{c}) / dev_{c} * {float(WEIGHTS[j, i])!r}::DOUBLE" for i, c in enumerate(PRICES)]
    cosine = f"{math.sqrt(2 / 16)!r}::DOUBLE * cos({' + '.join(parts)} + {float(PHASES[j])!r}::DOUBLE)"
    return f"pow(avg({cosine}) FILTER (is_ref) - avg({cosine}) FILTER (NOT is_ref), 2)"


ORACLE["joint_drift"] = f"""
WITH v AS (SELECT *, l_shipdate < {DEFAULT_CUT} AS is_ref FROM lineitem),
s AS (SELECT {', '.join(f'avg({c}) AS avg_{c}, stddev_samp({c}) AS dev_{c}' for c in PRICES)} FROM v WHERE is_ref)
SELECT round({' + '.join(mean_cosine(j) for j in range(16))}, 10) AS mmd2, count(*) FILTER (is_ref) AS n_ref, count(*) FILTER (NOT is_ref) AS n_cur
FROM v, s"""
ORACLE["profile_quantiles"] = """
WITH q AS (SELECT year(o_orderdate)::INT AS year, count(o_totalprice) AS n, quantile_disc(o_totalprice, [0.25, 0.5, 0.75]) AS q
           FROM orders GROUP BY 1)
SELECT year, 'o_totalprice' AS "column", n, (i - 1)::INT AS i, q[i] AS quantile FROM q, (SELECT unnest([1, 2, 3]) AS i)"""
ORACLE["profile_drift"] = f"""
WITH v AS (SELECT year(o_orderdate)::INT AS year, unnest([{{'col': 'o_orderpriority', 'bin': o_orderpriority}},
                                                          {{'col': 'o_orderstatus', 'bin': o_orderstatus}}]) AS x FROM orders),
c AS (SELECT year, x.col AS col, x.bin AS bin, count(*) AS n FROM v WHERE x.bin IS NOT NULL GROUP BY 1, 2, 3),
u AS (SELECT year, col, bin, 0 AS n_ref, n AS n_cur FROM c
      UNION ALL SELECT g.year, r.col, r.bin, r.n, 0
      FROM (SELECT DISTINCT year, col FROM c) g JOIN (SELECT col, bin, sum(n) AS n FROM c WHERE year < 1997 GROUP BY 1, 2) r ON g.col = r.col),
h AS (SELECT year, col, bin, sum(n_ref) AS n_ref, sum(n_cur) AS n_cur FROM u GROUP BY 1, 2, 3),
{divergence_ctes('h', 'year, col')}
SELECT year, col AS "column", {digits('psi', 'psi')}, {digits('js_divergence', 'js_divergence')} FROM d"""


# Streams

ORACLE["stream_monitor"] = f"""
WITH v AS (SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, ts, ts < TIMESTAMP '2024-01-11' AS is_ref, x.col AS col, x.value AS value
           FROM (SELECT ts, unnest([{{'col': 'value', 'value': value}}, {{'col': 'user_id', 'value': user_id::DOUBLE}}]) AS x
                 FROM events WHERE ts IS NOT NULL)),
e AS (SELECT col, quantile_cont(value, {DECILES}) AS e FROM v WHERE is_ref GROUP BY col),
b AS (SELECT window_start, ts, is_ref, v.col AS col, value IS NULL OR isnan(value) AS missing,
             CASE WHEN value BETWEEN e[1] AND e[11] THEN len(list_filter(e[2:10], lambda z: z <= value)) END AS bin
      FROM v JOIN e ON v.col = e.col),
ref AS (SELECT col, bin, count(*) AS n FROM b WHERE is_ref AND NOT missing GROUP BY col, bin),
sizes AS (SELECT window_start, col, count(*) FILTER (NOT missing) AS n, count(*) FILTER (missing) AS n_null FROM b GROUP BY 1, 2),
u AS (SELECT window_start, col, bin, 0 AS n_ref, count(*) AS n_cur FROM b WHERE NOT missing GROUP BY 1, 2, 3
      UNION ALL SELECT window_start, ref.col, bin, ref.n, 0 FROM sizes JOIN ref ON sizes.col = ref.col WHERE sizes.n > 0),
h AS (SELECT window_start, col, bin, sum(n_ref) AS n_ref, sum(n_cur) AS n_cur FROM u GROUP BY 1, 2, 3),
{divergence_ctes('h', 'window_start, col')},
t AS (SELECT sizes.*, psi, js_divergence,
             window_start + INTERVAL 1 DAY <= (SELECT max(ts) FROM b) AND sizes.n >= 20 AS judged
      FROM sizes LEFT JOIN d USING (window_start, col)),
turned AS (SELECT window_start, col,
                  CASE WHEN psi >= 0.04 AND lag(psi) OVER w >= 0.04 THEN true
                       WHEN psi < 0.02 AND lag(psi) OVER w < 0.02 THEN false END AS turn
           FROM t WHERE judged WINDOW w AS (PARTITION BY col ORDER BY window_start)),
held AS (SELECT window_start, col, coalesce(last_value(turn IGNORE NULLS) OVER (
             PARTITION BY col ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), false) AS alert FROM turned)
SELECT window_start, col AS "column", n, n_null, {digits('psi', 'psi')}, {digits('js_divergence', 'js_divergence')},
       CASE WHEN alert IS NULL THEN 'open' WHEN alert THEN 'alert' ELSE 'calm' END AS state
FROM t LEFT JOIN held USING (window_start, col)"""


# Summaries

ORACLE["histogram_equal_width"] = f"""
WITH g AS (SELECT c_mktsegment, min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer GROUP BY 1),
v AS (SELECT c_mktsegment, c_acctbal AS x, lo, hi, least(floor((c_acctbal - lo) / (hi - lo) * 20), 19)::INT AS guess
      FROM customer JOIN g USING (c_mktsegment)),
b AS (SELECT c_mktsegment, guess - (x < lo + guess * ((hi - lo) / 20))::INT
             + (guess < 19 AND x >= lo + (guess + 1) * ((hi - lo) / 20))::INT AS bin FROM v),
n AS (SELECT c_mktsegment, bin, count(*) AS n FROM b GROUP BY 1, 2)
SELECT g.c_mktsegment AS c_mktsegment, 'c_acctbal' AS "column", i::INT AS bin, {digits("lo + i * ((hi - lo) / 20)", "low")},
       {digits("CASE WHEN i = 19 THEN hi ELSE lo + (i + 1) * ((hi - lo) / 20) END", "high")}, coalesce(n, 0) AS n
FROM g CROSS JOIN range(20) t(i) LEFT JOIN n ON n.c_mktsegment = g.c_mktsegment AND n.bin = i"""


def boxes(table: str, column: str, by: str) -> str:
    return f"""
q AS (SELECT {by}, count({column}) AS n, quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.5) AS median,
             quantile_cont({column}, 0.75) AS q3 FROM {table} GROUP BY {by}),
w AS (SELECT {by}, min({column}) FILTER ({column} >= q1 - 1.5 * (q3 - q1)) AS lo,
             max({column}) FILTER ({column} <= q3 + 1.5 * (q3 - q1)) AS hi,
             count(*) FILTER ({column} < q1 - 1.5 * (q3 - q1) OR {column} > q3 + 1.5 * (q3 - q1)) AS outliers
      FROM {table} JOIN q USING ({by}) GROUP BY {by})"""


ORACLE["box_summary"] = f"""
WITH {boxes('documents', 'n_chars', 'lang')}
SELECT lang, 'n_chars' AS "column", n, {digits('q1', 'q1')}, {digits('median', 'median')}, {digits('q3', 'q3')},
       {digits('least(lo, q1)', 'whisker_low')}, {digits('greatest(hi, q3)', 'whisker_high')}, outliers
FROM q JOIN w USING (lang)"""
ORACLE["eda_outliers"] = f"""
WITH one AS (SELECT 1 AS g, n_chars FROM documents), {boxes('one', 'n_chars', 'g')}
SELECT 'n_chars' AS "column", n, outliers, {digits('outliers::DOUBLE / n', 'outlier_share')} FROM q JOIN w USING (g)"""

ORACLE["ecdf"] = f"""
WITH a AS (SELECT {CUTS} AS subset, o_totalprice AS value FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY subset ORDER BY value) AS place,
             count(*) OVER (PARTITION BY subset) AS size FROM a)
SELECT subset, 'o_totalprice' AS "column", value, count(*) AS n, {digits('(min(place) - 1)::DOUBLE / max(size)', 'cdf_low')},
       {digits('(max(place) - 1)::DOUBLE / max(size)', 'cdf_high')}
FROM r GROUP BY subset, value"""

PROFILED = sides("lineitem", [*PRICES, "l_tax"], "TRUE")
ORACLE["eda_univariate"] = f"""
WITH v AS ({PROFILED}),
a AS (SELECT col, count(*) AS n_rows, count(*) FILTER (value IS NULL) AS nulls, avg(value) AS mean, stddev_samp(value) AS sd,
             min(value) AS min, max(value) AS max, count(DISTINCT value) AS distinct_values,
             quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
      FROM v GROUP BY col),
b AS (SELECT col, avg((value - mean) ** 2) AS m2, avg((value - mean) ** 3) AS m3, avg((value - mean) ** 4) AS m4
      FROM v JOIN a USING (col) GROUP BY col)
SELECT col AS "column", n_rows, nulls, {digits('mean', 'mean')}, {digits('sd', 'sd')}, {digits('min', 'min')}, {digits('max', 'max')},
       {digits('m3 / m2 ** 1.5', 'skewness')}, {digits('m4 / (m2 * m2) - 3', 'kurtosis')}, distinct_values AS "distinct",
       {digits('q1', 'q1')}, {digits('median', 'median')}, {digits('q3', 'q3')}
FROM a JOIN b USING (col)"""

FLAGGED = " UNION ALL ".join(
    f"SELECT (l_returnflag = 'R') AS is_ref, '{c}' AS col, {c}::DOUBLE AS value FROM lineitem" for c in PRICES
)
BINNED = f"""v AS ({FLAGGED}),
e AS (SELECT col, quantile_cont(value, {DECILES}) AS e FROM v GROUP BY col),
b AS (SELECT col, is_ref, value, len(list_filter(e[2:10], lambda z: z <= value)) AS bin FROM v JOIN e USING (col))"""
ORACLE["eda_bivariate"] = f"""
WITH {BINNED}
SELECT col AS "column", bin::INT AS bin, count(*) AS n, {digits('min(value)', 'low')}, {digits('max(value)', 'high')},
       {digits('avg(is_ref::INT)', 'target_mean')}
FROM b GROUP BY col, bin"""


# Guards, projections, sources

ORACLE["label_cardinality"] = """
SELECT count(DISTINCT quality) AS n_labels, CASE WHEN count(DISTINCT quality) = 2 THEN 'binary' ELSE 'multiclass' END AS task
FROM labels"""
ORACLE["distinct_labels"] = "SELECT DISTINCT l_returnflag FROM lineitem"
ORACLE["target_null_check"] = f"""
SELECT CASE WHEN o_orderdate < {DEFAULT_CUT} THEN 'train' ELSE 'test' END AS "table", count(*) AS n_rows,
       count(*) FILTER (o_orderpriority = '5-LOW') AS n_missing, count(*) FILTER (o_orderpriority = '5-LOW') = 0 AS passed
FROM orders GROUP BY 1"""
ORACLE["feature_projection"] = "SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag FROM lineitem"
ORACLE["label_map"] = """
SELECT o_orderkey, o_orderstatus,
       CASE o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' ELSE o_orderstatus END AS status_name FROM orders"""
ORACLE["feature_metadata"] = """
SELECT o_orderkey,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN NULL WHEN o_orderpriority = '3-MEDIUM' THEN o_orderstatus
            ELSE o_orderpriority END AS target,
       CASE o_orderpriority WHEN '1-URGENT' THEN '' WHEN '2-HIGH' THEN o_orderstatus
            WHEN '3-MEDIUM' THEN o_orderstatus || ',' || o_orderpriority ELSE o_orderpriority END AS features
FROM orders"""
ORACLE["artifact_roundtrip"] = "SELECT * FROM customer"
ORACLE["scan_csv_dates"] = "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders"
ORACLE["ingest_valid_rows"] = (
    "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderpriority <> '5-LOW'"
)
ORACLE["ingest_rejected_rows"] = """
SELECT o_orderkey::VARCHAR AS o_orderkey, 'n/a' AS o_totalprice, 'o_totalprice' AS faults
FROM orders WHERE o_orderpriority = '5-LOW'"""


# Checks

ORACLE["compare_versions"] = """
WITH o AS (SELECT c_custkey, c_acctbal FROM customer),
n AS (SELECT c_custkey, CASE WHEN c_custkey % 97 = 5 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM o WHERE c_custkey % 89 <> 3
      UNION ALL SELECT c_custkey + 1000000000, c_acctbal FROM o WHERE c_custkey % 83 = 7)
SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey,
       CASE WHEN o.c_custkey IS NULL THEN 'added' WHEN n.c_custkey IS NULL THEN 'removed' ELSE 'changed' END AS change,
       (o.c_custkey IS NOT NULL)::BIGINT AS n_old, (n.c_custkey IS NOT NULL)::BIGINT AS n_new
FROM o FULL JOIN n ON o.c_custkey = n.c_custkey
WHERE o.c_custkey IS NULL OR n.c_custkey IS NULL OR o.c_acctbal <> n.c_acctbal"""
ORACLE["validate_rules"] = """
WITH a AS (SELECT count(*) AS n, count(*) FILTER (o_totalprice IS NULL) AS missing,
                  count(*) FILTER (NOT coalesce(o_totalprice BETWEEN 2000 AND 450000, FALSE)) AS outside,
                  count(*) FILTER (NOT coalesce(o_orderstatus IN ('F', 'O'), FALSE)) AS other FROM orders)
SELECT 'not_null' AS rule, 'o_totalprice' AS "column", missing AS violations, missing = 0 AS passed FROM a
UNION ALL SELECT 'in_range', 'o_totalprice', outside, outside = 0 FROM a
UNION ALL SELECT 'one_of', 'o_orderstatus', other, other = 0 FROM a
UNION ALL SELECT 'has_type', 'o_orderkey', 0, TRUE FROM a
UNION ALL SELECT 'has_type', 'o_totalprice', n, n = 0 FROM a"""
ORACLE["validate_duplicates"] = """
WITH g AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
SELECT sum(n)::BIGINT AS n_rows, count(*) AS n_keys, count(*) FILTER (n > 1) AS duplicated_keys,
       sum(n - 1)::BIGINT AS surplus_rows, count(*) FILTER (n > 1) = 0 AS passed FROM g"""


def cross_rule(rule: str, subject: str, checked: str, offenders: str) -> str:
    """The row of a rule, from the rows it checks and a select of offending keys with their violations."""
    return f"""
SELECT '{rule}' AS rule, '{subject}' AS subject, ({checked})::BIGINT AS checked, coalesce(sum(n), 0)::BIGINT AS violations,
       count(*) AS offenders, count(*) = 0 AS passed,
       coalesce(string_agg(k || ':' || n, ' ' ORDER BY n DESC, k) FILTER (place <= 5), '') AS sample
FROM (SELECT *, row_number() OVER (ORDER BY n DESC, k) AS place FROM (SELECT key::VARCHAR AS k, n::BIGINT AS n FROM ({offenders})))"""


def reference(subject: str, child: str, key: str, parents: str) -> str:
    return cross_rule(
        "refers_to", subject, f"SELECT count({key}) FROM {child}",
        f"SELECT {key} AS key, count(*) AS n FROM {child} WHERE {key} NOT IN ({parents}) GROUP BY 1",
    )


ORACLE["validate_across_tables"] = " UNION ALL ".join(f"({part})" for part in (
    reference("orders.o_custkey", "orders", "o_custkey", "SELECT c_custkey FROM customer"),
    reference("orders.o_custkey, known", "orders", "o_custkey", "SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING'"),
    reference("lineitem.l_partkey", "lineitem", "l_partkey", "SELECT p_partkey FROM part"),
    cross_rule("determines", "orders.o_custkey -> o_orderstatus", "SELECT count(o_custkey) FROM orders", """
        SELECT o_custkey AS key, sum(m) - max(m) AS n
        FROM (SELECT o_custkey, count(*) AS m FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey, o_orderstatus)
        GROUP BY 1 HAVING sum(m) > max(m)"""),
    cross_rule("has_children", "lines of an order", "SELECT count(DISTINCT o_orderkey) FROM orders", """
        SELECT * FROM (SELECT o_orderkey AS key, greatest(1 - count(l_orderkey), 0) + greatest(count(l_orderkey) - 7, 0) AS n
                       FROM (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL) o
                       LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1) WHERE n > 0"""),
    cross_rule("adds_up", "o_totalprice", "SELECT count(DISTINCT o_orderkey) FROM orders", """
        SELECT o_orderkey AS key, 1 AS n FROM orders
        LEFT JOIN (SELECT l_orderkey, sum(l_extendedprice) AS total FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
        WHERE NOT coalesce(abs(o_totalprice - coalesce(total, 0)) <= 1000, false)"""),
))
ENGLISH = "SELECT lang = 'en' AS is_ref, 'score' AS col, n_chars / 5000.0::DOUBLE AS value FROM documents"
ORACLE["validate_predictions"] = f"""
WITH {drift_ctes(ENGLISH)},
a AS (SELECT count(*) FILTER (n_chars IS NULL) AS missing, count(*) FILTER (n_chars / 5000.0 > 1) AS outside,
             count(*) FILTER (lang IS NULL) AS unlabelled, count(*) FILTER (lang NOT IN ('de', 'fr')) AS other
      FROM documents WHERE lang <> 'en')
SELECT 'not_null' AS rule, 'score' AS "column", missing AS violations, missing = 0 AS passed FROM a
UNION ALL SELECT 'in_range', 'score', outside, outside = 0 FROM a
UNION ALL SELECT 'not_null', 'lang', unlabelled, unlabelled = 0 FROM a
UNION ALL SELECT 'one_of', 'lang', other, other = 0 FROM a
UNION ALL SELECT 'drift', 'score', (psi > 0.2)::BIGINT, psi <= 0.2 FROM d"""


# Classifier metrics

SCORED = """scored AS (SELECT doc_id, quality, n_chars::DOUBLE / (n_chars::DOUBLE + 1500) AS score, (n_chars > 900)::INT AS predicted
            FROM labels JOIN documents USING (doc_id))"""
FLAG_SCORES = """wide AS (SELECT l_returnflag, l_quantity / 100 AS a, l_discount * 4 AS n, 1 - l_tax * 5 AS r FROM lineitem),
lines AS (SELECT *, CASE WHEN a >= n AND a >= r THEN 'A' WHEN n >= r THEN 'N' ELSE 'R' END AS predicted FROM wide),
long AS (SELECT 'A' AS class, a AS score, l_returnflag = 'A' AS positive FROM lines
         UNION ALL SELECT 'N', n, l_returnflag = 'N' FROM lines UNION ALL SELECT 'R', r, l_returnflag = 'R' FROM lines)"""


def area(source: str) -> str:
    """Rank-sum AUC per class from rows (class, score, positive), with mean ranks for ties."""
    return f"""
au0 AS (SELECT class, positive, rank() OVER w + (count(*) OVER (PARTITION BY class, score) - 1) / 2.0::DOUBLE AS rk
        FROM ({source}) WINDOW w AS (PARTITION BY class ORDER BY score)),
au AS (SELECT class, count(*) FILTER (positive) AS n_pos, count(*) FILTER (NOT positive) AS n_neg,
              (sum(rk) FILTER (positive) - count(*) FILTER (positive) * (count(*) FILTER (positive) + 1) / 2.0::DOUBLE)
                / (count(*) FILTER (positive)::DOUBLE * count(*) FILTER (NOT positive)) AS auc
       FROM au0 GROUP BY class)"""


def confusion(source: str, label: str) -> str:
    return f"""
cm AS (SELECT {label} AS label, predicted AS prediction, count(*) AS n FROM {source} GROUP BY 1, 2),
acc AS (SELECT sum(n) FILTER (label = prediction)::DOUBLE / sum(n) AS accuracy FROM cm),
fc AS (SELECT label AS class, sum(n) AS support, coalesce(sum(n) FILTER (label = prediction), 0) AS hits,
              (SELECT coalesce(sum(n), 0) FROM cm p WHERE p.prediction = cm.label) AS predicted FROM cm GROUP BY label),
f1 AS (SELECT sum(2.0::DOUBLE * hits / (support + predicted) * support) / sum(support) AS f1 FROM fc)"""


def bundle(auc: str) -> str:
    return f"""
SELECT 'ROC AUC' AS metric, {digits(auc, 'value')} FROM au
UNION ALL SELECT 'Accuracy', {digits('accuracy', 'value')} FROM acc
UNION ALL SELECT 'F1 Score', {digits('f1', 'value')} FROM f1"""


QUALITY = "SELECT 1 AS class, score, quality = 1 AS positive FROM scored"
WEIGHTED = "sum(auc * n_pos) / sum(n_pos)"
ORACLE["roc_auc_binary"] = f"WITH {SCORED}, {area(QUALITY)} SELECT {digits('auc', 'auc')}, n_pos, n_neg FROM au"
ORACLE["roc_auc_per_class"] = (
    f"WITH {FLAG_SCORES}, {area('SELECT * FROM long')} SELECT class, {digits('auc', 'auc')}, n_pos, n_neg FROM au"
)
ORACLE["roc_auc_ovr_weighted"] = f"WITH {FLAG_SCORES}, {area('SELECT * FROM long')} SELECT {digits(WEIGHTED, 'auc')} FROM au"
ORACLE["confusion_matrix"] = f"WITH {SCORED}, {confusion('scored', 'quality')} SELECT label, prediction, n FROM cm"
ORACLE["accuracy"] = f"WITH {SCORED}, {confusion('scored', 'quality')} SELECT {digits('accuracy', 'accuracy')} FROM acc"
ORACLE["f1_weighted"] = f"WITH {SCORED}, {confusion('scored', 'quality')} SELECT {digits('f1', 'f1')} FROM f1"
ORACLE["classification_report"] = (
    f"WITH {SCORED}, {area(QUALITY)}, {confusion('scored', 'quality')} {bundle('auc')}"
)
ORACLE["classification_report_multiclass"] = (
    f"WITH {FLAG_SCORES}, {area('SELECT * FROM long')}, {confusion('lines', 'l_returnflag')} {bundle(WEIGHTED)}"
)
ORACLE["score_deciles"] = f"""
WITH {SCORED},
r AS (SELECT *, (row_number() OVER (ORDER BY score DESC, {tie(['doc_id'])}) - 1) * 10 // count(*) OVER () + 1 AS decile FROM scored),
g AS (SELECT decile, count(*) AS n, count(*) FILTER (quality = 1) AS positives, min(score) AS lo, max(score) AS hi FROM r GROUP BY 1),
t AS (SELECT *, sum(n) OVER () AS all_n, sum(positives) OVER () AS all_p, sum(positives) OVER (ORDER BY decile) AS so_far FROM g)
SELECT decile::INT AS decile, n, positives, {digits('lo', 'min_score')}, {digits('hi', 'max_score')},
       {digits('positives::DOUBLE / n', 'rate')}, {digits('(positives::DOUBLE / n) / (all_p::DOUBLE / all_n)', 'lift')},
       {digits('so_far::DOUBLE / all_p', 'gain')}
FROM t"""
ORACLE["calibration_bins"] = f"""
WITH {SCORED}
SELECT least(floor(score * 10), 9)::INT AS bin, count(*) AS n, {digits('avg(score)', 'mean_score')},
       {digits('avg((quality = 1)::INT)', 'rate')}
FROM scored GROUP BY 1"""

# The isotonic fit at a point is the largest, over all starts up to it, of the least mean over all ends from it on.
ORACLE["isotonic_calibration"] = f"""
WITH c AS (SELECT l_quantity AS score, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS hits FROM lineitem
           WHERE l_quantity IS NOT NULL AND NOT isnan(l_quantity) GROUP BY 1),
r AS (SELECT *, sum(n) OVER w AS n_to, sum(hits) OVER w AS hits_to FROM c WINDOW w AS (ORDER BY score)),
m AS (SELECT a.score AS low, b.score AS high, (b.hits_to - a.hits_to + a.hits)::DOUBLE / (b.n_to - a.n_to + a.n) AS mean
      FROM r a JOIN r b ON a.score <= b.score),
least_mean AS (SELECT p.score, low, min(mean) AS mean FROM c p JOIN m ON low <= p.score AND p.score <= high GROUP BY 1, 2),
f AS (SELECT score, max(mean) AS fitted FROM least_mean GROUP BY 1)
SELECT c.score AS score, n, {digits('hits::DOUBLE / n', 'rate')}, {digits('fitted', 'fitted')} FROM c JOIN f ON c.score = f.score"""


# Features

ORACLE["feature_information_value"] = f"""
WITH {BINNED},
h AS (SELECT col, bin, count(*) FILTER (is_ref) AS n_ref, count(*) FILTER (NOT is_ref) AS n_cur FROM b GROUP BY 1, 2),
{divergence_ctes('h')}
SELECT col AS "column", {digits('psi', 'information_value')} FROM d"""
NUMBERS = [*PRICES, "l_tax"]
ORACLE["feature_correlation"] = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 9) AS correlation FROM lineitem"
    for i, a in enumerate(NUMBERS)
    for b in NUMBERS[i + 1:]
)
ORACLE["features_impute_scale"] = """
WITH b AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance FROM customer),
f AS (SELECT c_custkey, coalesce(balance, avg(balance) OVER ()) AS balance FROM b)
SELECT c_custkey, round((balance - avg(balance) OVER ()) / stddev_samp(balance) OVER (), 9) AS scaled FROM f"""
ORACLE["features_index_onehot"] = """
WITH g AS (SELECT o_orderpriority, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS place FROM orders GROUP BY 1)
SELECT o_orderkey, place::INT AS index, place::BIGINT AS position FROM orders JOIN g USING (o_orderpriority)"""
ORACLE["features_date_parts"] = """
SELECT o_orderkey, year(o_orderdate)::INT AS o_orderdate_year, month(o_orderdate)::INT AS o_orderdate_month,
       (dayofweek(o_orderdate) + 1)::INT AS o_orderdate_weekday, dayofyear(o_orderdate)::INT AS o_orderdate_yearday
FROM orders"""


def selection(columns: Sequence[str], top: int) -> str:
    """Variance, F value, earlier correlated column, and the best two of what is left."""
    values = " UNION ALL ".join(
        f"SELECT {i} AS place, '{c}' AS feature, (l_returnflag = 'R')::INT AS y, {c}::DOUBLE AS v FROM lineitem"
        for i, c in enumerate(columns)
    )
    pairs = " UNION ALL ".join(
        f"SELECT {i} AS pa, {j} AS pb, '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM lineitem"
        for i, a in enumerate(columns) for j, b in enumerate(columns) if i < j
    )
    return f"""
WITH RECURSIVE long AS ({values}),
g AS (SELECT place, feature, y, count(*) AS n, avg(v) AS m, var_pop(v) AS s FROM long GROUP BY ALL),
c AS (SELECT place, sum(n * m) / sum(n) AS centre, sum(n) AS rows, count(*) AS k FROM g GROUP BY 1),
f AS (SELECT g.place, g.feature, (sum(n * (m - centre) ** 2) / (any_value(k) - 1)) /
             (sum(n * s) / (any_value(rows) - any_value(k))) AS f_value
      FROM g JOIN c USING (place) GROUP BY 1, 2),
v AS (SELECT place, var_samp(v) AS variance FROM long GROUP BY 1),
pairs AS ({pairs}),
over AS (SELECT pa, pb, a FROM pairs WHERE abs(r) > 0.95),
gone AS (SELECT pb, arg_min(a, pa) AS most_correlated FROM over
         WHERE pa NOT IN (SELECT pb FROM over) GROUP BY pb),
ranked AS (SELECT place, row_number() OVER (ORDER BY f_value DESC, place) AS rank FROM f JOIN v USING (place)
           WHERE variance > 0 AND place NOT IN (SELECT pb FROM gone))
SELECT feature, round(variance, 4) AS variance, round(f_value, 6) AS f_value, most_correlated, coalesce(rank <= {top}, false) AS kept
FROM f JOIN v USING (place) LEFT JOIN gone ON place = pb LEFT JOIN ranked USING (place)"""


ORACLE["feature_selection"] = selection(["l_quantity", "l_extendedprice", "l_discount", "l_tax"], 2)


# Search under a budget of rows: the fewest rungs whose fits read at most four times all rows.
ORACLE["halving_samples"] = f"""
WITH c AS (SELECT count(*) AS n FROM lineitem),
p AS (SELECT l.range AS last, r.range AS rung, ceil(18 / pow(3, r.range))::INT AS configs, pow(3.0, r.range - l.range) AS share, n
      FROM c, range(0, 4) l, range(0, 4) r WHERE r.range <= l.range AND (l.range = 0 OR n / pow(3, l.range) >= 100)),
fits AS (SELECT last FROM p GROUP BY last, n HAVING sum(configs * ceil(share * n)) <= 4 * n),
h AS (SELECT ('0x' || substr({tie(LINE_KEY.split(', '))}, 1, 8))::BIGINT AS mark FROM lineitem)
SELECT rung::INT AS rung, share, configs, (SELECT count(*) FROM h WHERE mark < ceil(share * 4294967296)) AS "rows"
FROM p WHERE last = (SELECT min(last) FROM fits)"""


# Placement values from ranks: negatives below a positive, positives above a negative, ties half.
ORACLE["auc_difference"] = """
WITH v AS (SELECT coalesce(l_returnflag = 'R', false) AS hit, l_extendedprice AS a, l_quantity AS b FROM lineitem
           WHERE l_extendedprice IS NOT NULL AND l_quantity IS NOT NULL),
t AS (SELECT count(*) FILTER (hit) AS m, count(*) FILTER (NOT hit) AS n FROM v),
r AS (SELECT hit,
             (count(*) FILTER (NOT hit) OVER below_a + count(*) FILTER (NOT hit) OVER up_to_a) / 2.0 / n AS beats_a,
             (count(*) FILTER (NOT hit) OVER below_b + count(*) FILTER (NOT hit) OVER up_to_b) / 2.0 / n AS beats_b,
             1 - (count(*) FILTER (hit) OVER below_a + count(*) FILTER (hit) OVER up_to_a) / 2.0 / m AS beaten_a,
             1 - (count(*) FILTER (hit) OVER below_b + count(*) FILTER (hit) OVER up_to_b) / 2.0 / m AS beaten_b
      FROM v, t
      WINDOW up_to_a AS (ORDER BY a), below_a AS (ORDER BY a RANGE UNBOUNDED PRECEDING EXCLUDE GROUP),
             up_to_b AS (ORDER BY b), below_b AS (ORDER BY b RANGE UNBOUNDED PRECEDING EXCLUDE GROUP)),
s AS (SELECT count(*) FILTER (hit) AS n_pos, count(*) FILTER (NOT hit) AS n_neg,
             avg(beats_a) FILTER (hit) AS auc_first, avg(beats_b) FILTER (hit) AS auc_second,
             sqrt(var_samp(beats_a - beats_b) FILTER (hit) / count(*) FILTER (hit)
                  + var_samp(beaten_a - beaten_b) FILTER (NOT hit) / count(*) FILTER (NOT hit)) AS std_error
      FROM r),
z AS (SELECT *, auc_first - auc_second AS delta, (auc_first - auc_second) / std_error AS z,
             abs((auc_first - auc_second) / std_error) / sqrt(2) AS x FROM s),
p AS (SELECT 1 - 2 / sqrt(pi()) * exp(-(any_value(x) * any_value(x)))
             * sum(exp(k * ln(2) + (2 * k + 1) * ln(x) - (k + 1) * ln(2) - lgamma(k + 1.5) + 0.5 * ln(pi()))) AS p_value
      FROM z, (SELECT range AS k FROM range(121)))
SELECT n_pos, n_neg, round(auc_first, 9) AS auc_first, round(auc_second, 9) AS auc_second, round(delta, 9) AS delta,
       round(std_error, 9) AS std_error, round(delta - 1.959963984540054 * std_error, 9) AS low,
       round(delta + 1.959963984540054 * std_error, 9) AS high, round(z, 9) AS z, round(p_value, 9) AS p_value
FROM z, p"""


# Interpretation of a linear score. Values are exchanged within hash buckets, by ranks that hashes shift.
LINEAR_SCORE = "0.02 * {0} - 3 * {2} + 0.000001 * {1}"


def exchanged(i: int, repeat: int) -> str:
    """Scores of all lines with one number exchanged; a rank takes the value of the one ``shift`` further on, round the bucket."""
    values = [f"r.{c}" if k != i else f"d.{c}" for k, c in enumerate(PRICES)]
    return f"""
SELECT '{PRICES[i]}|{repeat}' AS class, r.positive AS positive, {LINEAR_SCORE.format(*values)} AS score
FROM r JOIN r d ON r.bucket = d.bucket AND d.rank = (r.rank - 1 + CASE WHEN r.n > 1
  THEN 1 + ('0x' || substr(md5('{PRICES[i]}|{repeat}|' || r.bucket || '|0'), 1, 8))::BIGINT % (r.n - 1) ELSE 0 END) % r.n + 1"""


ORACLE["permutation_importance"] = f"""
WITH h AS (SELECT *, l_returnflag = 'R' AS positive, {tie(LINE_KEY.split(', ')).replace('seed:42', 'seed:0')} AS tie, count(*) OVER () AS total FROM lineitem),
b AS (SELECT *, substr(tie, 1, CASE WHEN total / 16 <= 2000 THEN 1 WHEN total / 256 <= 2000 THEN 2 ELSE 3 END) AS bucket FROM h),
r AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY tie, {', '.join(PRICES)}) AS rank, count(*) OVER (PARTITION BY bucket) AS n FROM b),
long AS (SELECT '(none)|0' AS class, positive, {LINEAR_SCORE.format(*PRICES)} AS score FROM r
         UNION ALL {' UNION ALL '.join(exchanged(i, k) for i in range(len(PRICES)) for k in range(2))}),
{area('SELECT * FROM long')},
a AS (SELECT split_part(class, '|', 1) AS feature, auc AS exchanged FROM au WHERE class <> '(none)|0'),
o AS (SELECT auc FROM au WHERE class = '(none)|0')
SELECT feature, count(*) AS repeats, round(any_value(auc), 9) AS auc, round(avg(exchanged), 9) AS auc_exchanged,
       round(avg(auc - exchanged), 9) AS importance, round(stddev_samp(exchanged), 9) AS std
FROM a, o GROUP BY feature"""


def held(i: int) -> str:
    values = [c if k != i else "value" for k, c in enumerate(PRICES)]
    return f"""
SELECT '{PRICES[i]}' AS feature, value, avg({LINEAR_SCORE.format(*values)}) AS mean_score, count(*) AS n
FROM lineitem, (SELECT DISTINCT unnest(quantile_cont({PRICES[i]}, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0])) AS value FROM lineitem) GROUP BY value"""


ORACLE["partial_dependence"] = f"""
SELECT feature, {digits('value', 'value')}, {digits('mean_score', 'mean_score')}, n
FROM ({' UNION ALL '.join(held(i) for i in range(len(PRICES)))})"""


# A model family that SQL can fit: Gaussian naive Bayes, variances raised by a billionth of the largest one.
def density(c: str) -> str:
    return " - ".join(["ln(n_{0}::DOUBLE / n)".format(c)] + [
        f"0.5 * (ln(v{i}_{c} + eps) + pow({p} - m{i}_{c}, 2) / (v{i}_{c} + eps))" for i, p in enumerate(PRICES)
    ])


BAYES = f"""
l AS (SELECT *, (l_returnflag = 'R')::INT AS returned, l_shipdate <= TIMESTAMP '1999-06-01' AS train,
             l_shipdate > TIMESTAMP '1999-06-01' AND l_shipdate <= TIMESTAMP '2001-06-01' AS test FROM lineitem),
p AS (SELECT count(*) AS n, greatest({', '.join(f'var_pop({p})' for p in PRICES)}) * 1e-9 AS eps,
             {', '.join(f'count(*) FILTER (returned = {c}) AS n_{c}' for c in (0, 1))},
             {', '.join(f'avg({p}) FILTER (returned = {c}) AS m{i}_{c}, var_pop({p}) FILTER (returned = {c}) AS v{i}_{c}'
                        for c in (0, 1) for i, p in enumerate(PRICES))}
      FROM l WHERE train),
b AS (SELECT l.*, 1 / (1 + exp(({density('0')}) - ({density('1')}))) AS score FROM l, p)"""
ORACLE["own_family_ranking"] = f"""
WITH {BAYES},
{area("SELECT CASE WHEN train THEN 'train' ELSE 'test' END AS class, score, returned = 1 AS positive FROM b WHERE train OR test")}
SELECT 'Gaussian Naive Bayes' AS estimator_name, round(max(auc) FILTER (class = 'train'), 6) AS metric_train,
       round(max(auc) FILTER (class = 'test'), 6) AS metric_test FROM au"""
ORACLE["own_family_scores"] = f"""
WITH {BAYES} SELECT {LINE_KEY}, round(score, 7) AS score, 1.0::DOUBLE AS total, (score > 0.5)::INT AS predicted FROM b"""
ORACLE["table_guards"] = """
SELECT 'orders' AS "table", true AS has_target, count(*) AS n_rows, count(*) FILTER (o_orderstatus IS NULL) AS n_missing,
       count(*) > 0 AND count(*) FILTER (o_orderstatus IS NULL) = 0 AS passed FROM orders
UNION ALL SELECT 'customer', false, count(*), NULL, false FROM customer UNION ALL SELECT 'events', false, count(*), NULL, false FROM events"""
