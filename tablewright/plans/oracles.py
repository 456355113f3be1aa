"""DuckDB SQL for every query that SQL can state. Views ``region nation
customer supplier part orders lineitem events ...`` are registered by the
checker. Column names and types match the Spark queries; floating results
are rounded the same way on both sides."""

from __future__ import annotations

CASES = """
cases AS (
  SELECT s.s_name AS hospital, n.n_name AS state, p.p_type AS measure_name,
         p.p_brand AS measure_id,
         CASE WHEN l.l_returnflag = 'N' THEN 'Not Available' ELSE l.l_returnflag END AS comparison,
         CASE WHEN l.l_returnflag = 'N' THEN 'Not Available'
              ELSE CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) END AS score_text
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey),
clean AS (
  SELECT hospital, state, measure_name, measure_id, comparison,
         TRY_CAST(score_text AS DOUBLE) AS score
  FROM cases
  WHERE hospital IS NOT NULL AND state IS NOT NULL AND measure_name IS NOT NULL
    AND measure_id IS NOT NULL AND comparison IS NOT NULL AND score_text IS NOT NULL
    AND comparison <> 'Not Available')"""

TRIPS = """
trips AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
         CAST(l.l_extendedprice AS DOUBLE) AS fare, CAST(l.l_quantity AS DOUBLE) AS l_quantity,
         CAST(l.l_discount AS DOUBLE) AS l_discount, CAST(l.l_tax AS DOUBLE) AS l_tax,
         CAST(p.p_size AS DOUBLE) AS p_size
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""

TRIP_COLUMNS = ["fare", "l_quantity", "l_discount", "l_tax", "p_size"]


def _hash60(seed: int, col: str) -> str:
    return (f"('0x' || substr(md5(concat_ws(':', '{seed}', CAST({col} AS VARCHAR))), 1, 15))"
            f"::BIGINT")


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _describe() -> str:
    return _union([
        f"SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 4) AS mean, "
        f"round(stddev_samp({c}), 4) AS stddev, min({c}) AS min, max({c}) AS max FROM trips"
        for c in TRIP_COLUMNS])


def _fence_trips() -> str:
    qs = ", ".join(f"quantile_cont({c}, 0.25) AS {c}_q25, quantile_cont({c}, 0.75) AS {c}_q75"
                   for c in TRIP_COLUMNS)
    conds = " AND ".join(
        f"t.{c} >= q.{c}_q25 - 1.5 * (q.{c}_q75 - q.{c}_q25) AND "
        f"t.{c} <= q.{c}_q75 + 1.5 * (q.{c}_q75 - q.{c}_q25)" for c in TRIP_COLUMNS)
    return (f"WITH {TRIPS.strip()}, q AS (SELECT {qs} FROM trips)\n"
            f"SELECT t.* FROM trips t, q WHERE {conds}")


def _standardize(sd: str) -> str:
    stats = ", ".join(f"avg({c}) AS {c}_m, {sd}({c}) AS {c}_s" for c in TRIP_COLUMNS)
    # "+ 0.0" turns a rounded -0.0 into 0.0, as Spark's HALF_UP rounding gives
    cols = ", ".join(f"round((t.{c} - s.{c}_m) / s.{c}_s, 4) + 0.0 AS {c}" for c in TRIP_COLUMNS)
    return (f"WITH {TRIPS.strip()}, s AS (SELECT {stats} FROM trips)\n"
            f"SELECT t.l_orderkey, t.l_linenumber, t.l_partkey, t.l_suppkey, {cols} "
            f"FROM trips t, s")


# Two-feature least squares in closed form, from centred sums of products.
_LINREG = f"""
WITH {TRIPS.strip()},
m AS (
  SELECT count(*) AS n, avg(fare) AS my, avg(l_quantity) AS m1, avg(l_discount) AS m2,
         covar_pop(l_quantity, l_quantity) * count(*) AS s11,
         covar_pop(l_discount, l_discount) * count(*) AS s22,
         covar_pop(l_quantity, l_discount) * count(*) AS s12,
         covar_pop(l_quantity, fare) * count(*) AS s1y,
         covar_pop(l_discount, fare) * count(*) AS s2y,
         covar_pop(fare, fare) * count(*) AS syy
  FROM trips),
b AS (
  SELECT *, s11 * s22 - s12 * s12 AS det,
         (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
         (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2
  FROM m),
e AS (
  SELECT *, my - b1 * m1 - b2 * m2 AS b0,
         (syy - b1 * s1y - b2 * s2y) / (n - 3) AS sigma2
  FROM b),
v AS (
  SELECT *, sigma2 * s22 / det AS v1, sigma2 * s11 / det AS v2, -sigma2 * s12 / det AS c12
  FROM e),
w AS (
  SELECT *, sigma2 / n + m1 * m1 * v1 + m2 * m2 * v2 + 2 * m1 * m2 * c12 AS v0 FROM v)"""


ORACLES: dict[str, str] = {
    "text_scan_split": """
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",
    "csv_scan": """
        SELECT CAST(c_custkey AS DOUBLE) AS c_custkey, CAST(c_nationkey AS DOUBLE) AS c_nationkey,
               CAST(c_acctbal AS DOUBLE) AS c_acctbal FROM customer""",
    "csv_scan_strings": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
               CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer""",
    "table_shape": f"""
        WITH {CASES.strip()}
        SELECT count(*) AS n_rows, CAST(6 AS BIGINT) AS n_cols FROM clean""",
    "schema_listing": f"""
        WITH {CASES.strip()}
        """ + _union([
        f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, "
        f"count({c}) AS non_null FROM clean"
        for i, (c, t) in enumerate([("hospital", "string"), ("state", "string"),
                                    ("measure_name", "string"), ("measure_id", "string"),
                                    ("comparison", "string"), ("score", "double")])]),
    "head_rows": f"""
        WITH {CASES.strip()}
        SELECT * FROM clean
        ORDER BY state, hospital, measure_name, measure_id, comparison, score LIMIT 5""",
    "clean_cases": f"""
        WITH {CASES.strip()}
        SELECT * FROM clean""",
    "clean_cases_numeric": f"""
        WITH {CASES.strip()}
        SELECT hospital, state, measure_name, measure_id, comparison,
               CAST(TRY_CAST(score AS DECIMAL(10,0)) AS DOUBLE) AS score FROM clean""",
    "dropna_any": """
        WITH v AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
                          CASE WHEN value >= 1 THEN value END AS value FROM events)
        SELECT * FROM v WHERE event_type IS NOT NULL AND value IS NOT NULL""",
    "dropna_all": """
        WITH v AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
                          CASE WHEN value >= 1 THEN value END AS value FROM events)
        SELECT * FROM v WHERE event_type IS NOT NULL OR value IS NOT NULL""",
    "token_vocabulary": """
        SELECT DISTINCT unnest(string_split(concat_ws(chr(9), c_name, c_mktsegment,
               CAST(c_nationkey AS VARCHAR)), chr(9))) AS token FROM customer""",
    "token_one_hot": """
        SELECT DISTINCT c_custkey, unnest(string_split(concat_ws(chr(9), c_name, c_mktsegment,
               CAST(c_nationkey AS VARCHAR)), chr(9))) AS token, true AS present FROM customer""",
    "distinct_counts": f"""
        WITH {CASES.strip()}
        SELECT count(DISTINCT comparison) AS comparison, count(DISTINCT hospital) AS hospital,
               count(DISTINCT measure_id) AS measure_id FROM clean""",
    "global_mean_median": f"""
        WITH {CASES.strip()}
        SELECT round(avg(score), 4) AS mean_value, quantile_disc(score, 0.5) AS median_exact,
               quantile_disc(score, 0.5) AS median_approx, quantile_cont(score, 0.5) AS median_interp
        FROM clean""",
    "state_stats_by_name": f"""
        WITH {CASES.strip()}
        SELECT state, count(state) AS num_cases, round(avg(score), 4) AS mean_score,
               quantile_disc(score, 0.5) AS median_score, round(var_samp(score), 2) AS variance_score
        FROM clean GROUP BY state ORDER BY state""",
    "state_stats_exact": f"""
        WITH {CASES.strip()}
        SELECT state, count(state) AS num_cases, round(avg(score), 4) AS mean_score,
               round(quantile_cont(score, 0.5), 4) AS median_score,
               round(var_samp(score), 2) AS variance_score
        FROM clean GROUP BY state""",
    "state_stats_by_variance": f"""
        WITH {CASES.strip()}
        SELECT state, count(state) AS num_cases, round(avg(score), 4) AS mean_score,
               quantile_disc(score, 0.5) AS median_score, round(var_samp(score), 2) AS variance_score
        FROM clean GROUP BY state ORDER BY variance_score DESC, state""",
    "state_stats_joined": f"""
        WITH {CASES.strip()}
        SELECT state, round(avg(score), 4) AS mean_score, count(*) AS count,
               round(var_samp(score), 2) AS var_score
        FROM clean GROUP BY state""",
    "most_dispersed_state": f"""
        WITH {CASES.strip()}
        SELECT state, round(var_samp(score), 2) AS variance_score FROM clean GROUP BY state
        HAVING var_samp(score) IS NOT NULL ORDER BY variance_score DESC, state LIMIT 1""",
    "chosen_statistics": f"""
        WITH {CASES.strip()}
        SELECT 'score' AS column, 'mean' AS statistic, round(avg(score), 4) AS value FROM clean
        UNION ALL
        SELECT 'score', '50%', round(quantile_cont(score, 0.5), 4) FROM clean""",
    "describe_typed": f"WITH {TRIPS.strip()}\n" + _describe(),
    "summary_quartiles": f"WITH {TRIPS.strip()}, d AS (" + _describe() + "), q AS (" + _union([
        f"SELECT '{c}' AS column, round(quantile_cont({c}, 0.25), 4) AS q25, "
        f"round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75 "
        f"FROM trips" for c in TRIP_COLUMNS]) + ") SELECT d.*, q.q25, q.q50, q.q75 FROM d JOIN q ON d.\"column\" = q.\"column\"",
    "column_profile": f"WITH {TRIPS.strip()}\n" + _union([
        f"SELECT '{c}' AS column, min({c}) AS min, max({c}) AS max, round(avg({c}), 4) AS mean, "
        f"round(quantile_cont({c}, 0.5), 4) AS median FROM trips" for c in TRIP_COLUMNS]),
    "histogram_equal_width": """
        WITH mm AS (SELECT min(value) AS lo, max(value) AS hi, (max(value) - min(value)) / 10 AS w
                    FROM events),
        c AS (SELECT LEAST(CAST(floor((value - lo) / w) AS INTEGER), 9) AS bin, count(*) AS n
              FROM events, mm GROUP BY 1)
        SELECT r.bin, round(lo + r.bin * w, 6) AS bin_start, round(lo + (r.bin + 1) * w, 6) AS bin_end,
               coalesce(c.n, 0) AS n
        FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(10)) r CROSS JOIN mm
        LEFT JOIN c ON r.bin = c.bin""",
    "histogram_fixed_width": """
        WITH c AS (SELECT CAST(floor(value / 25.0) AS BIGINT) AS bin, count(*) AS n
                   FROM events GROUP BY 1),
        w AS (SELECT *, lead(bin) OVER (ORDER BY bin) AS nxt FROM c)
        SELECT bin, CAST(1 AS BIGINT) AS bins, round(bin * CAST(25.0 AS DOUBLE), 6) AS bin_start, n FROM w
        UNION ALL
        SELECT bin + 1, nxt - bin - 1, round((bin + 1) * CAST(25.0 AS DOUBLE), 6), 0 FROM w WHERE nxt > bin + 1""",
    "column_correlations": f"""
        WITH {TRIPS.strip()}
        SELECT 'fare' AS col_a, 'l_quantity' AS col_b, round(corr(fare, l_quantity), 4) AS corr FROM trips
        UNION ALL SELECT 'l_discount', 'l_tax', round(corr(l_discount, l_tax), 4) FROM trips
        UNION ALL SELECT 'fare', 'p_size', round(corr(fare, p_size), 4) FROM trips""",
    "top5_states": f"""
        WITH {CASES.strip()}
        SELECT state, count(*) AS num_cases FROM clean GROUP BY state
        ORDER BY num_cases DESC, state LIMIT 5""",
    "above_median_dataframe": f"""
        WITH {CASES.strip()}
        SELECT state, score FROM clean WHERE score > (SELECT quantile_disc(score, 0.5) FROM clean)""",
    "above_constant": f"""
        WITH {CASES.strip()}
        SELECT state, score FROM clean WHERE score > 1""",
    "above_median_subquery": f"""
        WITH {CASES.strip()}
        SELECT state, score FROM clean WHERE score > (SELECT quantile_disc(score, 0.5) FROM clean)""",
    "join_all_states": f"""
        WITH {CASES.strip()},
        g AS (SELECT state, count(*) AS count FROM clean GROUP BY state),
        a AS (SELECT state, score FROM clean WHERE score > (SELECT quantile_disc(score, 0.5) FROM clean))
        SELECT g.state, g.count, a.score FROM g JOIN a ON g.state = a.state""",
    "join_condition": f"""
        WITH {CASES.strip()},
        t AS (SELECT state, count(*) AS num_cases FROM clean GROUP BY state
              ORDER BY num_cases DESC, state LIMIT 5),
        a AS (SELECT state AS state_r, score FROM clean WHERE score > 1)
        SELECT t.state, t.num_cases, a.state_r, a.score FROM t JOIN a ON t.state = a.state_r""",
    "top5_join_above_median": f"""
        WITH {CASES.strip()},
        t AS (SELECT state, count(state) AS num_cases FROM clean GROUP BY state
              ORDER BY num_cases DESC, state LIMIT 5),
        a AS (SELECT state, score FROM clean WHERE score > (SELECT quantile_disc(score, 0.5) FROM clean))
        SELECT t.state, t.num_cases, a.score FROM t JOIN a ON t.state = a.state""",
    "top5_join_above_median_dataframe": f"""
        WITH {CASES.strip()},
        t AS (SELECT state, count(*) AS num_cases FROM clean GROUP BY state
              ORDER BY num_cases DESC, state LIMIT 5),
        a AS (SELECT state, score FROM clean WHERE score > (SELECT quantile_disc(score, 0.5) FROM clean))
        SELECT t.state, t.num_cases, a.score FROM t JOIN a ON t.state = a.state""",
    "outlier_fence": """
        WITH q AS (SELECT quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.75) AS q75 FROM events)
        SELECT e.event_id, e.event_type, e.value FROM events e, q
        WHERE e.value >= q25 - 1.5 * (q75 - q25) AND e.value <= q75 + 1.5 * (q75 - q25)""",
    "outlier_fence_trips": _fence_trips(),
    "median_binarize": f"""
        WITH {TRIPS.strip()}
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, p_size,
               CASE WHEN fare > (SELECT median(fare) FROM trips) THEN 1 ELSE 0 END AS fare_high
        FROM trips""",
    "hash_sample": f"""
        WITH s AS (SELECT o_orderkey, o_custkey, o_totalprice, {_hash60(1000, 'o_orderkey')} AS h
                   FROM orders)
        SELECT o_orderkey, o_custkey, o_totalprice FROM s
        QUALIFY row_number() OVER (ORDER BY h, o_orderkey) <= (SELECT floor(0.1 * count(*)) FROM orders)""",
    "sample_1000": f"""
        WITH s AS (SELECT o_orderkey, o_custkey, o_totalprice, {_hash60(7, 'o_orderkey')} AS h
                   FROM orders)
        SELECT o_orderkey, o_custkey, o_totalprice FROM s ORDER BY h, o_orderkey LIMIT 1000""",
    "split_exact": f"""
        WITH s AS (SELECT o_orderkey, {_hash60(100, 'o_orderkey')} AS h FROM orders),
        r AS (SELECT o_orderkey, row_number() OVER (ORDER BY h, o_orderkey) AS rn,
                     count(*) OVER () AS n FROM s)
        SELECT o_orderkey, CASE WHEN rn <= floor(0.6 * n) THEN 'train'
                                WHEN rn <= floor(0.8 * n) THEN 'validation' ELSE 'test' END AS part
        FROM r""",
    "split_bucket": f"""
        WITH s AS (SELECT o_orderkey, CAST({_hash60(7000, 'o_orderkey')} % 100 AS INTEGER) AS b
                   FROM orders)
        SELECT o_orderkey, CASE WHEN b < 60 THEN 'train' WHEN b < 80 THEN 'test'
                                ELSE 'validation' END AS part FROM s""",
    "standardize_samp": _standardize("stddev_samp"),
    "standardize_pop": _standardize("stddev_pop"),
    "kmeans_fit": """
        WITH d AS (SELECT event_type = 'error' AS e, value + CASE WHEN event_type = 'error' THEN 1000 ELSE 0 END AS z FROM events)
        SELECT round(avg(z), 3) AS z, count(*) AS size FROM d GROUP BY e""",
    "cluster_profile": """
        WITH d AS (SELECT value, CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS DOUBLE) AS x
                   FROM events)
        SELECT round(x, 4) AS x, count(*) AS n, round(avg(value), 4) AS value_mean,
               min(value) AS value_min, max(value) AS value_max
        FROM d GROUP BY x""",
    "pca_explained": f"""
        WITH {TRIPS.strip()},
        s AS (SELECT corr(fare, l_quantity) AS r, count(*) AS n FROM trips)
        SELECT 1 AS component, round((1 + abs(r)) / 2, 6) AS ratio, round((1 + abs(r)) / 2, 6) AS cumulative,
               round(1 + abs(r), 6) AS eigenvalue, round(sqrt((1 + abs(r)) * (n - 1)), 4) AS singular_value
        FROM s
        UNION ALL
        SELECT 2, round((1 - abs(r)) / 2, 6), CAST(1 AS DOUBLE), round(1 - abs(r), 6),
               round(sqrt((1 - abs(r)) * (n - 1)), 4) FROM s""",
    "linreg_coefficients": _LINREG + """
        SELECT 'l_quantity' AS term, round(b1, 4) AS estimate, round(sqrt(v1), 4) AS std_error,
               round(b1 / sqrt(v1), 4) AS t_value FROM w
        UNION ALL SELECT 'l_discount', round(b2, 4), round(sqrt(v2), 4), round(b2 / sqrt(v2), 4) FROM w
        UNION ALL SELECT '(intercept)', round(b0, 4), round(sqrt(v0), 4), round(b0 / sqrt(v0), 4) FROM w""",
    "glm_gaussian": _LINREG + """
        SELECT 'l_quantity' AS term, round(b1, 4) AS estimate FROM w
        UNION ALL SELECT 'l_discount', round(b2, 4) FROM w
        UNION ALL SELECT '(intercept)', round(b0, 4) FROM w
        UNION ALL SELECT 'deviance_ratio', round((syy - b1 * s1y - b2 * s2y) / syy, 6) FROM w
        UNION ALL SELECT 'aic', round(n * (ln(2 * pi() * (syy - b1 * s1y - b2 * s2y) / n) + 1) + 2 + 2 * 3, 1)
        FROM w""",
    "regression_metrics": """
        WITH d AS (SELECT l.l_extendedprice AS y, l.l_quantity * p.p_retailprice AS p
                   FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)
        SELECT count(*) AS n, round(avg((y - p) * (y - p)), 2) AS mse,
               round(sqrt(avg((y - p) * (y - p))), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae,
               round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2,
               round(corr(y, p) * corr(y, p), 6) AS r2_corr
        FROM d""",
    "logit_coefficients": """
        WITH m AS (SELECT median(value) AS med FROM events),
        d AS (SELECT CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS DOUBLE) AS x,
                     CASE WHEN value > med THEN 1 ELSE 0 END AS y FROM events, m),
        g AS (SELECT x, count(*) AS n, sum(y) AS s, avg(y) AS p FROM d GROUP BY x),
        c AS (SELECT max(CASE WHEN x = 0 THEN ln(p / (1 - p)) END) AS b0,
                     max(CASE WHEN x = 1 THEN ln(p / (1 - p)) END) AS l1,
                     -2 * sum(s * ln(p) + (n - s) * ln(1 - p)) AS dev FROM g)
        SELECT '(intercept)' AS term, round(b0, 6) AS estimate FROM c
        UNION ALL SELECT 'x', round(l1 - b0, 6) FROM c
        UNION ALL SELECT 'deviance', round(dev, 6) FROM c
        UNION ALL SELECT 'aic', round(dev + 4, 6) FROM c""",
    "classify_threshold": """
        SELECT event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label,
               CASE WHEN value > 50.0 THEN 1 ELSE 0 END AS prediction FROM events""",
    "confusion_matrix": """
        WITH d AS (SELECT CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label,
                          CASE WHEN value > 50.0 THEN 1 ELSE 0 END AS prediction FROM events),
        g AS (SELECT a.label, b.prediction FROM (VALUES (0), (1)) a(label), (VALUES (0), (1)) b(prediction)),
        c AS (SELECT label, prediction, count(*) AS n FROM d GROUP BY 1, 2),
        f AS (SELECT g.label, g.prediction, coalesce(c.n, 0) AS n FROM g LEFT JOIN c
              ON g.label = c.label AND g.prediction = c.prediction)
        SELECT label, prediction, n,
               round(CAST(n AS DOUBLE) * 100 / CAST(sum(n) OVER () AS DOUBLE), 1) AS pct FROM f""",
    "accuracy_precision": """
        WITH d AS (SELECT CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS y,
                          CASE WHEN value > 50.0 THEN 1 ELSE 0 END AS p FROM events),
        c AS (SELECT count(*) AS n, count_if(y = 1 AND p = 1) AS tp, count_if(y = 0 AND p = 0) AS tn,
                     count_if(y = 0 AND p = 1) AS fp, count_if(y = 1 AND p = 0) AS fn FROM d)
        SELECT n, tp, tn, fp, fn, round((tp + tn) / n, 6) AS accuracy,
               round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall
        FROM c""",
    "roc_auc": """
        WITH d AS (SELECT CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS y, value AS s FROM events),
        r AS (SELECT y, CAST(rank() OVER (ORDER BY s) AS DOUBLE)
                        + CAST(count(*) OVER (PARTITION BY s) - 1 AS DOUBLE) / 2 AS rk FROM d),
        c AS (SELECT count_if(y = 1) AS n_pos, count_if(y = 0) AS n_neg,
                     sum(CASE WHEN y = 1 THEN rk ELSE 0 END) AS rs FROM r)
        SELECT n_pos, n_neg,
               round((rs - CAST(n_pos AS DOUBLE) * (n_pos + 1) / 2) / (CAST(n_pos AS DOUBLE) * n_neg), 6)
               AS auc FROM c""",
}


def _split(key_exprs: str, seed: int = 7000) -> str:
    """Hash bucket of a split, as ``_hash60`` over several keys."""
    return (f"CAST(('0x' || substr(md5(concat_ws(':', '{seed}', {key_exprs})), 1, 15))::BIGINT % 100 AS INTEGER)")


_TRIP_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_TRIP_PARTS = f"""{TRIPS.strip()},
parts AS (SELECT *, {_split(_TRIP_KEYS)} AS b FROM trips),
train AS (SELECT * FROM parts WHERE b < 60),
valid AS (SELECT * FROM parts WHERE b >= 80)"""

_METRICS = """
SELECT count(*) AS n, round(avg((y - p) * (y - p)), 2) AS mse, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
       round(avg(abs(y - p)), 4) AS mae, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2,
       round(corr(y, p) * corr(y, p), 6) AS r2_corr
FROM scored"""

_FENCED = """
base AS (SELECT event_id, event_type, value, ln(value) AS log_value FROM events),
q AS (SELECT quantile_cont(value, 0.25) AS a1, quantile_cont(value, 0.75) AS a3,
             quantile_cont(log_value, 0.25) AS b1, quantile_cont(log_value, 0.75) AS b3 FROM base),
fenced AS (
  SELECT base.* FROM base, q
  WHERE value >= a1 - 1.5 * (a3 - a1) AND value <= a3 + 1.5 * (a3 - a1)
    AND log_value >= b1 - 1.5 * (b3 - b1) AND log_value <= b3 + 1.5 * (b3 - b1))"""

# Two standardised columns: components (1, s)/sqrt2 and (1, -s)/sqrt2, s the
# sign of the correlation; equal loadings are positive on the first column.
_PCA2 = f"""
{TRIPS.strip()},
m AS (SELECT avg(fare) AS m1, stddev_samp(fare) AS s1, avg(l_quantity) AS m2, stddev_samp(l_quantity) AS s2,
             CASE WHEN corr(fare, l_quantity) < 0 THEN -1.0 ELSE 1.0 END AS s FROM trips),
scores AS (
  SELECT t.*, ((fare - m1) / s1 + s * (l_quantity - m2) / s2) / sqrt(2.0) AS x,
         ((fare - m1) / s1 - s * (l_quantity - m2) / s2) / sqrt(2.0) AS y
  FROM trips t, m)"""

_FLAG_PARTS = f"""
med AS (SELECT median(value) AS med FROM events),
d AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS x,
             CASE WHEN value > med THEN 1 ELSE 0 END AS y, {_split('event_id')} AS b FROM events, med),
fit AS (SELECT x, avg(y) AS p FROM d WHERE b < 60 GROUP BY x),
test AS (SELECT d.y, fit.p FROM d JOIN fit USING (x) WHERE d.b >= 60 AND d.b < 80),
auc AS (
  SELECT sum(a.n * b.n * CASE WHEN a.p > b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0.0 END)
         / (max(a.t) * max(b.t)) AS auc, CAST(max(a.t) AS BIGINT) AS n_pos, CAST(max(b.t) AS BIGINT) AS n_neg
  FROM (SELECT p, count(*) AS n, sum(count(*)) OVER () AS t FROM test WHERE y = 1 GROUP BY p) a,
       (SELECT p, count(*) AS n, sum(count(*)) OVER () AS t FROM test WHERE y = 0 GROUP BY p) b)"""


ORACLES |= {
    "sparse_fields": """
        SELECT s_name AS hospital, n_name || '-' || CAST(s_suppkey % 7 AS VARCHAR) AS city, n_name AS state,
               p_type AS measure_name, p_brand AS measure_id, l_returnflag AS comparison,
               CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) AS score
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        JOIN part ON l_partkey = p_partkey WHERE l_returnflag <> 'N'""",
    "numeric_text_cast": """
        SELECT c_custkey, CAST(CAST(CAST(c_acctbal AS VARCHAR) AS DECIMAL(10,0)) AS DOUBLE) AS as_numeric,
               c_acctbal AS as_double FROM customer""",
    "trip_medians": f"""
        WITH {TRIPS.strip()}
        SELECT round(avg(fare), 4) AS mean_fare, quantile_disc(fare, 0.5) AS median_exact,
               round(quantile_cont(fare, 0.5), 6) AS median_interp, true AS approx_within_bound FROM trips""",
    "quantiles_in_rounds": f"WITH {TRIPS.strip()}\n" + _union([
        f"SELECT '{c}' AS column, CAST({p} AS DOUBLE) AS p, round(quantile_cont({c}, {p}), 6) AS cont, "
        f"round(quantile_disc({c}, {p}), 6) AS disc FROM trips"
        for c in TRIP_COLUMNS for p in (0.05, 0.25, 0.5, 0.75, 0.95)]),
    "state_ranking": f"""
        WITH {CASES.strip()},
        g AS (SELECT state, count(*) AS count, round(var_samp(score), 2) AS variance FROM clean GROUP BY state)
        SELECT state, count, variance, row_number() OVER (ORDER BY state) AS by_name,
               row_number() OVER (ORDER BY count DESC, state) AS by_count,
               row_number() OVER (ORDER BY variance DESC NULLS LAST, state) AS by_variance FROM g""",
    "describe_mixed": f"WITH {CASES.strip()}\n" + _union([
        f"SELECT '{c}' AS column, count({c}) AS count, CAST(NULL AS DOUBLE) AS mean, "
        f"CAST(NULL AS DOUBLE) AS stddev, min({c}) AS min, max({c}) AS max FROM clean"
        for c in ("hospital", "state", "measure_name", "measure_id", "comparison")] + [
        "SELECT 'score', count(score), round(avg(score), 4), round(stddev_samp(score), 4), "
        "CAST(min(score) AS VARCHAR), CAST(max(score) AS VARCHAR) FROM clean"]),
    "outlier_fence_columns": f"""
        WITH {_FENCED.strip()}
        SELECT event_id, value, round(log_value, 6) AS log_value FROM fenced""",
    "bernoulli_sample": f"""
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE {_hash60(1000, 'o_orderkey')} < {int(0.1 * (1 << 60))}""",
    "sample_with_replacement": f"""
        WITH r AS (SELECT o_orderkey, o_custkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS rk FROM orders),
        d AS (SELECT range AS draw, {_hash60(5, 'range')} % (SELECT count(*) FROM orders) + 1 AS rk FROM range(1000))
        SELECT o_orderkey, o_custkey, o_totalprice, draw FROM d JOIN r USING (rk)""",
    "split_random": f"""
        WITH s AS (SELECT o_orderkey, {_hash60(100, 'o_orderkey')} AS h FROM orders)
        SELECT o_orderkey, CASE WHEN h < {int(0.6 * (1 << 60))} THEN 'train'
                                WHEN h < {int((0.6 + 0.2) / (0.6 + 0.2 + 0.2) * (1 << 60))} THEN 'validation'
                                ELSE 'test' END AS part FROM s""",
    "kmeans_two": """
        WITH d AS (SELECT event_type = 'error' AS e, value + CASE WHEN event_type = 'error' THEN 1000 ELSE 0 END AS z FROM events),
        t AS (SELECT var_pop(z) * count(*) AS tss FROM d),
        w AS (SELECT sum(v) AS wss FROM (SELECT var_pop(z) * count(*) AS v FROM d GROUP BY e))
        SELECT 1 AS k, round(tss, 1) AS wss, CAST(0 AS DOUBLE) AS r2_pct FROM t
        UNION ALL SELECT 2, round(wss, 1), round(100 * (tss - wss) / tss, 6) FROM t, w""",
    "pca_identities": f"WITH {TRIPS.strip()}\nSELECT CAST(4 AS DOUBLE) AS trace, round(4 + 2 * (" + " + ".join(
        f"corr({a}, {b}) ** 2" for i, a in enumerate(TRIP_COLUMNS[1:]) for b in TRIP_COLUMNS[i + 2:])
        + "), 6) AS squares, CAST(1 AS DOUBLE) AS cumulative FROM trips",
    "pca_scores": f"""
        WITH {_PCA2.strip()}
        SELECT {_TRIP_KEYS}, round(x, 4) + 0.0 AS pc1, round(y, 4) + 0.0 AS pc2 FROM scores""",
    "pca_biplot": f"""
        WITH {_PCA2.strip()},
        mx AS (SELECT max(x) AS mx, max(y) AS my FROM scores)
        SELECT 'arrow' AS kind, 'fare' AS name, round(mx / sqrt(2.0), 4) AS x, round(my / sqrt(2.0), 4) AS y FROM mx
        UNION ALL SELECT 'arrow', 'l_quantity', round(s * mx / sqrt(2.0), 4), round(-s * my / sqrt(2.0), 4) FROM mx, m
        UNION ALL SELECT 'point', concat_ws('-', {_TRIP_KEYS}), round(x, 4) + 0.0, round(y, 4) + 0.0 FROM scores
        WHERE ('0x' || substr(md5(concat_ws(':', '1', {_TRIP_KEYS})), 1, 15))::BIGINT < {int(0.1 * (1 << 60))}""",
    "linreg_significance": _LINREG + """
        SELECT 'l_quantity' AS term, round(b1 / sqrt(v1), 4) AS t_value, abs(b1 / sqrt(v1)) > 2.5759 AS significant FROM w
        UNION ALL SELECT 'l_discount', round(b2 / sqrt(v2), 4), abs(b2 / sqrt(v2)) > 2.5759 FROM w
        UNION ALL SELECT '(intercept)', round(b0 / sqrt(v0), 4), abs(b0 / sqrt(v0)) > 2.5759 FROM w""",
    "linreg_validation": f"""
        WITH {_TRIP_PARTS.strip()},
        m AS (SELECT avg(fare) AS my, avg(l_quantity) AS m1, avg(l_discount) AS m2,
                     covar_pop(l_quantity, l_quantity) AS s11, covar_pop(l_discount, l_discount) AS s22,
                     covar_pop(l_quantity, l_discount) AS s12, covar_pop(l_quantity, fare) AS s1y,
                     covar_pop(l_discount, fare) AS s2y FROM train),
        c AS (SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
                     (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM m),
        scored AS (SELECT fare AS y, my + b1 * (l_quantity - m1) + b2 * (l_discount - m2) AS p FROM valid, c)
        {_METRICS}""",
    "fenced_linreg": f"""
        WITH {_FENCED.strip()},
        mo AS (SELECT avg(value) AS m, stddev_samp(value) AS s FROM fenced),
        z AS (SELECT (value - m) / s AS y, event_type = 'error' AS e, {_split('event_id')} AS b FROM fenced, mo),
        g AS (SELECT e, avg(y) AS p FROM z WHERE b < 60 GROUP BY e),
        scored AS (SELECT z.y, g.p FROM z JOIN g USING (e) WHERE z.b >= 80)
        {_METRICS}""",
    "logit_validation_flag": f"""
        WITH {_FLAG_PARTS.strip()},
        c AS (SELECT count(*) AS n, count_if(y = 1 AND p > 0.5) AS tp, count_if(y = 0 AND p <= 0.5) AS tn,
                     count_if(y = 0 AND p > 0.5) AS fp, count_if(y = 1 AND p <= 0.5) AS fn FROM test)
        SELECT n, tp, tn, fp, fn, round((tp + tn) / n, 6) AS accuracy, round(tp / nullif(tp + fp, 0), 6) AS precision,
               round(tp / nullif(tp + fn, 0), 6) AS recall, round(CAST(auc AS DOUBLE), 6) AS auc FROM c, auc""",
    "logistic_sweep": f"""
        WITH {_FLAG_PARTS.strip()}
        SELECT CAST(r AS DOUBLE) AS reg_param, n_pos, n_neg, round(CAST(auc AS DOUBLE), 6) AS auc
        FROM auc, (VALUES (0.0), (0.01), (0.1)) v(r)""",
    # ridge on one feature: the solver works on columns divided by their sds,
    # with the strength divided by the label's
    "ridge_sweep": f"""
        WITH {_TRIP_PARTS.strip()},
        m AS (SELECT avg(fare) AS my, avg(l_quantity) AS mx, stddev_pop(fare) AS sy, stddev_pop(l_quantity) AS sx,
                     corr(l_quantity, fare) AS r FROM train),
        k AS (SELECT CAST(reg AS DOUBLE) AS reg, my, mx, r / (1 + reg / sy) * sy / sx AS slope
              FROM m, (VALUES (0.0), (100.0), (10000.0)) v(reg)),
        scored AS (SELECT reg, fare AS y, my + slope * (l_quantity - mx) AS p FROM valid, k)
        SELECT reg AS reg_param, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
               round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2
        FROM scored GROUP BY reg""",
}


# --- four features: normal equations by the sweep operator --------------------------

_X = TRIP_COLUMNS[1:]


def _swept(source: str, p: int, carried: str = "") -> str:
    """CTEs s1 to s<p> that sweep the pivots 0 to p - 1 of the symmetric matrix
    a_i_j (i <= j <= p) in the columns of ``source``: then a_j_p are the
    coefficients, a_p_p is the residual sum and -a_i_j the inverse."""
    a = lambda i, j: f"a_{min(i, j)}_{max(i, j)}"
    out, src = [], source
    for k in range(p):
        cells = []
        for i in range(p + 1):
            for j in range(i, p + 1):
                if i == j == k:
                    v = f"-1 / {a(k, k)}"
                elif k in (i, j):
                    v = f"{a(i, j)} / {a(k, k)}"
                else:
                    v = f"{a(i, j)} - {a(i, k)} * {a(k, j)} / {a(k, k)}"
                cells.append(f"{v} AS {a(i, j)}")
        out.append(f"s{k + 1} AS (SELECT {carried}{', '.join(cells)} FROM {src})")
        src = f"s{k + 1}"
    return ",\n".join(out)


_XY = [*_X, "fare"]
_CROSS = ", ".join(f"covar_pop({_XY[i]}, {_XY[j]}) * count(*) AS a_{i}_{j}" for i in range(5) for j in range(i, 5))
_MEANS = ", ".join(f"avg({c}) AS m{i}" for i, c in enumerate(_XY))
_INTERCEPT_VAR = " + ".join(f"m{i} * m{j} * -a_{min(i, j)}_{max(i, j)}" for i in range(4) for j in range(4))
# p value of t by Simpson's rule over the density of Student's t, which is 0 to many digits beyond 40
_SUMMARY = f"""
WITH {TRIPS.strip()},
s0 AS (SELECT count(*) AS n, {_MEANS}, {_CROSS} FROM trips),
{_swept("s0", 4, "n, " + ", ".join(f"m{i}" for i in range(5)) + ", ")},
fit AS (SELECT *, a_4_4 / (n - 5) AS sigma2 FROM s4),
terms AS (
  {" UNION ALL ".join(f"SELECT '{c}' AS term, n, a_{i}_4 AS b, sqrt(sigma2 * -a_{i}_{i}) AS se FROM fit" for i, c in enumerate(_X))}
  UNION ALL SELECT '(intercept)', n, m4 - {" - ".join(f"a_{i}_4 * m{i}" for i in range(4))},
                   sqrt(sigma2 * (1.0 / n + {_INTERCEPT_VAR})) FROM fit),
density AS (
  SELECT term, k, least(abs(b / se), 40) / 4000 AS h,
         CASE WHEN k IN (0, 4000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END
         * exp(lgamma((n - 4) / 2.0) - lgamma((n - 5) / 2.0)) / sqrt((n - 5) * pi())
         * pow(1 + pow(k * least(abs(b / se), 40) / 4000, 2) / (n - 5), -(n - 4) / 2.0) AS f
  FROM terms, range(4001) r(k)),
tail AS (SELECT term, greatest(1 - 2 * max(h) / 3 * sum(f), 0) AS p FROM density GROUP BY term)
SELECT term, round(b, 4) AS estimate, round(se, 4) AS std_error, round(b / se, 4) AS t_value, round(p, 6) + 0.0 AS p_value"""

_CORR = ", ".join(f"{'1' if i == j else f'corr({_XY[i]}, {_XY[j]})'} {'+ reg / stddev_pop(fare)' if i == j < 4 else ''} AS a_{i}_{j}"
                  for i in range(5) for j in range(i, 5))
_TOTALS = ", ".join(f"stddev_pop({c}) AS d{i}" for i, c in enumerate(_XY))

ORACLES |= {
    "linreg_summary": _SUMMARY + " FROM terms JOIN tail USING (term)",
    "chunked_linreg": _SUMMARY + """,
       (SELECT count(DISTINCT l_orderkey // 1000) FROM trips) AS chunks FROM terms JOIN tail USING (term)""",
    "regularization_sweep": f"""
        WITH {_TRIP_PARTS.strip()},
        s0 AS (SELECT CAST(reg AS DOUBLE) AS reg, {_MEANS}, {_TOTALS}, {_CORR}
               FROM train, (VALUES (0.0), (0.01), (0.1), (1.0), (10.0)) v(reg) GROUP BY reg),
        {_swept("s0", 4, "reg, " + ", ".join(f"m{i}, d{i}" for i in range(5)) + ", ")},
        scored AS (SELECT reg, fare AS y, m4 + {" + ".join(f"a_{i}_4 * d4 / d{i} * ({c} - m{i})" for i, c in enumerate(_X))} AS p
                   FROM valid, s4)
        SELECT reg AS reg_param, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
               round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2
        FROM scored GROUP BY reg""",
    "elastic_sweep": f"""
        WITH {_TRIP_PARTS.strip()},
        m AS (SELECT avg(fare) AS my, avg(l_quantity) AS mx, stddev_pop(fare) AS sy, stddev_pop(l_quantity) AS sx,
                     corr(l_quantity, fare) AS r FROM train),
        k AS (SELECT CAST(reg AS DOUBLE) AS reg, my, mx,
                     sign(r) * greatest(abs(r) - reg / sy / 2, 0) / (1 + reg / sy / 2) * sy / sx AS slope
              FROM m, (VALUES (0.0), (100.0), (5000.0), (50000.0)) v(reg)),
        scored AS (SELECT reg, fare AS y, my + slope * (l_quantity - mx) AS p FROM valid, k)
        SELECT reg AS reg_param, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
               round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2
        FROM scored GROUP BY reg""",
    "merged_moments": f"""
        WITH {TRIPS.strip()}
        {" UNION ALL ".join(f"SELECT '{c}' AS name, count(*) AS n, round(avg({c}), 6) AS mean, round(covar_pop(fare, {c}), 4) AS covar_fare FROM trips" for c in TRIP_COLUMNS)}""",
    "kmeans_balance": f"""
        WITH {TRIPS.strip()}
        SELECT k, count(*) AS n, round(CAST(4 * (count(*) - 1) AS DOUBLE), 2) AS tss, CAST(0 AS DOUBLE) AS gap, true AS within
        FROM trips, (VALUES (1), (2), (3), (5), (8)) v(k) GROUP BY k""",
    "cluster_sample_clouds": f"""
        WITH s AS (SELECT CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END AS x, value FROM events
                   ORDER BY {_hash60(3, 'event_id')}, event_id LIMIT 1000)
        SELECT CAST(x AS DOUBLE) AS x, count(*) AS n, round(avg(value), 4) AS value_mean, min(value) AS value_min,
               max(value) AS value_max FROM s GROUP BY x""",
    "chunked_logit": ORACLES["logit_coefficients"],
    **{f"logit_{name}_equations": f"""
        SELECT term, (SELECT count(*) FROM lineitem JOIN part ON l_partkey = p_partkey) AS n, CAST(0 AS DOUBLE) AS score
        FROM (VALUES {", ".join(f"('{c}')" for c in [*_X, "(intercept)"])}) t(term)""" for name in ("score", "solver")},
}

ORACLES |= {
    "roc_curve": """
        WITH g AS (SELECT CAST(value AS DOUBLE) AS score, count_if(event_type = 'error') AS p, count_if(event_type <> 'error') AS n
                   FROM events GROUP BY value),
        c AS (SELECT score, CAST(sum(p) OVER (ORDER BY score DESC) AS BIGINT) AS tp, CAST(sum(n) OVER (ORDER BY score DESC) AS BIGINT) AS fp,
                     sum(p) OVER () AS all_p, sum(n) OVER () AS all_n FROM g)
        SELECT score, tp, fp, round(tp / all_p, 9) AS tpr, round(fp / all_n, 9) AS fpr FROM c""",
    "trip_ranks": f"""
        WITH {TRIPS.strip()}
        SELECT {_TRIP_KEYS}, fare, row_number() OVER (PARTITION BY l_linenumber ORDER BY fare DESC, {_TRIP_KEYS}) AS place FROM trips""",
    "token_numbers": """
        WITH t AS (SELECT DISTINCT c_custkey, unnest(string_split(concat_ws(chr(9), c_name, c_mktsegment,
               CAST(c_nationkey AS VARCHAR)), chr(9))) AS token FROM customer)
        SELECT token, dense_rank() OVER (ORDER BY token) - 1 AS token_id, count(*) AS n_rows FROM t GROUP BY token""",
    "token_vectors": """
        WITH t AS (SELECT c_custkey, unnest(string_split(concat_ws(chr(9), c_name, c_mktsegment,
               CAST(c_nationkey AS VARCHAR)), chr(9))) AS token FROM customer),
        m AS (SELECT c_custkey, token, count(*) AS many FROM t GROUP BY ALL),
        d AS (SELECT token, dense_rank() OVER (ORDER BY token) - 1 AS id FROM m WHERE c_custkey % 2 = 0 GROUP BY token)
        SELECT c_custkey, coalesce(string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) FILTER (id IS NOT NULL), '') AS indices,
               coalesce(string_agg(CAST(many AS VARCHAR), ',' ORDER BY id) FILTER (id IS NOT NULL), '') AS counts,
               CAST(coalesce(sum(many) FILTER (id IS NULL), 0) AS BIGINT) AS n_unknown
        FROM m LEFT JOIN d USING (token) GROUP BY c_custkey""",
    "csv_accepted_rows": """
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 10 NOT IN (3, 7)""",
    "csv_rejected_lines": """
        SELECT concat_ws(',', c_custkey, c_name, c_nationkey,
                         CASE WHEN c_custkey % 10 = 7 THEN 'Not Available' ELSE CAST(c_acctbal AS VARCHAR) END,
                         CASE WHEN c_custkey % 10 <> 3 THEN c_mktsegment END) AS line,
               CASE WHEN c_custkey % 10 = 3 THEN 'fields' ELSE 'c_acctbal: not double' END AS reason
        FROM customer WHERE c_custkey % 10 IN (3, 7)""",
    "line_faults": """
        SELECT CASE c_custkey % 10 WHEN 3 THEN 'fields' WHEN 7 THEN 'c_acctbal: not double' END AS reason, count(*) AS n_lines,
               round(sum(CASE WHEN c_custkey % 10 <> 7 THEN c_acctbal END), 2) AS balance
        FROM customer GROUP BY 1""",
    "merged_sketches": """
        SELECT event_type, CAST(p AS DOUBLE) AS p, count(value) AS n, count(DISTINCT user_id) AS n_users,
               true AS rank_holds, true AS count_holds
        FROM events, (VALUES (0.25), (0.5), (0.75)) AS q(p) GROUP BY event_type, p""",
    "order_lines_bucketed": """
        SELECT o_orderkey, n_lines, quantity, o_totalprice FROM orders JOIN
        (SELECT l_orderkey, count(*) AS n_lines, round(sum(l_quantity), 4) AS quantity FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""",
}
ORACLES["join_all_states_bucketed"] = ORACLES["join_all_states"]


def _eigen_sql(columns: list[str]) -> str:
    """CTEs to ``eigen`` (component, value, n): the eigenvalues of the four
    columns' correlation matrix, as 1 plus the roots of the characteristic
    polynomial x^4 + a2 x^2 + a3 x + a4 of the matrix less the unit matrix.
    The roots are found together: each is corrected by the polynomial over
    the product of its distances to the others."""
    r = lambda i, j: f"r{min(i, j)}{max(i, j)}"
    pairs = [(i, j) for i in range(4) for j in range(i + 1, 4)]
    corr = ", ".join(f"corr({columns[i]}, {columns[j]}) AS {r(i, j)}" for i, j in pairs)
    triples = [(i, j, k) for i in range(4) for j in range(i + 1, 4) for k in range(j + 1, 4)]
    a2 = "-(" + " + ".join(f"{r(i, j)} ** 2" for i, j in pairs) + ")"
    a3 = "-2 * (" + " + ".join(f"{r(i, j)} * {r(j, k)} * {r(i, k)}" for i, j, k in triples) + ")"
    u, v, w = "r01 * r23", "r02 * r13", "r03 * r12"
    a4 = f"({u}) ** 2 + ({v}) ** 2 + ({w}) ** 2 - 2 * ({u} * {v} + {u} * {w} + {v} * {w})"
    step = ", ".join(
        f"x{i} - (x{i} ** 4 + a2 * x{i} ** 2 + a3 * x{i} + a4) / ("
        + " * ".join(f"(x{i} - x{j})" for j in range(4) if j != i) + ")" for i in range(4))
    return f"""{TRIPS.strip()},
c AS (SELECT count(*) AS n, {corr} FROM trips),
poly AS (SELECT n, {a2} AS a2, {a3} AS a3, {a4} AS a4 FROM c),
roots(step, x0, x1, x2, x3, a2, a3, a4, n) AS (
  SELECT 0, CAST(-1.1 AS DOUBLE), CAST(-0.37 AS DOUBLE), CAST(0.53 AS DOUBLE), CAST(1.7 AS DOUBLE), a2, a3, a4, n FROM poly
  UNION ALL
  SELECT step + 1, {step}, a2, a3, a4, n FROM roots WHERE step < 200 AND x0 <> x1 AND x0 <> x2 AND x0 <> x3 AND x1 <> x2 AND x1 <> x3 AND x2 <> x3),
last AS (SELECT * FROM roots ORDER BY step DESC LIMIT 1),
eigen AS (SELECT row_number() OVER (ORDER BY x DESC) AS component, 1 + x AS value, n
          FROM (SELECT unnest([x0, x1, x2, x3]) AS x, n FROM last))"""


_EXPLAINED = f"""
WITH RECURSIVE {_eigen_sql(_X)}
SELECT CAST(component AS INTEGER) AS component, round(value / 4, 6) AS ratio,
       round(sum(value) OVER (ORDER BY component) / 4, 6) AS cumulative,
       round(value, 6) AS eigenvalue, round(sqrt(value * (n - 1)), 4) AS singular_value
FROM eigen"""

ORACLES |= {
    "pca_explained_all": _EXPLAINED,
    "pca_explained_qr": _EXPLAINED,
    "pca_loadings_qr": f"WITH {TRIPS.strip()}\n" + "\nUNION ALL\n".join(
        f"SELECT '{a}' AS name, '{b}' AS other, round(corr({a}, {b}), 6) + 0.0 AS correlation, "
        f"CAST({int(a == b)} AS DOUBLE) AS product FROM trips" for a in _X for b in _X),
    "linreg_qr": ORACLES["linreg_summary"],
}


def _vectors_sql(columns: list[str]) -> str:
    """CTEs to ``vec`` (``v0`` and ``v1``: loadings of the first two
    components as lists). The product of the matrix less each of the other
    three eigenvalues has the component's vector in every column; the column
    with the largest diagonal is taken, at length 1, its loading largest in
    size positive."""
    a = lambda i, j, e: f"-e[{e + 1}]" if i == j else f"r{min(i, j)}{max(i, j)}"
    span, rest = range(4), {0: (1, 2, 3), 1: (0, 2, 3)}
    two = ", ".join(f"{' + '.join(f'({a(i, m, o[0])}) * ({a(m, j, o[1])})' for m in span)} AS b{k}_{i}{j}"
                    for k, o in rest.items() for i in span for j in span)
    three = ", ".join(f"{' + '.join(f'b{k}_{i}{m} * ({a(m, j, o[2])})' for m in span)} AS p{k}_{i}{j}"
                      for k, o in rest.items() for i in span for j in span)
    column = ", ".join(
        f"list_extract([{', '.join('[' + ', '.join(f'p{k}_{i}{j}' for i in span) + ']' for j in span)}], "
        f"list_position({d}, list_max({d}))) AS w{k}"
        for k in rest for d in ["[" + ", ".join(f"abs(p{k}_{i}{i})" for i in span) + "]"])
    length = {k: "sqrt(" + " + ".join(f"w{k}[{i + 1}] ** 2" for i in span) + ")" for k in rest}
    sign = {k: f"CASE WHEN list_max(w{k}) >= -list_min(w{k}) THEN 1 ELSE -1 END" for k in rest}
    unit = ", ".join("[" + ", ".join(f"w{k}[{i + 1}] * ({sign[k]}) / {length[k]}" for i in span) + f"] AS v{k}" for k in rest)
    return f"""{_eigen_sql(columns)},
sorted AS (SELECT c.*, list_reverse_sort([x0, x1, x2, x3]) AS e FROM last, c),
two AS (SELECT *, {two} FROM sorted),
three AS (SELECT {three} FROM two),
picked AS (SELECT {column} FROM three),
vec AS (SELECT {unit} FROM picked)"""


_AXES = [" + ".join(f"v{k}[{i + 1}] * ({c} - m{i}) / d{i}" for i, c in enumerate(_X)) for k in (0, 1)]
ORACLES["pca_biplot_all"] = f"""
WITH RECURSIVE {_vectors_sql(_X)},
ms AS (SELECT {", ".join(f"avg({c}) AS m{i}, stddev_samp({c}) AS d{i}" for i, c in enumerate(_X))} FROM trips),
scores AS (SELECT {_TRIP_KEYS}, {_AXES[0]} AS x, {_AXES[1]} AS y FROM trips, vec, ms),
top AS (SELECT max(x) AS mx, max(y) AS my FROM scores)
""" + "\nUNION ALL\n".join(
    f"SELECT 'arrow' AS kind, '{c}' AS name, round(v0[{i + 1}] * mx, 4) + 0.0 AS x, round(v1[{i + 1}] * my, 4) + 0.0 AS y FROM vec, top"
    for i, c in enumerate(_X)) + f"""
UNION ALL
SELECT 'point', concat_ws('-', {_TRIP_KEYS}), round(x, 4) + 0.0, round(y, 4) + 0.0 FROM scores
WHERE ('0x' || substr(md5(concat_ws(':', '1', {_TRIP_KEYS})), 1, 15))::BIGINT < {int(0.05 * (1 << 60))}"""
