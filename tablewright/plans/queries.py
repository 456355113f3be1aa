"""The registered queries: each takes (spark, sf_dir) and returns a
DataFrame over the driver's tables (or frames Spark derives from them).
Every computed column is aliased to the name its DuckDB oracle uses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.columns import hash60, rounded, to_number
from tablewright.operators import chunked as CH
from tablewright.operators import clean as C
from tablewright.operators import dictionary as DI
from tablewright.operators import metrics as MT
from tablewright.operators import ml as ML
from tablewright.operators import relational as R
from tablewright.operators.prefix import global_rank
from tablewright.operators import sampling as SM
from tablewright.operators import sketches as SK
from tablewright.operators import stats as ST
from tablewright.operators import sufficient as SS
from tablewright.operators import tall_qr as QR
from tablewright.sources import bucketed as BU
from tablewright.sources import files as SRC
from tablewright.sources import standins as SI
from tablewright.session import drop_scratch, scratch_path

TRIP_COLUMNS = ["fare"] + SI.TRIP_FEATURES
TRIP_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _clean(spark, sf_dir) -> DataFrame:
    return C.clean_cases(SI.cases(spark, sf_dir))


# --- sources, shape ---------------------------------------------------------------

def text_scan_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines -> named, typed columns."""
    path = SI.customer_lines(spark, sf_dir)
    lines = SRC.read_lines(spark, path)
    d = C.split_fields(lines, {f"f{i}": i for i in range(len(SI.CUSTOMER_FIELDS))})
    d = C.rename_all(d, SI.CUSTOMER_FIELDS)
    d = C.drop_header_rows(d, "c_name", "c_name")
    d = C.drop_nulls(d, "any")
    d = d.select(F.col("c_custkey").try_cast("bigint").alias("c_custkey"), "c_name",
                 F.col("c_nationkey").try_cast("int").alias("c_nationkey"),
                 F.col("c_acctbal").try_cast("double").alias("c_acctbal"), "c_mktsegment")
    return SRC.settle(d, path)


def sparse_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields 1, 3, 4 and 8-11 of twelve, with
    the city: the seven-column case table."""
    path = SI.case_lines(spark, sf_dir)
    d = C.split_fields(SRC.read_lines(spark, path), SI.CASE_FIELDS)
    d = C.drop_nulls(C.drop_header_rows(d, "state", "state"), "any")
    d = C.drop_sentinel(d, "comparison")
    d = d.withColumn("score", to_number("score_text")).drop("score_text")
    return SRC.settle(d, path)


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV read as an all-double table; text columns become null,
    the numeric ones are kept by position; all-null rows dropped."""
    path = SI.customer_csv(spark, sf_dir)
    d = SRC.read_csv_doubles(spark, path, SI.CUSTOMER_FIELDS)
    d = C.keep_positions(d, [0, 2, 3])
    return SRC.settle(C.drop_nulls(d, "all"), path)


def csv_scan_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV with header, no schema: every column a string."""
    path = SI.customer_csv(spark, sf_dir)
    return SRC.settle(SRC.read_csv(spark, path), path)


def table_shape(spark, sf_dir):
    """Rows and columns of the cleaned case table."""
    return ST.table_shape(_clean(spark, sf_dir))


def schema_listing(spark, sf_dir):
    """Columns, types and non-null counts of the cleaned case table."""
    return ST.schema_profile(_clean(spark, sf_dir))


def head_rows(spark, sf_dir):
    """The first 5 rows in a stated order."""
    d = _clean(spark, sf_dir)
    return ST.head_rows(d, 5, ["state", "hospital", "measure_name", "measure_id",
                               "comparison", "score"])


# --- cleaning ------------------------------------------------------------------

def clean_cases(spark, sf_dir):
    """F2, F4, P3, P6."""
    return _clean(spark, sf_dir)


def clean_cases_numeric(spark, sf_dir):
    """P6 as written (``cast("numeric")`` = decimal(10,0), fractions rounded),
    returned as double."""
    d = C.clean_cases(SI.cases(spark, sf_dir), kind="decimal(10,0)")
    return d.withColumn("score", F.col("score").cast("double"))


def numeric_text_cast(spark, sf_dir):
    """P6 on text with fractions: ``numeric`` (decimal(10,0)) rounds, double
    does not."""
    t = SRC.load_table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_acctbal").cast("string").alias("text"))
    return t.select("c_custkey", to_number("text", "decimal(10,0)").cast("double").alias("as_numeric"),
                    to_number("text").alias("as_double"))


def dropna_any(spark, sf_dir):
    """F2."""
    return C.drop_nulls(SI.values_with_nulls(spark, sf_dir), "any")


def dropna_all(spark, sf_dir):
    """F3 over the two nullable columns."""
    return C.drop_nulls(SI.values_with_nulls(spark, sf_dir), "all", ["event_type", "value"])


def _customer_tokens(spark, sf_dir):
    cu = SRC.load_table(spark, sf_dir, "customer")
    lines = cu.select("c_custkey", F.concat_ws("\t", "c_name", "c_mktsegment",
                                               F.col("c_nationkey").cast("string")).alias("value"))
    return C.split_to_array(lines, "value", "\t", "tokens").drop("value")


def token_vocabulary(spark, sf_dir):
    """P7, P8."""
    return C.token_vocabulary(_customer_tokens(spark, sf_dir))


def token_one_hot(spark, sf_dir):
    """P9 over the whole vocabulary, sparse: the flags that are true."""
    return C.token_flags_sparse(_customer_tokens(spark, sf_dir), ["c_custkey"])


def token_numbers(spark, sf_dir):
    """The vocabulary with dense numbers and the rows of each token."""
    return DI.token_dictionary(_customer_tokens(spark, sf_dir))


def token_vectors(spark, sf_dir):
    """Every customer's tokens as a sparse vector over the dictionary
    of the customers of even keys; tokens it lacks are counted."""
    t = _customer_tokens(spark, sf_dir)
    v = DI.sparse_vectors(t, ["c_custkey"], SRC.stored(DI.token_dictionary(t.where("c_custkey % 2 = 0"))))
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return v.select("c_custkey", text("indices").alias("indices"), text("counts").alias("counts"), "n_unknown")


# --- rejected lines ----------------------------------------------------------------

def _damaged_csv(spark, sf_dir):
    kinds = {"c_custkey": T.LongType(), "c_nationkey": T.IntegerType(), "c_acctbal": T.DoubleType()}
    schema = T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in SI.CUSTOMER_FIELDS])
    return SRC.read_csv_checked(spark, SI.damaged_lines(spark, sf_dir), schema, header=False)


def csv_accepted_rows(spark, sf_dir):
    """The rows of a damaged file that fit their types."""
    return _damaged_csv(spark, sf_dir)[0]


def csv_rejected_lines(spark, sf_dir):
    """The other lines, with the reason."""
    return _damaged_csv(spark, sf_dir)[1]


def line_faults(spark, sf_dir):
    """Lines of a damaged text file by fault, with the sum of the
    balances that could be read."""
    lines = SRC.read_lines(spark, SI.damaged_lines(spark, sf_dir, "\t"))
    d = C.checked_fields(lines, {c: i for i, c in enumerate(SI.CUSTOMER_FIELDS)}, {"c_nationkey": "int", "c_acctbal": "double"})
    return d.groupBy("reason").agg(F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


# --- statistics ------------------------------------------------------------------

def merged_sketches(spark, sf_dir):
    """Sketches for each event type and day, stored, merged over the
    days: quartiles and distinct users by type. The answer is whether ranks and
    counts are within twice the promised bound and four standard errors."""
    e = SRC.load_table(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("day"), "user_id", "value")
    merged = SRC.stored(SK.merge_sketches(SK.sketch_table(e, ["event_type", "day"], "value", "user_id"), ["event_type"]))
    est = SRC.stored(SK.quantile_estimates(merged, ["event_type"], [0.25, 0.5, 0.75]))
    users = e.groupBy("event_type").agg(F.count_distinct("user_id").alias("n_users"))
    off = SK.quantile_errors(e, est, ["event_type"], "value").join(users, "event_type")
    return off.select("event_type", "p", "n", "n_users", (F.col("rank_off") <= 2 * SK.rank_error()).alias("rank_holds"),
                      (F.abs(F.col("n_distinct") - F.col("n_users")) <= 4 * SK.count_error() * F.col("n_users")).alias("count_holds"))


def distinct_counts(spark, sf_dir):
    """A2, A3."""
    return ST.distinct_counts(_clean(spark, sf_dir), ["comparison", "hospital", "measure_id"])


def global_mean_median(spark, sf_dir):
    """A4-A7."""
    r = ST.mean_and_medians(_clean(spark, sf_dir), "score")
    return r.select(rounded("mean_value").alias("mean_value"), "median_exact",
                    "median_approx", "median_interp")


def trip_medians(spark, sf_dir):
    """A4-A7 on the fare, where the exact data median and the interpolated one
    differ; the approximate one (A6) by its promise: its rank is within
    n / accuracy of the middle."""
    t = SI.trips(spark, sf_dir).select("fare")
    r = ST.mean_and_medians(t, "fare").collect()[0]
    m, x = F.lit(r["median_approx"]), F.col("fare")
    n, low, upto = F.count(F.lit(1)), F.count_if(x < m), F.count_if(x <= m)
    slack = n / ST.APPROX_ACCURACY + 1
    return t.agg(rounded(F.avg("fare")).alias("mean_fare"),
                 F.lit(r["median_exact"]).alias("median_exact"),
                 F.round(F.lit(r["median_interp"]), 6).alias("median_interp"),
                 ((low - slack <= n / 2) & (upto + slack >= n / 2)).alias("approx_within_bound"))


def quantiles_in_rounds(spark, sf_dir):
    """A5, A7 on five columns with a bound of 5000 rows, so that brackets are
    narrowed in rounds: the path of a table too large to sort."""
    probs = [0.05, 0.25, 0.5, 0.75, 0.95]
    cols = TRIP_COLUMNS
    cont, disc = (ST.exact_column_quantiles(SI.trips(spark, sf_dir), cols, probs, kind=k, max_rows=5000)
                  .select("column", "p", F.round("q", 6).alias(k)) for k in ("cont", "disc"))
    return cont.join(disc, ["column", "p"])


def state_ranking(spark, sf_dir):
    """Each state's place by name, by count and by variance."""
    return R.group_ranks(_clean(spark, sf_dir), "state", "score")


def describe_mixed(spark, sf_dir):
    """A12 on the whole cleaned case table, text and numbers."""
    return ST.describe_mixed(_clean(spark, sf_dir))


def state_stats_by_name(spark, sf_dir):
    """Per state count, mean, median, variance, by name."""
    return ST.group_stats(_clean(spark, sf_dir), "state", "score").orderBy("state")


def state_stats_exact(spark, sf_dir):
    """A8 with A7: per state count, mean, exact interpolated median,
    variance."""
    return ST.group_stats_exact(_clean(spark, sf_dir), "state", "score").orderBy(
        F.desc("variance_score"), "state")


def state_stats_by_variance(spark, sf_dir):
    """The same in SQL over a view, by variance."""
    SRC.register_view(_clean(spark, sf_dir), "cases_clean")
    return SRC.run_sql(spark, f"""
        SELECT state, COUNT(state) AS num_cases, ROUND(AVG(score), 4) AS mean_score,
               CAST(PERCENTILE_APPROX(score, 0.5, {ST.APPROX_ACCURACY}) AS DOUBLE) AS median_score,
               ROUND(VAR_SAMP(score), 2) AS variance_score
        FROM cases_clean GROUP BY state ORDER BY variance_score DESC, state""")


def state_stats_joined(spark, sf_dir):
    """Mean, count, variance per state (one aggregate)."""
    d = R.merged_group_stats(_clean(spark, sf_dir), "state", "score")
    return d.select("state", rounded("mean_score").alias("mean_score"), "count",
                    "var_score").orderBy(F.desc("var_score"), "state")


def most_dispersed_state(spark, sf_dir):
    """A11."""
    return ST.most_dispersed(_clean(spark, sf_dir), "state", "score")


def describe_typed(spark, sf_dir):
    """A12."""
    return ST.describe_columns(SI.trips(spark, sf_dir), TRIP_COLUMNS)


def chosen_statistics(spark, sf_dir):
    """Only the mean and the median of the cleaned score."""
    return ST.summary_selected(_clean(spark, sf_dir), ["score"], ["mean", "50%"])


def summary_quartiles(spark, sf_dir):
    """A13, A14."""
    return ST.summary_quartiles(SI.trips(spark, sf_dir), TRIP_COLUMNS)


def column_profile(spark, sf_dir):
    """A15, A16."""
    return ST.column_profile(SI.trips(spark, sf_dir), TRIP_COLUMNS)


def histogram_equal_width(spark, sf_dir):
    """A17, 10 equal bins."""
    return ST.histogram_equal_width(SI.values(spark, sf_dir), "value", 10)


def histogram_fixed_width(spark, sf_dir):
    """A17, bins of width 25."""
    return ST.histogram_fixed_width(SI.values(spark, sf_dir), "value", 25.0)


def column_correlations(spark, sf_dir):
    """A18."""
    return ST.correlations(SI.trips(spark, sf_dir),
                           [("fare", "l_quantity"), ("l_discount", "l_tax"), ("fare", "p_size")])


# --- ranking, filters, joins -----------------------------------------------------

def _state_scores(spark, sf_dir):
    """The two columns that the joins below need, stored once for their
    several passes."""
    return SRC.stored(_clean(spark, sf_dir).select("state", "score"))


def top5_states(spark, sf_dir):
    """T3."""
    return R.top_groups(_clean(spark, sf_dir), "state", 5)


def above_median_dataframe(spark, sf_dir):
    """F5."""
    return R.above_median(_state_scores(spark, sf_dir), "score", ["state", "score"])


def above_constant(spark, sf_dir):
    """F6."""
    return C.above(_clean(spark, sf_dir), "score", 1).select("state", "score")


def above_median_subquery(spark, sf_dir):
    """scalar subquery in SQL."""
    SRC.register_view(_state_scores(spark, sf_dir), "cases_clean")
    return SRC.run_sql(spark, f"""
        SELECT state, score FROM cases_clean
        WHERE score > (SELECT PERCENTILE_APPROX(score, 0.5, {ST.APPROX_ACCURACY}) FROM cases_clean)""")


def join_all_states(spark, sf_dir):
    """Every state's count joined to the rows above the median."""
    d = _state_scores(spark, sf_dir)
    return R.join_on_key(R.ranked_group_counts(d, "state", "count"),
                         R.above_median(d, "score", ["state", "score"]), "state")


def join_all_states_bucketed(spark, sf_dir):
    """J1, A10 over a table bucketed by state and salt: counts and join move
    no row of it."""
    t = BU.write_bucketed(_clean(spark, sf_dir), ["state"], 16, salts=32, columns=["state", "score"],
                          salt_by=["hospital", "measure_id", "measure_name", "score"])
    counts = BU.grouped_bucketed(t, ["state"], {}, salts=32)
    above = t.where(F.col("score") > F.lit(R.median_disc(t, "score")))
    return BU.join_bucketed(above, counts, ["state"], salts=32).select("state", "count", "score")


def order_lines_bucketed(spark, sf_dir):
    """J1, A9 over two tables bucketed by the order: they meet and are grouped
    bucket by bucket."""
    orders = BU.write_bucketed(SRC.load_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 16)
    lines = SRC.load_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
    lines = BU.write_bucketed(lines, ["o_orderkey"], 16)
    per = BU.grouped_bucketed(lines, ["o_orderkey"], {"quantity": "l_quantity"}, "n_lines")
    return per.join(orders, ["o_orderkey"]).select("o_orderkey", "n_lines", F.round("quantity", 4).alias("quantity"), "o_totalprice")


def join_condition(spark, sf_dir):
    """Top-5 states joined by condition to rows with score > 1, both
    keys kept (the right one renamed)."""
    d = _state_scores(spark, sf_dir)
    return R.join_on_condition(R.top_groups(d, "state", 5), C.above(d, "score", 1).select("state", "score"), "state")


def top5_join_above_median(spark, sf_dir):
    """J3, J5 in SQL."""
    SRC.register_view(_state_scores(spark, sf_dir), "cases_clean")
    return R.sql_top_join_above_median(spark, "cases_clean", "state", "score", 5)


def top5_join_above_median_dataframe(spark, sf_dir):
    """J5 in DataFrame form."""
    return R.top_groups_join_above_median(_state_scores(spark, sf_dir), "state", "score", 5)


def outlier_fence(spark, sf_dir):
    """F8 on one skewed column."""
    return C.iqr_fence(SI.values(spark, sf_dir), ["value"])


def outlier_fence_trips(spark, sf_dir):
    """F8, U1 on all five trip columns, each fenced by its own quartiles."""
    return C.iqr_fence(SI.trips(spark, sf_dir), TRIP_COLUMNS)


def _value_and_log(spark, sf_dir):
    return SI.values(spark, sf_dir).withColumn("log_value", F.ln(F.col("value")))


def outlier_fence_columns(spark, sf_dir):
    """F8, U1 on a skewed column and its logarithm, whose fences cut opposite
    ends."""
    d = C.iqr_fence(_value_and_log(spark, sf_dir), ["value", "log_value"])
    return d.select("event_id", "value", F.round("log_value", 6).alias("log_value"))


def median_binarize(spark, sf_dir):
    """P10: fare above its median -> 1, fare dropped."""
    return C.median_label(SI.trips(spark, sf_dir), "fare", "fare_high", drop_source=True)


# --- sampling and splits ----------------------------------------------------------

def _orders(spark, sf_dir):
    return SRC.load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


def hash_sample(spark, sf_dir):
    """M1: exactly 10 % of the orders, seeded."""
    return SM.hash_sample(_orders(spark, sf_dir), "o_orderkey", 0.1, 1000)


def sample_1000(spark, sf_dir):
    """M3: exactly 1000 orders for a plot, seeded, without replacement."""
    return SM.hash_sample(_orders(spark, sf_dir), "o_orderkey", None, 7, size=1000)


def bernoulli_sample(spark, sf_dir):
    """M2: about 10 % of the orders, by hash."""
    return SM.bernoulli_sample(_orders(spark, sf_dir), "o_orderkey", 0.1, 1000)


def sample_with_replacement(spark, sf_dir):
    """M3 with replacement: exactly 1000 numbered draws."""
    return SM.draw_with_replacement(_orders(spark, sf_dir), "o_orderkey", 1000, 5)


def split_exact(spark, sf_dir):
    """M4: exactly 60/20/20 by a seeded hash order."""
    return SM.split_exact(_orders(spark, sf_dir), "o_orderkey", 100).select("o_orderkey", "part")


def split_bucket(spark, sf_dir):
    """M6: 60/20/20 by hash bucket, R's part order."""
    return SM.split_bucket(_orders(spark, sf_dir), ["o_orderkey"], 7000).select("o_orderkey", "part")


def split_random(spark, sf_dir):
    """M5: about 60/20/20 from one hashed label column."""
    return SM.split_random(_orders(spark, sf_dir), ["o_orderkey"], (0.6, 0.2, 0.2), 100).select(
        "o_orderkey", "part")


# --- models ------------------------------------------------------------------

def _standardized(spark, sf_dir, ddof):
    t = SI.trips(spark, sf_dir)
    s = ML.standardize(t, TRIP_COLUMNS, ddof=ddof, keep=TRIP_KEYS)
    return s.select(*TRIP_KEYS, *[rounded(c).alias(c) for c in TRIP_COLUMNS])


def standardize_samp(spark, sf_dir):
    """L1 with the sample sd (R, Spark)."""
    return _standardized(spark, sf_dir, 1)


def standardize_pop(spark, sf_dir):
    """L1 with the population sd (sklearn)."""
    return _standardized(spark, sf_dir, 0)


def _error_flag(spark, sf_dir):
    ev = SI.values(spark, sf_dir)
    return ev.select("event_id", "value",
                     F.when(F.col("event_type") == "error", 1.0).otherwise(0.0).alias("x"))


def _separated(spark, sf_dir):
    """1000 x the error flag + value: two clouds far apart, so that the best two
    clusters are known, but not one point each."""
    return _error_flag(spark, sf_dir).withColumn("z", F.lit(1000.0) * F.col("x") + F.col("value"))


def kmeans_fit(spark, sf_dir):
    """k = 2 on two separated clouds: centres are their means."""
    return ML.kmeans_centres(_separated(spark, sf_dir), ["z"], 2, seed=1, digits=3)


def kmeans_two(spark, sf_dir):
    """L3, L4, U2 for k = 1 and 2 on the separated column: WSS and its share."""
    d = ML.kmeans_elbow(_separated(spark, sf_dir), ["z"], [1, 2], seed=1)
    return d.select("k", F.round("wss", 1).alias("wss"), F.round("r2_pct", 6).alias("r2_pct"))


def cluster_sample(spark, sf_dir):
    """K-means on the standardised features, labels attached to
    the rows (k = 3), a 1000-row sample of them, and each cluster described on
    the original variables."""
    t = SRC.stored(SI.trips(spark, sf_dir))
    scaled = ML.standardize(t, SI.TRIP_FEATURES, ddof=1, keep=TRIP_KEYS + SI.TRIP_FEATURES, suffix="_z")
    _, rows = ML.kmeans_fit(scaled, [f"{c}_z" for c in SI.TRIP_FEATURES], 3, seed=1)
    rows = SRC.stored(rows.select("cluster", *SI.TRIP_FEATURES, hash60(3, *TRIP_KEYS, "l_quantity").alias("row")))
    sample = SM.hash_sample(rows, "row", None, 3, size=1000)
    return ML.cluster_profile(sample, "cluster", SI.TRIP_FEATURES)


def cluster_sample_clouds(spark, sf_dir):
    """L2, L5, P12 on two separated clouds, whose labels are known: labels
    attached to the rows, 1000 of them sampled, each cluster described."""
    _, rows = ML.kmeans_fit(_separated(spark, sf_dir), ["z"], 2, seed=1)
    sample = SM.hash_sample(SRC.stored(rows.select("event_id", "cluster", "value", "x")), "event_id", None, 3, size=1000)
    prof = ML.cluster_profile(sample, "cluster", ["value", "x"])
    return prof.select(F.col("x_mean").alias("x"), "n", "value_mean", "value_min", "value_max")


def _trip_features_scaled(spark, sf_dir):
    t = SRC.stored(SI.trips(spark, sf_dir).select(*SI.TRIP_FEATURES))
    return ML.standardize(t, SI.TRIP_FEATURES, ddof=1, keep=[])


def kmeans_elbow(spark, sf_dir):
    """WSS for k = 1..9 on the standardised features."""
    return ML.kmeans_elbow(_trip_features_scaled(spark, sf_dir), SI.TRIP_FEATURES,
                           list(range(1, 10)), seed=1).select("k", "wss")


def kmeans_r2(spark, sf_dir):
    """Between / total sum of squares in percent, k = 1..10."""
    return ML.kmeans_elbow(_trip_features_scaled(spark, sf_dir), SI.TRIP_FEATURES,
                           list(range(1, 11)), seed=1).select("k", "r2_pct")


def kmeans_balance(spark, sf_dir):
    """L3, L4, U2 by what must hold for every fit: the sum of squares within
    the clusters and that between their centres, from centres and sizes, make
    the total, and no row is lost."""
    d = ML.kmeans_elbow(_trip_features_scaled(spark, sf_dir), SI.TRIP_FEATURES, [1, 2, 3, 5, 8], seed=1)
    gap = F.abs(F.col("tss") - F.col("wss") - F.col("between")) / F.col("tss")
    return d.select("k", "n", F.round("tss", 2).alias("tss"), F.round(gap, 9).alias("gap"),
                    ((F.col("wss") > 0) & (F.col("wss") <= F.col("tss"))).alias("within"))


def cluster_profile(spark, sf_dir):
    """K-means labels attached to rows, clusters described on the
    original variables; each cluster named by its mean flag."""
    d = _separated(spark, sf_dir)
    _, labelled = ML.kmeans_fit(d, ["z"], 2, seed=1)
    prof = ML.cluster_profile(labelled, "cluster", ["value", "x"])
    return prof.select(F.round("x_mean", 4).alias("x"), "n", "value_mean", "value_min", "value_max")


def pca_explained(spark, sf_dir):
    """L6, L7 on two columns (closed form: (1 +- |r|) / 2)."""
    return ML.pca_explained(SI.trips(spark, sf_dir), ["fare", "l_quantity"])


def pca_explained_all(spark, sf_dir):
    """L6, L7 on the four features."""
    return ML.pca_explained(SI.trips(spark, sf_dir), SI.TRIP_FEATURES)


def pca_identities(spark, sf_dir):
    """L6, L7 on the four features by what must hold: the eigenvalues sum to
    the trace, and their squares to the sum of squared correlations."""
    d = ML.pca_explained(SI.trips(spark, sf_dir), SI.TRIP_FEATURES, digits=12)
    e = F.col("eigenvalue")
    return d.agg(F.round(F.sum(e), 6).alias("trace"), F.round(F.sum(e * e), 6).alias("squares"),
                 F.round(F.max("cumulative"), 6).alias("cumulative"))


def pca_explained_qr(spark, sf_dir):
    """L6, L7 on the four features from partition QR factors."""
    return QR.pca_explained_qr(SI.trips(spark, sf_dir), SI.TRIP_FEATURES)


def pca_loadings_qr(spark, sf_dir):
    """What the loadings must rebuild: for each pair of features the sum
    over components of eigenvalue and loadings (their correlation), and the
    product of their loadings (1 with itself, else 0)."""
    d = QR.pca_loadings_qr(SI.trips(spark, sf_dir), SI.TRIP_FEATURES)
    other = d.select("component", F.col("name").alias("other"), F.col("loading").alias("l2"))
    product = F.col("loading") * F.col("l2")
    return d.join(other, "component").groupBy("name", "other").agg(
        (F.round(F.sum(F.col("eigenvalue") * product), 6) + 0.0).alias("correlation"),
        (F.round(F.sum(product), 6) + 0.0).alias("product"))


def linreg_qr(spark, sf_dir):
    """The coefficient table from partition QR factors, four features."""
    return _rounded_terms(QR.linreg_table_qr(SI.trips(spark, sf_dir), SI.TRIP_FEATURES, "fare"))


def pca_scores(spark, sf_dir):
    """Scores of all rows on two standardised columns."""
    return ML.pca_scores(SI.trips(spark, sf_dir), ["fare", "l_quantity"], TRIP_KEYS)


def pca_biplot(spark, sf_dir):
    """Scores of a 10 % hash sample and scaled loadings."""
    return ML.pca_biplot(SI.trips(spark, sf_dir), ["fare", "l_quantity"], TRIP_KEYS)


def pca_biplot_all(spark, sf_dir):
    """L8 on the four trip features."""
    return ML.pca_biplot(SI.trips(spark, sf_dir), SI.TRIP_FEATURES, TRIP_KEYS, 0.05)


def linreg_coefficients(spark, sf_dir):
    """Fare on two features: estimate, s.e., t."""
    return ML.linreg_coefficients(SI.trips(spark, sf_dir), ["l_quantity", "l_discount"],
                                  "fare").select(
        "term", F.round("estimate", 4).alias("estimate"),
        F.round("std_error", 4).alias("std_error"), F.round("t_value", 4).alias("t_value"))


def linreg_summary(spark, sf_dir):
    """The full coefficient table with p-values, four features."""
    return _rounded_terms(ML.linreg_coefficients(SI.trips(spark, sf_dir), SI.TRIP_FEATURES, "fare"))


def _rounded_terms(t):
    return t.select("term", *[F.round(c, 4).alias(c) for c in ("estimate", "std_error", "t_value")],
                    F.round("p_value", 6).alias("p_value"))


def merged_moments(spark, sf_dir):
    """Moments of each line number's trips, stored, and merged over
    the line numbers without the trips: mean and covariances with the fare."""
    columns = ["fare", *SI.TRIP_FEATURES]
    t = SI.trips(spark, sf_dir).select("l_linenumber", *columns)
    parts = SRC.stored(SS.moments(t, columns, ["l_linenumber"]))
    m = SS.merge_moments(parts, len(columns))
    return m.select(F.posexplode("mean").alias("i", "mean"), "n", "cross").select(
        F.element_at(F.lit(columns), F.col("i") + 1).alias("name"), "n", F.round("mean", 6).alias("mean"),
        F.round(F.element_at("cross", F.col("i") + 1) / F.col("n"), 4).alias("covar_fare"))


#: Keys of orders in a chunk of ``chunked_linreg``.
CHUNK_KEYS = 1000


def chunked_linreg(spark, sf_dir):
    """Fare on four features over chunks of orders. The first half
    of the chunks makes a stored state; a second call adds the others without
    reading the first again, a third finds nothing new. Then the fit."""
    columns = ["fare", *SI.TRIP_FEATURES]
    t = SI.trips(spark, sf_dir).withColumn("chunk", F.floor(F.col("l_orderkey") / CHUNK_KEYS))
    path = scratch_path(spark, "chunk-state")
    last = t.agg(F.max("chunk")).first()[0] or 0
    for new in (F.col("chunk") <= last // 2, F.col("chunk") > last // 2, F.col("chunk") == last):
        state = CH.add_chunks(t.where(new), columns, "chunk", path)
    fit, chunks = CH.fit_chunks(state, columns, SI.TRIP_FEATURES, "fare"), state.count()
    drop_scratch(spark, path)
    d = spark.createDataFrame(fit.table(), "term string, estimate double, std_error double, t_value double, p_value double")
    return _rounded_terms(d).withColumn("chunks", F.lit(chunks).cast("long"))


def chunked_logit(spark, sf_dir):
    """A logistic fit of two passes, stored, and gone on with until it
    has converged: value above its median on the 0/1 error flag."""
    d = SRC.stored(_binary(spark, sf_dir))
    path = scratch_path(spark, "logit-state")
    CH.logistic_passes(d, ["x"], "y", path, passes=2)
    fit = CH.logistic_passes(d, ["x"], "y", path, passes=20)
    drop_scratch(spark, path)
    t = spark.createDataFrame(fit.table(), "term string, estimate double, std_error double")
    return t.select("term", F.round("estimate", 6).alias("estimate"))


def logit_score_equations(spark, sf_dir):
    """L15 on four features by what must hold: at the fit the residuals are
    orthogonal to every feature and sum to 0."""
    d = _trip_labels(spark, sf_dir)
    path = scratch_path(spark, "logit-state")
    fit = CH.logistic_passes(d, SI.TRIP_FEATURES, "y", path, passes=25)
    drop_scratch(spark, path)
    e = CH.score_equations(d, SI.TRIP_FEATURES, "y", fit.coefficients)
    return e.select("term", "n", (F.round("score", 6) + 0.0).alias("score"))


def logit_solver_equations(spark, sf_dir):
    """As ``logit_score_equations``, for the coefficients of ``logistic_fit``,
    the model that ``logit_validation`` judges."""
    d = _trip_labels(spark, sf_dir)
    m = ML.logistic_fit(d, SI.TRIP_FEATURES, "y")
    e = CH.score_equations(d, SI.TRIP_FEATURES, "y", [*m.coefficients.toArray(), m.intercept])
    return e.select("term", "n", (F.round("score", 4) + 0.0).alias("score"))


def _trip_labels(spark, sf_dir):
    t = SRC.stored(SI.trips(spark, sf_dir).select("fare", *SI.TRIP_FEATURES))
    t = C.median_label(t, "fare", "y", drop_source=True)
    return SRC.stored(ML.standardize(t, SI.TRIP_FEATURES, ddof=1))


def linreg_significance(spark, sf_dir):
    """T and, from its p value, whether a term is significant at 1 %."""
    t = ML.linreg_coefficients(SI.trips(spark, sf_dir), ["l_quantity", "l_discount"], "fare")
    return t.select("term", F.round("t_value", 4).alias("t_value"),
                    (F.col("p_value") < 0.01).alias("significant"))


def linreg_validation(spark, sf_dir):
    """Two-feature fit on the training part, prediction
    and metrics on the validation part."""
    t = SM.split_bucket(SI.trips(spark, sf_dir), TRIP_KEYS, 7000)
    features = ["l_quantity", "l_discount"]
    model = ML.linreg_fit(t.filter("part = 'train'"), features, "fare")
    p = ML.predict(model, t.filter("part = 'validation'"), features)
    return MT.regression_metrics(p, "fare", "prediction")


def fenced_linreg(spark, sf_dir):
    """F8, L1, M6, L9, L11-L14 in one: values and their logarithms fenced, the
    value standardised, split, fitted on the error flag, judged on validation."""
    d = C.iqr_fence(_value_and_log(spark, sf_dir), ["value", "log_value"])
    d = d.select("event_id", "value", F.when(F.col("event_type") == "error", 1.0).otherwise(0.0).alias("x"))
    d = ML.standardize(d, ["value"], ddof=1)
    d = SM.split_bucket(d, ["event_id"], 7000)
    model = ML.linreg_fit(d.filter("part = 'train'"), ["x"], "value")
    p = ML.predict(model, d.filter("part = 'validation'"), ["x"])
    return MT.regression_metrics(p, "value", "prediction")


def glm_gaussian(spark, sf_dir):
    """Gaussian GLM: coefficients, deviance ratio, AIC."""
    t = ML.glm_table(SI.trips(spark, sf_dir), ["l_quantity", "l_discount"], "fare", "gaussian")
    return t.filter(F.col("term").isin("l_quantity", "l_discount", "(intercept)",
                                       "deviance_ratio", "aic")).select(
        "term", F.when(F.col("term") == "aic", F.round("estimate", 1))
                 .when(F.col("term") == "deviance_ratio", F.round("estimate", 6))
                 .otherwise(F.round("estimate", 4)).alias("estimate"))


def _priced(spark, sf_dir):
    li = SRC.load_table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice")
    pa = SRC.load_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return li.join(pa, li.l_partkey == pa.p_partkey, "inner").select(
        F.col("l_extendedprice").alias("y"),
        (F.col("l_quantity") * F.col("p_retailprice")).alias("p"))


def regression_metrics(spark, sf_dir):
    """L12-L14 on (price, quantity x list price)."""
    return MT.regression_metrics(_priced(spark, sf_dir), "y", "p")


def _binary(spark, sf_dir):
    d = _error_flag(spark, sf_dir)
    return C.median_label(d, "value", "y")


def logit_coefficients(spark, sf_dir):
    """L15 with P10: value above its median on the 0/1 error flag."""
    t = ML.glm_table(_binary(spark, sf_dir), ["x"], "y", "binomial", "logit")
    return t.filter(F.col("term").isin("x", "(intercept)", "deviance", "aic")).select(
        "term", F.round("estimate", 6).alias("estimate"))


def _scored(spark, sf_dir):
    ev = SI.values(spark, sf_dir)
    return ev.select("event_id", F.when(F.col("event_type") == "error", 1).otherwise(0)
                     .cast("int").alias("label"), F.col("value").alias("score"))


def classify_threshold(spark, sf_dir):
    """L16."""
    return MT.classify(_scored(spark, sf_dir), "score", 50.0).select("event_id", "label",
                                                                     "prediction")


def confusion_matrix(spark, sf_dir):
    """L17, A19, A20."""
    return MT.confusion(MT.classify(_scored(spark, sf_dir), "score", 50.0), "label", "prediction")


def accuracy_precision(spark, sf_dir):
    """L18, L19."""
    return MT.accuracy_precision(MT.classify(_scored(spark, sf_dir), "score", 50.0),
                                 "label", "prediction")


def roc_auc(spark, sf_dir):
    """L20."""
    return MT.roc_auc(_scored(spark, sf_dir), "label", "score")


def roc_curve(spark, sf_dir):
    """The points of the ROC curve at all distinct scores."""
    d = MT.roc_curve(_scored(spark, sf_dir), "label", "score")
    return d.select("score", "tp", "fp", F.round("tpr", 9).alias("tpr"), F.round("fpr", 9).alias("fpr"))


def trip_ranks(spark, sf_dir):
    """T1, T2, A10 for rows: every trip's place by fare among its line
    number's, the hot ones split over tasks."""
    t = SI.trips(spark, sf_dir).select(*TRIP_KEYS, "fare")
    return global_rank(t, [F.col("fare").desc(), *TRIP_KEYS], by=["l_linenumber"], name="place")


def logit_validation(spark, sf_dir):
    """L15-L20 end to end: fare above its median (P10) on the standardised
    trip features; logistic fit on the training part, probability > 0.5 on
    the test part, then accuracy, precision, recall and AUC."""
    t = C.median_label(SRC.stored(SI.trips(spark, sf_dir)), "fare", "y", drop_source=True)
    t = ML.standardize(t, SI.TRIP_FEATURES, ddof=1)
    t = SM.split_bucket(t, TRIP_KEYS, 7000)
    train = t.filter(F.col("part") == "train")
    test = t.filter(F.col("part") == "test")
    model = ML.logistic_fit(train, SI.TRIP_FEATURES, "y")
    return _judged(ML.predict_probability(model, test, SI.TRIP_FEATURES, "p1").select("y", "p1"))


def _judged(scored):
    """One row: counts, accuracy, precision, recall at 0.5, and AUC; the scored
    rows are held while they are read."""
    with ML.held(scored) as s:
        auc = MT.roc_auc(s, "y", "p1").collect()[0]["auc"]
        row = MT.accuracy_precision(MT.classify(s, "p1", 0.5), "y", "prediction").collect()[0]
    spark = scored.sparkSession
    return spark.createDataFrame(
        [(*row, auc)], "n bigint, tp bigint, tn bigint, fp bigint, fn bigint, accuracy double, "
                       "precision double, recall double, auc double")


def _flag_parts(spark, sf_dir):
    """Value above the exact median, on the error flag, by hash bucket."""
    d = SM.split_bucket(_binary(spark, sf_dir), ["event_id"], 7000)
    return d.filter("part = 'train'"), d.filter("part = 'test'")


def logit_validation_flag(spark, sf_dir):
    """L15-L20 end to end on one 0/1 feature, whose fit is known."""
    train, test = _flag_parts(spark, sf_dir)
    model = ML.logistic_fit(train, ["x"], "y")
    return _judged(ML.predict_probability(model, test, ["x"], "p1").select("y", "p1"))


def logistic_sweep(spark, sf_dir):
    """AUC on the test part for several strengths."""
    train, test = _flag_parts(spark, sf_dir)
    return ML.logistic_sweep(train, test, ["x"], "y", [0.0, 0.01, 0.1])


def regularization_sweep(spark, sf_dir):
    """Ridge strengths on the training part, scored on validation: one
    scan of the trips for all of them."""
    t = SM.split_bucket(SI.trips(spark, sf_dir), TRIP_KEYS, 7000)
    return SS.sweep(t, "part", "train", "validation", SI.TRIP_FEATURES, "fare", [0.0, 0.01, 0.1, 1.0, 10.0])


def ridge_sweep(spark, sf_dir):
    """L21 with one feature, whose ridge fit is known: RMSE and R2 on the
    validation part."""
    t = SM.split_bucket(SI.trips(spark, sf_dir), TRIP_KEYS, 7000)
    return SS.sweep(t, "part", "train", "validation", ["l_quantity"], "fare", [0.0, 100.0, 10000.0])


def elastic_sweep(spark, sf_dir):
    """L21 with half of the penalty on the coefficients' size (the lasso's),
    one feature: the fit is a soft threshold."""
    t = SM.split_bucket(SI.trips(spark, sf_dir), TRIP_KEYS, 7000)
    return SS.sweep(t, "part", "train", "validation", ["l_quantity"], "fare", [0.0, 100.0, 5000.0, 50000.0], elastic=0.5)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in [
        text_scan_split, csv_scan, csv_scan_strings, table_shape, schema_listing, head_rows,
        clean_cases, clean_cases_numeric, dropna_any, dropna_all, token_vocabulary, token_one_hot,
        distinct_counts, global_mean_median, state_stats_by_name, state_stats_exact,
        state_stats_by_variance,
        state_stats_joined, most_dispersed_state, describe_typed, chosen_statistics,
        summary_quartiles,
        column_profile, histogram_equal_width, histogram_fixed_width, column_correlations,
        top5_states, above_median_dataframe, above_constant, above_median_subquery,
        join_all_states, join_condition, top5_join_above_median,
        top5_join_above_median_dataframe, outlier_fence, outlier_fence_trips,
        median_binarize, hash_sample, sample_1000, bernoulli_sample, sample_with_replacement, split_exact, split_bucket,
        split_random, standardize_samp, standardize_pop, kmeans_fit, kmeans_elbow,
        kmeans_r2, cluster_profile, pca_explained, pca_explained_all, pca_biplot,
        linreg_coefficients, linreg_summary, glm_gaussian, regression_metrics,
        logit_coefficients, classify_threshold, confusion_matrix, accuracy_precision,
        roc_auc, logit_validation, regularization_sweep,
        sparse_fields, numeric_text_cast, trip_medians, quantiles_in_rounds, state_ranking,
        describe_mixed, outlier_fence_columns, kmeans_two, cluster_sample, pca_identities,
        pca_scores, pca_biplot_all, linreg_significance, linreg_validation, fenced_linreg,
        logit_validation_flag, logistic_sweep, ridge_sweep,
        kmeans_balance, cluster_sample_clouds, merged_moments, elastic_sweep, chunked_linreg, chunked_logit,
        logit_score_equations, logit_solver_equations, roc_curve, trip_ranks,
        token_numbers, token_vectors, csv_accepted_rows, csv_rejected_lines, line_faults, merged_sketches,
        join_all_states_bucketed, order_lines_bucketed, pca_explained_qr, pca_loadings_qr, linreg_qr,
    ]
}
