"""Edge frames of FIXTURES.md section 4, one test per guard."""

import pytest
from pyspark.sql import functions as F

from tablewright.operators import clean as C
from tablewright.operators import metrics as MT
from tablewright.operators import ml as ML
from tablewright.operators import relational as R
from tablewright.operators import stats as ST


def test_short_line_gives_null(spark):
    df = spark.createDataFrame([("a\tb\tc",), ("",)], "value string")
    out = C.split_fields(df, {"first": 0, "third": 2, "twelfth": 11}).collect()
    assert out[0]["first"] == "a" and out[0]["third"] == "c" and out[0]["twelfth"] is None
    assert out[1]["first"] == "" and out[1]["third"] is None


def test_dirty_score_cast(spark):
    df = spark.createDataFrame([("3.7",), ("Not Available",), ("",), (None,)], "s string")
    dec = [r["s"] for r in C.cast_number(df, "s", "decimal(10,0)").collect()]
    dbl = [r["s"] for r in C.cast_number(df, "s", "double").collect()]
    assert [None if v is None else int(v) for v in dec] == [4, None, None, None]
    assert dbl == [3.7, None, None, None]


def test_repeated_header_dropped(spark):
    df = spark.createDataFrame([("hospital",), ("A",), ("B",), ("hospital",), (None,)], "h string")
    assert [r["h"] for r in C.drop_header_rows(df, "h", "hospital").collect()] == ["A", "B"]


def test_blank_is_not_null(spark):
    df = spark.createDataFrame([("",), (" ",), (None,)], "s string")
    assert C.drop_nulls(df).count() == 2


def test_any_versus_all(spark):
    df = spark.createDataFrame([(None, None), (1, None), (2, 3)], "a int, b int")
    assert C.drop_nulls(df, "any").count() == 1
    assert C.drop_nulls(df, "all").count() == 2


def test_fence_keeps_bounds(spark):
    # q25 = 2, q75 = 4 for 0..6 -> fence [-1, 7]
    vals = [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, -1.0, 7.0, -1.0001, 7.0001]
    base = [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    lo, hi = C.iqr_bounds(df, ["x"])["x"]
    kept = sorted(r["x"] for r in C.iqr_fence(df, ["x"]).collect())
    assert all(lo <= v <= hi for v in kept)
    assert kept == sorted(v for v in vals if lo <= v <= hi)
    # bounds computed from the column's own values (both ends on the fence kept)
    df2 = spark.createDataFrame([(v,) for v in base + [-3.0, 9.0]], "x double")
    lo2, hi2 = C.iqr_bounds(df2, ["x"])["x"]
    on_fence = spark.createDataFrame([(v,) for v in base + [lo2, hi2, lo2 - 1e-9, hi2 + 1e-9]], "x double")
    got = sorted(r["x"] for r in on_fence.filter((F.col("x") >= lo2) & (F.col("x") <= hi2)).collect())
    assert lo2 in got and hi2 in got and (lo2 - 1e-9) not in got


def test_median_label_ties(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (3.0,)], "x double")
    assert [r["y"] for r in C.median_label(df, "x", "y").orderBy("x").collect()] == [0, 0, 0, 1]


def test_even_count_medians(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    r = ST.mean_and_medians(df, "x").collect()[0]
    assert r["median_exact"] == 2.0 and r["median_approx"] == 2.0 and r["median_interp"] == 2.5


def test_one_row_group(spark):
    df = spark.createDataFrame([("A", 1.0), ("A", 3.0), ("B", 5.0)], "state string, score double")
    rows = {r["state"]: r for r in ST.group_stats(df, "state", "score").collect()}
    assert rows["B"]["num_cases"] == 1 and rows["B"]["variance_score"] is None
    assert rows["A"]["variance_score"] == 2.0


def test_tie_at_the_cut(spark):
    data = [("A", 6), ("B", 5), ("C", 4), ("D", 3), ("F", 2), ("E", 2)]
    df = spark.createDataFrame([(s,) for s, n in data for _ in range(n)], "state string")
    top = [r["state"] for r in R.top_groups(df, "state", 5).collect()]
    assert top == ["A", "B", "C", "D", "E"]


def test_empty_bin(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (10.0,)], "x double")
    h = ST.histogram_equal_width(df, "x", 5).orderBy("bin").collect()
    assert [r["n"] for r in h] == [2, 0, 0, 0, 1]


def test_constant_column_no_divide_by_zero(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 2.0), (5.0, 3.0)], "x double, y double")
    h = ST.histogram_equal_width(df, "x", 5).collect()
    assert len(h) == 1 and h[0]["n"] == 3
    assert [r["x"] for r in ML.standardize(df, ["x"]).collect()] == [0.0, 0.0, 0.0]
    assert ST.correlations(df, [("x", "y")]).collect()[0]["corr"] is None
    m = MT.regression_metrics(df.withColumn("p", F.col("x")), "x", "p").collect()[0]
    assert m["r2"] is None and m["r2_corr"] is None


def test_one_class(spark):
    df = spark.createDataFrame([(1, 0.2, 1), (1, 0.7, 0), (1, 0.9, 1)], "y int, s double, p int")
    assert MT.roc_auc(df, "y", "s").collect()[0]["auc"] is None
    r = MT.accuracy_precision(df, "y", "p").collect()[0]
    assert r["accuracy"] == pytest.approx(2 / 3, abs=1e-6) and r["precision"] == 1.0


def test_nobody_predicted_positive(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y int, p int")
    r = MT.accuracy_precision(df, "y", "p").collect()[0]
    assert r["precision"] is None and r["accuracy"] == 0.5


def test_confusion_fills_empty_cells(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (0, 1)], "y int, p int")
    cells = {(r["y"], r["p"]): (r["n"], r["pct"]) for r in MT.confusion(df, "y", "p").collect()}
    assert cells == {(0, 0): (0, 0.0), (0, 1): (1, 33.3), (1, 0): (0, 0.0), (1, 1): (2, 66.7)}


def test_auc_rank_sum_with_ties(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.8), (0, 0.1), (0, 0.5), (1, 0.5)]
    df = spark.createDataFrame(rows, "y int, s double")
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    want = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert MT.roc_auc(df, "y", "s").collect()[0]["auc"] == pytest.approx(want, abs=1e-6)


def test_schema_profile_and_shape(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0)], "s string, x double")
    prof = {r["column_name"]: r for r in ST.schema_profile(df).collect()}
    assert prof["s"]["non_null"] == 1 and prof["x"]["data_type"] == "double"
    sh = ST.table_shape(df).collect()[0]
    assert (sh["n_rows"], sh["n_cols"]) == (2, 2)


def test_keep_positions_and_rename(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    assert C.keep_positions(df, [0, 2]).columns == ["a", "c"]
    assert C.keep_positions(df, [0, 2], drop=True).columns == ["b", "d"]
    assert C.rename_all(df, ["w", "x", "y", "z"]).columns == ["w", "x", "y", "z"]


def test_median_label_of_null_is_null(spark):
    from tablewright.operators.clean import median_label
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    assert {r["x"]: r["label"] for r in median_label(df, "x").collect()} == {1.0: 0, None: None, 3.0: 1}


def test_fixed_width_histogram_lists_gaps_once(spark):
    from tablewright.operators.stats import histogram_fixed_width
    df = spark.createDataFrame([(1.0,), (2.0,), (1e9,), (None,)], "x double")
    got = sorted(tuple(r) for r in histogram_fixed_width(df, "x", 25.0).collect())
    assert got == [(0, 1, 0.0, 2), (1, 39_999_999, 25.0, 0), (40_000_000, 1, 1e9, 1)]
    assert histogram_fixed_width(df.filter("x > 5e9"), "x", 25.0).count() == 0


def test_describe_mixed_types(spark):
    from tablewright.operators.stats import describe_mixed
    df = spark.createDataFrame([("b", 2, None), ("a", 4, None), (None, None, None)], "t string, n int, z double")
    got = {r["column"]: tuple(r)[1:] for r in describe_mixed(df).collect()}
    assert got == {"t": (2, None, None, "a", "b"), "n": (2, 3.0, 1.4142, "2.0", "4.0"), "z": (0, None, None, None, None)}


def test_sparse_flags_keep_every_token(spark):
    from tablewright.operators.clean import token_flags_sparse
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, []), (3, None)], "k int, tokens array<string>")
    assert sorted((r.k, r.token) for r in token_flags_sparse(df, ["k"]).collect()) == [(1, "a"), (1, "b")]


def test_biplot_is_the_same_in_any_partitioning(spark):
    from tablewright.operators import ml as ML
    from tablewright.sources import standins as SI
    t = SI.trips(spark, "/root/testdata/sf0.001")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    runs = [sorted(map(tuple, ML.pca_biplot(t.repartition(n), ["fare", "l_quantity"], keys, 0.004).collect())) for n in (1, 2, 8)]
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) > 2


def test_queries_leave_nothing_cached(spark):
    import __spark_entry__ as E
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    for q in ("summary_quartiles", "column_profile", "hash_sample", "split_exact"):
        E.queries()[q](spark, "/root/testdata/sf0.001").count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before


def test_describe_columns_on_text_is_null_not_an_error(spark):
    from tablewright.operators.stats import describe_columns
    df = spark.createDataFrame([("x", 1.0), ("2", 3.0)], "t string, n double")
    got = {r["column"]: (r["count"], r["mean"]) for r in describe_columns(df, ["t", "n"]).collect()}
    assert got == {"t": (1, 2.0), "n": (2, 2.0)}
