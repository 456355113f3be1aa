"""A key holding over a third of the rows, with broadcasts switched off so
joins must shuffle; and the file sources on dirty input."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewright.operators import relational as R
from tablewright.operators import stats as ST
from tablewright.operators.order_stats import exact_quantiles
from tablewright.sources import files as SRC


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(3)
    n = 9000
    state = np.where(rng.random(n) < 0.4, "HOT", rng.choice(list("ABCDEFGH"), n))
    score = rng.integers(0, 40, n).astype(float)
    pdf = pd.DataFrame({"state": state, "score": score})
    return pdf, spark.createDataFrame(pdf).repartition(6)


def test_group_stats_with_hot_key(skewed, no_broadcast):
    pdf, df = skewed
    got = {r["state"]: r for r in ST.group_stats(df, "state", "score").collect()}
    want = pdf.groupby("state")["score"].agg(["count", "mean", "var"])
    assert (pdf.state == "HOT").mean() > 1 / 3
    for s, row in want.iterrows():
        assert got[s]["num_cases"] == row["count"]
        assert got[s]["mean_score"] == pytest.approx(round(row["mean"], 4), abs=1e-9)
        assert got[s]["variance_score"] == pytest.approx(round(row["var"], 2), abs=1e-9)


def test_join_with_hot_key_is_whole(skewed, no_broadcast):
    pdf, df = skewed
    counts = R.ranked_group_counts(df, "state", "count")
    rows = df.filter(F.col("score") > 20).select("state", "score")
    out = R.join_on_key(counts, rows, "state")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
    assert out.count() == int((pdf.score > 20).sum())
    hot = out.filter(F.col("state") == "HOT").select("count").distinct().collect()
    assert hot[0]["count"] == int((pdf.state == "HOT").sum())


def test_grouped_median_with_hot_key(skewed):
    pdf, df = skewed
    got = {r["state"]: r["q"] for r in
           exact_quantiles(df, "score", [0.5], by=["state"], max_rows=500).collect()}
    for s, v in pdf.groupby("state")["score"]:
        assert got[s] == pytest.approx(float(np.percentile(v, 50)), abs=1e-9)


def test_csv_sources_on_dirty_input(spark):
    lines = spark.createDataFrame([("a,b,c",), ("1,x,2.5",), ("3,,",), ("5,7,oops",)], "value string")
    path = SRC.write_lines(lines.coalesce(1), "dirty-csv")  # one file: one header line
    strings = SRC.read_csv(spark, path).orderBy("a").collect()
    assert [tuple(r) for r in strings] == [("1", "x", "2.5"), ("3", None, None), ("5", "7", "oops")]
    doubles = SRC.read_csv_doubles(spark, path, ["a", "b", "c"]).orderBy("a").collect()
    assert [tuple(r) for r in doubles] == [(1.0, None, 2.5), (3.0, None, None), (5.0, 7.0, None)]


def test_text_lines_round_trip(spark):
    lines = spark.createDataFrame([("h1\th2\th3",), ("1\t2\t3",), ("4\t5",)], "value string")
    path = SRC.write_lines(lines, "tsv")
    from tablewright.operators.clean import drop_header_rows, split_fields
    d = split_fields(SRC.read_lines(spark, path), {"a": 0, "c": 2})
    d = drop_header_rows(d, "a", "h1")
    assert sorted((r["a"], r["c"]) for r in d.collect()) == [("1", "3"), ("4", None)]


def test_write_table_round_trip(spark):
    from conftest import SF001
    from tablewright.operators.clean import clean_cases
    from tablewright.sources.standins import cases
    d = clean_cases(cases(spark, SF001))
    kept = SRC.write_table(d, "clean-cases")
    assert kept.count() == d.count()
    assert kept.exceptAll(d).count() == 0
    plan = kept.filter(F.col("score") > 10).select("state")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(score,10" in plan
