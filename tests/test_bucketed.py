"""Bucketed tables: rows, group sums and plans without an Exchange of the
large side."""

import re
from collections import Counter

import pytest

from tablewright.sources import bucketed as BU

ROWS = [("hot", i, float(i % 7)) for i in range(400)] + [("b", i, None) for i in range(9)] + [(None, 1, 2.0), ("b", 1, 1.0), ("b", 1, 1.0)]


@pytest.fixture
def merge_joins(spark):
    """As at a size where no side is broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def table(spark, salts, buckets=6):
    return BU.write_bucketed(spark.createDataFrame(ROWS, "k string, i int, v double"), ["k"], buckets, salts=salts, salt_by=["i"])


def under_scan(df, large):
    """The lines of the plan above the scan of the large table, up to the
    first join or the root."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    at = next(i for i, x in enumerate(lines) if "FileScan" in x and f"[{large}" in x)
    depth, out = len(re.match(r"[ :+\-]*", lines[at])[0]), []
    for x in reversed(lines[:at]):
        d = len(re.match(r"[ :+\-]*", x)[0])
        if d < depth:
            depth = d
            out.append(x)
            if "Join" in x:
                break
    return out


@pytest.mark.parametrize("salts", [1, 4])
def test_join_and_groups(spark, merge_joins, salts):
    t = table(spark, salts)
    small = spark.createDataFrame([("hot", "x"), ("b", "y"), ("c", "z"), (None, "n")], "k string, s string")
    joined = BU.join_bucketed(t, small, ["k"], salts)
    assert "Exchange" not in "".join(under_scan(joined, "k#"))
    of = {"hot": "x", "b": "y"}
    assert Counter(map(tuple, joined.select("k", "i", "v", "s").collect())) == Counter((*r, of[r[0]]) for r in ROWS if r[0] in of)
    got = BU.grouped_bucketed(t, ["k"], {"total": "v"}, salts=salts)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == (salts > 1)        # one row a key and salt
    assert {r.k: (r["count"], r.total) for r in got.collect()} == {
        k: (sum(r[0] == k for r in ROWS), sum(r[2] or 0 for r in ROWS if r[0] == k)) for k in ("hot", "b", None)}


def test_hot_key_lies_in_several_buckets(spark):
    def largest(t):
        return max(r["count"] for r in t.selectExpr("input_file_name() AS f").groupBy("f").count().collect())
    assert largest(table(spark, 24)) < 250 < 400 <= largest(table(spark, 1))


def test_two_bucketed_tables_meet_without_exchange(spark, merge_joins):
    a, b = table(spark, 1), table(spark, 1).withColumnsRenamed({"i": "i2", "v": "v2"})
    joined = a.where("k = 'b' or k is null").join(b, ["k"])
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 11 * 11


def test_empty(spark):
    t = BU.write_bucketed(spark.createDataFrame([], "k string, v double"), ["k"], 4, salts=3)
    assert BU.grouped_bucketed(t, ["k"], {"s": "v"}, salts=3).count() == 0
    assert BU.join_bucketed(t, spark.createDataFrame([("a", 1)], "k string, s int"), ["k"], 3).count() == 0
