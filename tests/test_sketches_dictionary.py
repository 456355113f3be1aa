"""Stored sketches, dictionary encoding and rejected lines against plain Python."""

import random
from bisect import bisect_left, bisect_right
from collections import Counter

import pytest
from pyspark.sql import types as T

from tablewright.operators import clean as C
from tablewright.operators import dictionary as DI
from tablewright.operators import sketches as SK
from tablewright.sources import files as SRC

# --- sketches -------------------------------------------------------------------------


def measured(n, seed=1):
    """One group holds most rows; values are shared and skewed; one is null."""
    r = random.Random(seed)
    return [(r.choice(["hot"] * 6 + ["b", None]), r.randrange(9), r.choice([None, float(r.randrange(50)), r.expovariate(0.01)]),
             r.randrange(3000)) for _ in range(n)]


def frame(spark, data):
    return spark.createDataFrame(data, "g string, day int, v double, u long")


def test_merged_sketches_keep_their_bounds(spark):
    data = measured(20_000)
    parts = [SK.sketch_table(frame(spark, [r for r in data if (r[1] < 5) == first]), ["g", "day"], "v", "u") for first in (True, False)]
    table = parts[0].unionByName(parts[1])          # the second date range came later
    got = SRC.stored(SK.quantile_estimates(SK.merge_sketches(table, ["g"]), ["g"], [0.0, 0.25, 0.5, 0.9, 1.0]))
    off = {(r.g, r.p): r.rank_off for r in SK.quantile_errors(frame(spark, data), got, ["g"], "v").collect()}
    assert len(off) == 15
    for r in got.collect():
        own = sorted(x[2] for x in data if x[0] == r.g and x[2] is not None)
        assert r.n == len(own) and r.quantile in own
        below, upto = bisect_left(own, r.quantile) / len(own), bisect_right(own, r.quantile) / len(own)
        want = max(0.0, below - r.p, r.p - upto)
        assert abs(off[r.g, r.p] - want) < 1e-12 and want <= 2 * SK.rank_error()
        users = len({x[3] for x in data if x[0] == r.g})
        assert abs(r.n_distinct - users) <= 4 * SK.count_error() * users
    one = SK.merge_sketches(table).first()
    assert one.n == sum(r[2] is not None for r in data)


def test_the_rows_are_not_read_again(spark):
    table = SK.sketch_table(frame(spark, measured(500)), ["g", "day"], "v", "u")
    plan = SK.merge_sketches(table, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "sketches-" in plan and "Scan ExistingRDD" not in plan


def test_sketch_edges(spark):
    none = [("a", 1, None, None), ("a", 2, None, None), ("b", 1, 4.0, 7)]
    got = SK.quantile_estimates(SK.merge_sketches(SK.sketch_table(frame(spark, none), ["g", "day"], "v", "u"), ["g"]), ["g"], [0.5, 1.0])
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("a", 0, 0.5, None, 0), ("a", 0, 1.0, None, 0), ("b", 1, 0.5, 4.0, 1), ("b", 1, 1.0, 4.0, 1)], key=str)
    assert SK.merge_sketches(SK.sketch_table(frame(spark, []), ["g"], "v", "u"), ["g"]).count() == 0
    with pytest.raises(ValueError):
        SK.quantile_errors(frame(spark, none), got, [], "v")


# --- dictionary -----------------------------------------------------------------------

TOKENS = [(1, ["b", "a", "b", None]), (2, []), (3, None), (None, ["é", "Z"]), (4, ["", "a"]), (4, ["a"])] + [
    (i, ["hot", f"w{i % 37}"]) for i in range(10, 300)]


def test_dictionary_and_vectors(spark):
    d = spark.createDataFrame(TOKENS, "k int, tokens array<string>")
    words = DI.token_dictionary(d)
    rows = Counter(w for _, t in TOKENS for w in set(t or []) if w is not None)
    order = sorted(rows, key=lambda w: w.encode())
    assert sorted(map(tuple, words.collect()), key=lambda r: r[1]) == [(w, i, rows[w]) for i, w in enumerate(order)]

    known = words.where("token <> 'hot'")
    want = {}
    for k, t in TOKENS:
        want.setdefault(k, Counter()).update(w for w in t or [] if w is not None)
    got = {r.k: r for r in DI.sparse_vectors(d, ["k"], known).collect()}
    assert got.keys() == want.keys()
    for k, c in want.items():
        pairs = sorted((order.index(w), n) for w, n in c.items() if w != "hot")
        assert (list(zip(got[k].indices, got[k].counts)), got[k].n_unknown) == (pairs, c["hot"])


def test_vectors_decode_to_their_tokens(spark):
    d = spark.createDataFrame(TOKENS, "k int, tokens array<string>")
    words = SRC.stored(DI.token_dictionary(d))
    got = DI.decode_vectors(DI.sparse_vectors(d, ["k"], words), ["k"], words)
    want = Counter((k, w) for k, t in TOKENS for w in t or [] if w is not None)
    assert {(r.k, r.token): r.n for r in got.collect()} == want


def test_no_task_holds_the_vocabulary(spark):
    d = spark.createDataFrame(TOKENS, "k int, tokens array<string>")
    words = DI.token_dictionary(d)
    assert words.select("token").rdd.getNumPartitions() > 1
    assert DI.token_dictionary(d.limit(0)).count() == 0
    assert DI.sparse_vectors(d.limit(0), ["k"], words).count() == 0
    none = DI.sparse_vectors(d, ["k"], words.limit(0)).where("k = 1").first()
    assert (none.indices, none.counts, none.n_unknown) == ([], [], 3)


# --- rejected lines -------------------------------------------------------------------

LINES = ['1,"x,y",2.5', "2,z,", "3,z", "4,z,1,9", "x,z,1", "5,z,Not Available", "6,,1e3", "7,z, 8", '8,"a \\"q\\"",4', "9.5,z,1"]
SCHEMA = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("s", T.StringType()), T.StructField("v", T.DoubleType())])


def test_good_and_rejected_are_all_lines(spark):
    path = SRC.write_lines(spark.createDataFrame([(x,) for x in LINES], "value string"))
    good, bad = SRC.read_csv_checked(spark, path, SCHEMA, header=False)
    assert good.count() + bad.count() == SRC.read_lines(spark, path).count()
    got = {r.line: r.reason for r in bad.collect()}
    assert got == {"3,z": "fields", "4,z,1,9": "fields", "x,z,1": "i: not int", "5,z,Not Available": "v: not double", "9.5,z,1": "i: not int"}
    assert {tuple(r) for r in good.collect()} == {(1, "x,y", 2.5), (2, "z", None), (6, None, 1000.0), (7, "z", 8.0), (8, 'a "q"', 4.0)}
    assert good.select("s").where("v is null").count() == 1      # a column alone changes no verdict


def test_no_lines(spark):
    path = SRC.write_lines(spark.createDataFrame([], "value string"))
    good, bad = SRC.read_csv_checked(spark, path, SCHEMA, header=False)
    assert (good.count(), bad.count(), good.columns, bad.columns) == (0, 0, ["i", "s", "v"], ["line", "reason"])


def test_checked_fields(spark):
    lines = spark.createDataFrame([("a\t1\t2",), ("a\t\t2",), ("a\tx\t2",), ("a\t1",), (None,), ("",), ("a\t1\ty\tmore",)], "value string")
    got = C.checked_fields(lines, {"s": 0, "v": 2, "i": 1}, {"i": "int", "v": "double"})
    assert [tuple(r) for r in got.collect()] == [
        ("a\t1\t2", "a", 2.0, 1, None), ("a\t\t2", "a", 2.0, None, None), ("a\tx\t2", "a", 2.0, None, "i: not int"),
        ("a\t1", "a", None, 1, "fields"), (None, None, None, None, "fields"), ("", None, None, None, "fields"),
        ("a\t1\ty\tmore", "a", None, 1, "v: not double")]
    assert C.checked_fields(lines.limit(0), {"s": 0}).count() == 0
