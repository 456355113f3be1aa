"""Ranks and running sums over range partitions against plain Python."""

import random

from pyspark.sql import functions as F

from tablewright.operators import metrics as MT
from tablewright.operators.prefix import global_rank, running_sums


def rows(n, seed=1):
    r = random.Random(seed)
    return [(r.choice(["hot", "hot", "hot", "b", None]), r.randrange(20), i, r.choice([None, 1, 2, 3])) for i in range(n)]


def frame(spark, data):
    return spark.createDataFrame(data, "g string, x int, i int, v int")


def key(r):
    return (-r[1], r[2])


def test_ranks(spark):
    data = rows(500)
    for parts in (1, 7):
        got = global_rank(frame(spark, data), [F.col("x").desc(), "i"], partitions=parts).collect()
        assert [r.i for r in sorted(got, key=lambda r: r.rank)] == [r[2] for r in sorted(data, key=key)]
        got = global_rank(frame(spark, data), [F.col("x").desc(), "i"], by=["g"], partitions=parts).collect()
        for g in ("hot", "b", None):
            own = sorted((r for r in data if r[0] == g), key=key)
            assert {r.i: r.rank for r in got if r.g == g} == {r[2]: n for n, r in enumerate(own, 1)}
    assert global_rank(frame(spark, []), ["x"]).count() == 0


def test_running_sums(spark):
    data = rows(400, 2)
    for by in ([], ["g"]):
        got = running_sums(frame(spark, data), [F.col("x").desc(), "i"], {"s": "v"}, by=by, partitions=6).collect()
        want, total = {}, {}
        for r in sorted(data, key=key):
            k = r[0] if by else 0
            want[r[2]] = total[k] = total.get(k, 0) + (r[3] or 0)
        assert {r.i: r.s for r in got} == want


def test_roc_curve(spark):
    d = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1), (None, 0.5), (1, None)], "y int, p double")
    got = [tuple(r) for r in MT.roc_curve(d, "y", "p").orderBy(F.desc("score")).collect()]
    assert got == [(0.9, 1, 0, 0.5, 0.0), (0.8, 2, 1, 1.0, 0.5), (0.1, 2, 2, 1.0, 1.0)]
    one = MT.roc_curve(spark.createDataFrame([(1, 0.5)], "y int, p double"), "y", "p").first()
    assert one.tpr == 1 and one.fpr is None
    assert MT.roc_curve(d.limit(0), "y", "p").count() == 0
