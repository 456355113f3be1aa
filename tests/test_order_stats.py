"""Exact order statistics against numpy, with one sort per group and with
bracket-narrowing rounds (forced by a tiny ``max_rows``), with heavy ties and
a skewed group. The bound never changes a value."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewright.operators import order_stats as OS


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    n = 6000
    g = rng.choice([0, 1, 2], size=n, p=[0.7, 0.2, 0.1])     # group 0 is hot
    x = np.round(rng.exponential(10, n), 1)
    x[g == 2] = np.where(rng.random((g == 2).sum()) < 0.6, 5.0, x[g == 2])  # ties
    pdf = pd.DataFrame({"g": g.astype(int), "x": x})
    return pdf, spark.createDataFrame(pdf)


def _expected(pdf, g, p, kind):
    v = np.sort(pdf.x[pdf.g == g].to_numpy())
    if kind == "cont":
        return float(np.percentile(v, p * 100))
    return float(v[max(1, int(np.ceil(p * len(v)))) - 1])


@pytest.mark.parametrize("kind", ["cont", "disc"])
@pytest.mark.parametrize("max_rows", [40, OS.EXACT_ROWS])
def test_grouped_quantiles(data, kind, max_rows):
    pdf, df = data
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    res = OS.exact_quantiles(df, "x", probs, by=["g"], kind=kind, max_rows=max_rows).collect()
    assert len(res) == 3 * len(probs)
    for r in res:
        assert r["q"] == pytest.approx(_expected(pdf, r["g"], r["p"], kind), abs=1e-9)


def test_global_quantile_ignores_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.0,), (3.0,), (10.0,)], "x double")
    got = {r["p"]: r["q"] for r in OS.exact_quantiles(df, "x", [0.5]).collect()}
    assert got[0.5] == 2.5
    disc = OS.exact_quantiles(df, "x", [0.5], kind="disc").collect()[0]["q"]
    assert disc == 2.0


@pytest.mark.parametrize("max_rows", [25, OS.EXACT_ROWS])
def test_first_k_matches_sort(spark, max_rows):
    df = spark.range(0, 3000).withColumn("h", (F.col("id") * 7919) % 400)
    cond = OS.first_k_condition(df, ["h", "id"], 777, max_rows=max_rows)
    got = {r["id"] for r in df.filter(cond).collect()}
    want = set(df.toPandas().sort_values(["h", "id"]).head(777)["id"])
    assert got == want


def test_select_ranks_carries_extra_columns(spark):
    base = spark.createDataFrame([(1, float(i)) for i in range(10)], "g int, v double")
    t = spark.createDataFrame([(1, 0, 3, 10, "third")], "g int, tid int, rank bigint, n bigint, tag string")
    r = OS.select_ranks(base, "v", t, by=["g"], max_rows=4).collect()[0]
    assert r["v"] == 2.0 and r["tag"] == "third"


def test_bracket_rounds_on_real_columns_match_duckdb(spark):
    """Five trip columns (two with heavy ties) through the bracket rounds,
    forced by a tiny max_rows, against DuckDB's quantile_cont/quantile_disc."""
    from oracle_check import duck
    from conftest import SF01
    from tablewright.operators.clean import unpivot_numeric
    from tablewright.sources.standins import trips

    cols = ["fare", "l_quantity", "l_discount", "l_tax", "p_size"]
    long = unpivot_numeric(trips(spark, SF01), cols)
    probs = [0.1, 0.25, 0.5, 0.75, 0.9]
    con = duck(SF01)
    for kind, fn in [("cont", "quantile_cont"), ("disc", "quantile_disc")]:
        got = {(r["column"], r["p"]): r["q"] for r in
               OS.exact_quantiles(long, "x", probs, by=["column"], kind=kind,
                                  max_rows=300).collect()}
        for c in cols:
            sql = (f"SELECT {', '.join(f'{fn}(CAST({c} AS DOUBLE), {p})' for p in probs)} "
                   f"FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey")
            sql = sql.replace("CAST(fare AS", "CAST(l_extendedprice AS")
            want = con.sql(sql).fetchall()[0]
            for p, w in zip(probs, want):
                assert got[(c, p)] == pytest.approx(w, abs=1e-9), (kind, c, p)


@pytest.mark.parametrize("max_rows", [300, OS.EXACT_ROWS])
def test_column_quantiles_both_paths(spark, data, max_rows):
    pdf, df = data
    wide = df.withColumn("y", F.col("x") * 2 + F.col("g"))
    res = OS.exact_column_quantiles(wide, ["x", "y"], [0.25, 0.5, 0.9], max_rows=max_rows).collect()
    import numpy as np
    ys = (pdf.x * 2 + pdf.g).to_numpy()
    for r in res:
        v = pdf.x.to_numpy() if r["column"] == "x" else ys
        assert r["q"] == pytest.approx(float(np.percentile(v, r["p"] * 100)), abs=1e-9)


def test_the_bound_never_changes_a_value(spark):
    """Random doubles: bound 100 and the default give bit-equal quantiles."""
    rng = np.random.default_rng(11)
    df = spark.createDataFrame(pd.DataFrame({"x": rng.normal(size=3001) * 1e3, "g": rng.integers(0, 3, 3001)}))
    probs = [float(p) for p in rng.random(48)] + [0.0, 0.5, 1.0]
    for by in ([], ["g"]):
        for kind in ("cont", "disc"):
            a, b = ({(*(r[c] for c in by), r["p"]): r["q"] for r in
                     OS.exact_quantiles(df, "x", probs, by=by, kind=kind, max_rows=m).collect()}
                    for m in (100, OS.EXACT_ROWS))
            assert a == b and len(a) == len(probs) * (3 if by else 1)


def test_a_shuffled_target_table_changes_no_value(spark, data, monkeypatch):
    pdf, df = data
    monkeypatch.setattr(OS, "BROADCAST_BYTES", 0)
    for r in OS.exact_quantiles(df, "x", [0.25, 0.5], by=["g"], max_rows=100).collect():
        assert r["q"] == pytest.approx(_expected(pdf, r["g"], r["p"], "cont"), abs=1e-9)


def test_many_ranks_of_one_column(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).cast("double").alias("x"))
    probs = [i / 2000 for i in range(2001)]
    got = {r["p"]: r["q"] for r in OS.exact_quantiles(df, "x", probs, kind="disc", max_rows=500).collect()}
    assert got == {p: float(max(1, int(np.ceil(p * 5000))) - 1) for p in probs}


def test_nothing_stays_cached(spark, data):
    _, df = data
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    OS.exact_quantiles(df, "x", [0.5], by=["g"], max_rows=50).collect()
    OS.exact_column_quantiles(df, ["x", "g"], [0.5]).collect()
    cond = OS.first_k_condition(spark.range(0, 500).withColumn("h", F.col("id") % 9), ["h", "id"], 50, max_rows=20)
    assert cond is not None
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before


def test_places_come_from_a_binary_search(spark):
    import bisect
    probes = sorted({(i * 37) % 101 for i in range(60)})
    most = 2 * len(probes)
    d = spark.createDataFrame([(i, probes) for i in range(-3, 105)], "id long, p array<long>")
    rows = d.select("id", OS._leading("p", lambda p: p < F.col("id"), most).alias("at"),
                    OS._leading("p", lambda p: F.lit(False), most).alias("none"),
                    OS._leading("p", lambda p: F.lit(True), most).alias("all")).collect()
    assert [r["at"] for r in rows] == [bisect.bisect_left(probes, r["id"]) for r in rows]
    assert {(r["none"], r["all"]) for r in rows} == {(0, len(probes))}
    empty = spark.createDataFrame([([],)], "p array<long>")
    assert empty.select(OS._leading("p", lambda p: F.lit(True), 4).alias("at")).first()["at"] == 0


def test_a_row_meets_the_bracket_that_holds_it(spark):
    values = sorted([(i * i) % 301 for i in range(400)] + [5] * 30 + [90, 200])
    base = spark.createDataFrame([(0, v) for v in values], "g int, _v long")
    brackets = spark.createDataFrame([(0, None, 5), (0, 5, 90), (0, 200, None)], "g int, lo long, hi long")
    rows = OS._attach(base, brackets, ["g"], True, 3).collect()
    want = [(v, None, 5) if v < 5 else (v, 5, 90) if v < 90 else (v, 200, None)
            for v in values if v < 5 or 5 < v < 90 or v > 200]
    assert sorted((r["_v"], r["lo"], r["hi"]) for r in rows) == want
