"""Periodic runs against a comparison of all pairs of words."""

import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from edges import docs, rows
from tablewright.llm import periodic_runs as P
from tablewright.llm.queries import op11_periodic_runs


def plain_runs(words, least=P.LEAST):
    n, seen = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                seen.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in seen.items()), key=lambda r: (r[0], r[2]))


def strings(r):
    """Random, periodic, nested and Fibonacci-like sequences."""
    n = r.choice([0, 1, 11, 12, 40, 150, 400])
    kind = r.randrange(6)
    if kind == 0:
        return [r.randrange(r.choice([1, 2, 3, 50])) for _ in range(n)]
    if kind == 1:
        u = [r.randrange(3) for _ in range(r.randint(1, 90))]
        return (u * 8)[:n]
    if kind == 2:                                   # periodic parts with breaks
        out = []
        while len(out) < n:
            u = [r.randrange(2) for _ in range(r.randint(1, 20))]
            out += (u * r.randint(1, 9))[:r.randint(1, 90)]
        return out * r.choice([1, 2, 3])
    if kind == 3:
        x, y = [0], [0, 1]
        while len(y) < n:
            x, y = y, y + x
        return y[:n]
    if kind == 4:                                   # touching runs of one root: abababa.abababab
        u = [0, 1, *[2] * r.randrange(2)]
        a = (u * 60)[:r.randint(20, 110)]
        return (a + a[:r.randint(10, len(a))]) * r.choice([1, 2])
    a = [0] * r.randint(1, 70) + [1]
    return (a * 6)[:n] + [2] + [0] * r.randrange(60)


def test_find_runs_brute_force():
    r = random.Random(5)
    for scanned in (4, 8, 16):
        for _ in range(250):
            a = strings(r)
            got = P.find_runs(np.array(a, np.int64), len(a), scanned=scanned)
            assert sorted(((s, e - s, q) for (s, e), q in got.items()), key=lambda x: (x[0], x[2])) == plain_runs(a), (scanned, a)


def test_grouped_texts_do_not_touch():
    r = random.Random(8)
    texts = [" ".join(map(str, strings(r))).encode() for _ in range(120)]
    for group in P._grouped(texts):
        for i, words, runs in P._runs_of(group, P.LEAST, P.SCANNED):
            assert words == texts[i].split() and runs == plain_runs(words)


def test_seeds_stay_linear():
    for a in ([0] * 30_000, [0, 1] * 15_000, ([0] * 99 + [1]) * 300):
        a = np.array(a, np.int64)
        h, k = P._mixed(a.astype(np.uint64)), 1
        for b in (16, 64, 256, 1024):
            while k < b // 2:
                h, k = P._mixed(h[:-k] * np.uint64(3) + h[k:]), k * 2
            assert len(P._seeds(h, b)) <= len(a)


def words_of(t):
    return [w.decode() for w in (t or "").encode().split()]


def kept(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def test_operator_edges(spark):
    data = [(*r[:1], (r[1] or None) and r[1][:40_000], *r[2:]) for r in rows()]
    data += [(20, "Onatre " * 3000, "en", "a"), (21, "a b\n" * 9 + "c", "en", "a"), (22, "\x1cx " * 30, "en", None)]
    d = docs(spark, data)
    got = P.periodic_runs(d).collect()
    assert len(got) == len(data) and set(got[0].asDict()) == {*d.columns, "n_words", "runs", "collapsed"}
    for g in got:
        w = words_of(g.text)
        runs = [tuple(r) for r in g.runs]
        if len(w) < 500:
            assert runs == plain_runs(w)
        assert g.n_words == len(w) and g.collapsed == (None if g.text is None else " ".join(kept(w, runs)))
    assert next(g for g in got if g.doc_id == 20).collapsed == "Onatre"
    assert P.periodic_runs(docs(spark, [])).count() == 0


def expected(doc_id, text):
    w, h = words_of(text), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = plain_runs(w)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join("%d,%d,%d\n" % r for r in runs)), sha(" ".join(kept(w, runs))))


def test_query_brute_force(spark, tmp_path):
    r = random.Random(3)
    data = [(i, r.choice([None, "", " ".join(map(str, strings(r))), "w " * 14 + "end"]), "en", "a") for i in range(300)]
    docs(spark, data, clash=False).write.parquet(f"{tmp_path}/documents.parquet")
    got = op11_periodic_runs(spark, str(tmp_path)).collect()
    assert len(got) == len(data)
    want = {i: expected(i, t) for i, t, *_ in data}
    for g in got:
        assert (g.n_runs, g.start, g.length, g.period, g.exponent_milli, g.runs_sha256, g.collapsed_sha256) == want[g.doc_id], g


def test_query_on_given_rows(spark):
    got = op11_periodic_runs(spark, "/root/testdata/sf0.001")
    assert got.dtypes[:6] == [(c, "bigint") for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli")]
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
             .where(F.length("text") < 4000).collect()}
    for g in got.where(F.col("doc_id").isin(list(texts))).collect():
        assert tuple(g)[1:] == expected(g.doc_id, texts[g.doc_id])
