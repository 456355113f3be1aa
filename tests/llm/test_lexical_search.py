"""Lexical search against plain Python, and the sharing DAG by itself."""

import math
import random
import re
from collections import Counter

import numpy as np

from edges import docs, rows
from tablewright.llm import lexical_search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(t):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def plain_search(documents, items, k=S.BEST):
    tf = [(i, Counter(plain_terms(t))) for i, t in documents]
    tf = [(i, c, sum(c.values())) for i, c in tf if c]
    n, total = len(tf), sum(x[2] for x in tf)
    df = Counter(w for _, c, _ in tf for w in c)
    out = []
    for item, text in dict.fromkeys(items):
        scores = []
        for i, c, size in tf:
            m = 100 - 75 + (75 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m))
                    for w in plain_terms(text) if c[w])
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def salad(r, n, words):
    return " ".join(r.choice(words) for _ in range(n))


def test_terms():
    for t in ("A-b_c9 É\u0080x", "", "\x00\x7fa b~日本", "ÀB"):
        assert [w.decode() for w in S.terms(t.encode())] == plain_terms(t)


def test_dag_equals_plain_sums():
    r = random.Random(4)
    for _ in range(60):
        n_terms = r.randint(1, 30)
        items = [dict(Counter(int(n_terms * r.random() ** 2) for _ in range(r.randint(0, 25)))) for _ in range(r.randint(1, 40))]
        dag = S.share(items, n_terms)
        impact = np.array([[r.randrange(10**12) * (r.random() < 0.7) for _ in range(5)] for _ in range(n_terms)])
        t, d = np.nonzero(impact)
        got = S.evaluate(dag, t, d, impact[t, d], 5)
        assert set(dag.items.tolist()) == {i for i, x in enumerate(items) if x}
        for row, i in zip(got, dag.items.tolist()):
            assert row.tolist() == [sum(int(impact[t, c]) * k for t, k in items[i].items()) for c in range(5)]


def test_common_sets_are_made_once():
    common = list(range(12))
    items = [{**dict.fromkeys(common, 1), 12 + i: 2} for i in range(50)]
    dag = S.share(items, 62)
    assert dag.n_leaves == 51 and dag.leaf[:12].tolist() == [dag.leaf[0]] * 12   # twelve terms, one accumulator
    items = [dict.fromkeys([*common, 12 + i % 3, 20 + i % 2, 30 + i], 1) for i in range(24)]
    dag = S.share(items, 60)
    assert len(dag.parts) <= 2 * 24 < sum(map(len, items)) / 6               # items end as two nodes each
    assert sum(len(x[0]) for x in dag.rounds) < 24


def test_edges(spark):
    d = docs(spark)
    items = [(1, "two words"), (1, "two words"), (1, "no key one"), (2, None), (3, ""), (4, "!!! --"), (None, "x a b a"),
             (5, rows()[9][1]), (6, "日本語 😀"), (7, "absent")]
    i = spark.createDataFrame([(*x, "clash") for x in items], "item_id long, text string, score string")
    want = plain_search([(r[0], r[1]) for r in rows()], [x for x in items if x[1]])
    got = S.lexical_search(d, i)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert found(got) == want
    assert found(S.lexical_search(d, i, block_bytes=40)) == want            # in blocks: the same
    for a, b in ((docs(spark, []), i), (d, i.limit(0)), (docs(spark, [(1, None, "en", "a")]), i)):
        assert S.lexical_search(a, b).count() == 0


def test_ties_and_many_copies(spark):
    r = random.Random(9)
    words = [f"w{i}" for i in range(40)]
    data = [(i, "same text " * 3 if i % 3 else salad(r, r.randint(1, 60), words), "en", "a") for i in range(400, 0, -1)]
    items = [(i, salad(r, r.randint(1, 20), [*words, "same", "text"])) for i in range(30)]
    got = S.lexical_search(docs(spark, data, clash=False).repartition(7), spark.createDataFrame(items, "item_id long, text string"))
    assert found(got) == plain_search([x[:2] for x in data], items)
