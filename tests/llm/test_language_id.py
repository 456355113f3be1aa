"""Kneser-Ney models against plain Python, and languages of held-out rows."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from edges import docs, rows
from tablewright.llm import language_id as K
from tablewright.llm.common import table
from tablewright.llm.queries import op13_language_id


class Plain:
    """Interpolated Kneser-Ney over words, with dictionaries."""

    def __init__(self, texts, order):
        self.order, self.c = order, [Counter() for _ in range(order + 1)]
        for t in texts:
            for w in K.words(t):
                p = K.START + w + K.END
                for e in range(1, len(p)):
                    g = p[max(0, e - order + 1):e + 1]
                    self.c[len(g)][g] += 1
        for l in range(order - 1, 0, -1):
            self.c[l].update(Counter(g[1:] for g in self.c[l + 1]))
        self.d, self.total, self.types = [0], [None], [None]
        for l in range(1, order + 1):
            n1, n2 = (sum(v == k for v in self.c[l].values()) for k in (1, 2))
            self.d.append(min(0.95, max(0.05, n1 / (n1 + 2 * n2) if n1 + n2 else 0.5)))
            self.total.append(Counter())
            self.types.append(Counter())
            for g, v in self.c[l].items():
                self.total[l][g[:-1]] += v
                self.types[l][g[:-1]] += 1

    def p(self, g):
        p = 1 / (len(self.c[1]) + 1)
        for l in range(1, len(g) + 1):
            x = g[-l:]
            if t := self.total[l][x[:-1]]:
                p = max(self.c[l][x] - self.d[l], 0) / t + self.d[l] * self.types[l][x[:-1]] / t * p
        return p

    def entropy(self, text):
        logs = []
        for w in K.words(text):
            p = K.START + w + K.END
            logs += [math.log2(self.p(p[max(0, e - self.order + 1):e + 1])) for e in range(1, len(p))]
        return -sum(logs) / len(logs)


def texts(r, letters, n):
    parts = ["".join(r.choice(letters) for _ in range(r.randint(1, 3))) for _ in range(12)]
    return [" ".join("".join(r.choices(parts, k=r.randint(1, 4))) for _ in range(r.randint(1, 30))) for _ in range(n)]


@pytest.fixture(scope="module")
def three():
    r = random.Random(6)
    return {"aa": texts(r, "abcdeé", 40), "bb": texts(r, "cdefgh", 40), "cc": texts(r, "日本語a😀", 10) + ["1 2", ""]}


def frame(spark, three):
    data = [(i, t, lang, "s") for i, (lang, t) in enumerate((lang, t) for lang, ts in three.items() for t in ts)]
    return docs(spark, [*data, (-1, None, "aa", "s"), (-2, "xyz xyz", None, "s"), (-3, "7 7", "none", "s")])


@pytest.mark.parametrize("order", [2, 5])
def test_model_equals_plain(spark, three, order):
    m = K.fit(frame(spark, three), order=order)
    assert m.languages == ["aa", "bb", "cc"]
    plain = [Plain(three[x], order) for x in m.languages]
    probe = [*three["aa"][:6], *three["cc"][:3], "Zebra abc", "abcdeabcde", "x", "日a 9 é"]
    got, letters = K.Scorer(m).entropies(probe)
    np.testing.assert_allclose(got, [[p.entropy(t) for p in plain] for t in probe], rtol=2e-5)
    assert letters.tolist() == [sum(map(str.isalpha, t)) for t in probe]


def test_probabilities_sum_to_one(spark, three):
    for grams in (K.MODEL_GRAMS, 300):               # also where grams were left out
        m = K.fit(frame(spark, three), order=3, model_grams=grams)
        for lang in (0, 2):
            marks = {g for t in three[m.languages[lang]] for w in K.words(t) for g in w} | {K.END}
            for before in ("", "a", K.START, K.START + "c", "ab", "本a", "zz"):
                h = K._hashes(K._codes("".join(before + x for x in [*marks, "\x01"])), 3)
                at = np.arange(len(marks) + 1) * (len(before) + 1) + len(before)
                p = m.probabilities(h, at, np.full(len(at), len(before) + 1))[:, lang]
                if len(m.shares[lang][0].keys) == len(marks):
                    assert abs(p.sum() - 1) < 1e-5
                assert (p > 0).all()


def test_edges(spark, three):
    m = K.fit(frame(spark, three))
    d = docs(spark)
    got = K.identify(d, m).collect()
    assert len(got) == len(rows()) and set(got[0].asDict()) == {*d.columns, "lang_pred", "score", "entropy", "rejected"}
    for g in got:
        if any(map(str.isalpha, g.text or "")):
            assert g.lang_pred in m.languages and 0 < g.score <= 1 and g.entropy > 0
        else:
            assert (g.lang_pred, g.score, g.entropy, g.rejected) == (K.UNKNOWN, 0, None, True)
    assert {g.ids for g in got} == {"clash"} and {g.n_chars for g in got} == {len(r[1] or "") for r in rows()}
    assert K.identify(docs(spark, []), m).count() == 0
    none = K.fit(docs(spark, []))
    assert none.languages == [] and {g.lang_pred for g in K.identify(d, none).collect()} == {K.UNKNOWN}
    for t, lang in ((three["aa"][0], "aa"), (three["bb"][1], "bb"), (three["cc"][2], "cc")):
        assert K.identify(docs(spark, [(1, t, None, None)]), m).first().lang_pred == lang
    odd = docs(spark, [(1, "²½ Ⅷ", None, None)])
    assert K.identify(odd, m).first().lang_pred == K.UNKNOWN   # numbers, no letter


def test_held_out_rows_and_rejection(spark):
    d = table(spark, "/root/testdata/sf0.01", "documents")
    got = op13_language_id(spark, "/root/testdata/sf0.01").join(d.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(got) == d.count()
    for g in got:
        assert g.held_out == (zlib.crc32(str(g.doc_id).encode()) % 4 == 2)
    right = defaultdict(list)
    for g in got:
        if any(map(str.isalpha, g.text)):
            right[g.held_out].append(g.lang_pred == g.lang)
    assert sum(right[True]) / len(right[True]) > 0.97
    m = K.fit(d)
    assert all(map(math.isfinite, m.limits))
    noise = random.Random(1)
    other = [(i, " ".join("".join(noise.choice("qxzwkjvy") for _ in range(7)) for _ in range(40)), None, None) for i in range(20)]
    assert all(r.rejected for r in K.identify(docs(spark, other), m).collect())
    kept = K.identify(d, m).select(F.avg(F.col("rejected").cast("double"))).first()[0]
    assert kept < 0.05


def test_sample_is_bounded_and_whole(spark):
    data = [(i, f"text {i} of many", "xx" if i % 4 else "yy", "s") for i in range(8000)]
    s = {r.lang: r for r in K._sample(docs(spark, data, clash=False), "text", "lang", 500).groupBy("lang").agg(
        F.count("*").alias("n"), F.sum(F.col("calibrates").cast("int")).alias("c")).collect()}
    for x in s.values():
        assert 400 < x.n < 600 and 0.1 < x.c / x.n < 0.3
