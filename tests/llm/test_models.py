"""Toxicity grammar and lattice language model: brute force and held-out rows."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from edges import docs, rows, word_salad
from tablewright.llm import lattice_lm as L
from tablewright.llm import queries as Q
from tablewright.llm import toxicity as X


# --- toxicity ----------------------------------------------------------------------

def kinds(text):
    g = X.Grammar({})
    f = g.features(text)
    return {k for k, x in zip(X.KINDS, f) if x > 0}


@pytest.mark.parametrize("text, found", [
    ("what an idiot", {"plain"}), ("you are an idiot", {"targeted"}), ("you are not an idiot", {"negated"}),
    ("He said, you are an idiot", {"reported"}), ("he said: \"you, you idiot!\" you idiot", {"reported", "targeted"}),
    ('they wrote: "you moron." You are a moron', {"reported", "targeted"}), ("you, idiot", {"plain"}),
    ("she said you are an idiot", {"reported"}), ("she said hello. you idiot", {"targeted"}), ("we will kill them", {"threat"}),
    ("they did not kill them", {"negated"}), ("kill time", set()), ("IDIOT!!", {"plain"}), ("moron%%% |", {"plain"}),
    ("not one of all those many idiots", {"targeted"}), ("", set()), (None, set()), ("idiotic", set())])
def test_clauses(text, found):
    assert kinds(text) == found


def test_composition_equals_its_parts():
    table = X.compose()
    rng = random.Random(1)
    for _ in range(200):
        state, parts = 0, (0,) * len(X.PARTS)
        for cls in (rng.randrange(len(X.CLASSES)) for _ in range(30)):
            to, kind = table[state][cls]
            assert kind == X._kind(parts, cls)
            state, parts = to, tuple(p(s, cls) for p, s in zip(X.PARTS, parts))


def labelled(n=400):
    r = random.Random(6)
    data, labels = [], []
    for i in range(n):
        words = word_salad(i, 60).split()
        if toxic := i % 5 == 0:
            for _ in range(4):
                words.insert(r.randrange(len(words)), r.choice(["zorglub", "zorglin"]) + r.choice(["a", "en", "ist"]))
        data.append((i, " ".join(words), "xx", "s"))
        labels.append((i, int(toxic)))
    return data, labels


def test_learns_stems_and_keeps_clean_rows(spark):
    data, labels = labelled()
    d, known = docs(spark, data), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in X.toxicity(d, known).collect()}
    held = [(i, t) for i, t in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].predicted == t and 0 <= got[i].score <= 1 for i, t in held)
    kept = X.toxic_filter(d, known)
    assert kept.columns == d.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}
    # labels of fold 0 are never seen
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    again = {r.doc_id: r for r in X.toxicity(d, spark.createDataFrame(flipped, "doc_id long, toxic int")).collect()}
    assert all(abs(again[i].score - got[i].score) < 1e-9 for i in got)


def test_toxicity_edges(spark):
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    got = X.toxicity(docs(spark), none).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows())
    assert all(r.predicted == 0 for r in got)
    assert X.toxicity(docs(spark, []), none).count() == 0
    bad = X.toxicity(docs(spark, [(1, "you are an idiot and a moron", "en", "s")]), none).first()
    assert bad.predicted == 1
    assert X.toxic_filter(docs(spark), none).count() == len(rows())


def test_toxicity_held_out(spark):
    sf = SF01.replace("sf0.01", "sf0.1")
    r = Q.op5_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    c = Counter((x.toxic, x.predicted) for x in r.collect())
    assert c[1, 1] >= 0.85 * (c[1, 1] + c[1, 0]) and c[0, 1] <= 0.02 * (c[0, 0] + c[0, 1])


# --- lattice language model ---------------------------------------------------------

PRIOR = ({"": 0.1, "a": 0.5, "ab": 0.4}, {"a": 0.3, "b": 0.3, "ba": 0.2, "bab": 0.2})


def every_path(m, w):
    """The probability of a word, one segmentation after the other."""
    total = 0.0
    for n in range(len(w)):
        for at in itertools.combinations(range(1, len(w)), n):
            parts = [w[i:j] for i, j in zip((0, *at), (*at, len(w)))]
            inner = lambda ps: math.prod(
                math.exp(m.inner[p]) if p in m.inner else math.exp(m.byte * len(p.encode())) if len(p) == 1 else 0.0 for p in ps)
            first = math.exp(m.start[parts[0]]) if parts[0] in m.start else 0.0
            total += (first * inner(parts[1:]) + math.exp(m.bare) * inner(parts)) * math.exp(m.stop)
    return total


def test_forward_sums_all_segmentations():
    m = L._lattice(PRIOR, {}, {}, 0)
    for n in range(1, 7):
        for w in map("".join, itertools.product("ab", repeat=n)):
            assert math.isclose(math.exp(m.log_prob(w)), every_path(m, w), rel_tol=1e-9)
    assert math.isclose(math.exp(m.log_prob("aé")), every_path(m, "aé"), rel_tol=1e-9)
    assert -1e6 < m.log_prob("ab" * 20_000) < 0         # no underflow


def test_all_classes_at_once():
    ms = [L._lattice(PRIOR, {"ab": x}, {"a": 3.0, "bab": x}, 5) for x in (0.0, 40.0, 900.0)]
    words = ["".join(w) for n in range(0, 6) for w in itertools.product("abé", repeat=n)] + ["ab" * 20_000, "😀b", "\ud800", "a"]
    for run in L._runs(words, 50):
        got = L.Joint(ms).log_probs(run)
        assert got.shape == (len(run), 3)
        for w, row in zip(run, got):
            assert all(math.isclose(x, m.log_prob(w), rel_tol=1e-9) for x, m in zip(row, ms)), w
    assert [w for r in L._runs(words, 50) for w in r] == words


def test_words_of_other_classes_keep_their_lattice_term(spark):
    """By class the marginal over all segmentations, with the discounted
    frequency where the class has the word."""
    ms = [L._lattice(PRIOR, {"ab": x}, {"a": 3.0, "bab": x}, 5) for x in (0.0, 900.0)]
    totals, types, shares, discount = [40, 60], [7, 9], [0.25, 0.75], 0.6
    data = [("abab", [0, 3], 3), ("bab", [2, 0], 2), ("aab", [1, 4], 5), ("bbba", [0, 0], 1)]
    words = spark.createDataFrame(data, "word string, c array<long>, n long")
    got = {r.word: r for r in L.score_words(words, ms, totals, types, shares, discount).collect()}
    for w, c, n in data:
        p = [discount * t / m * every_path(x, w) + max(0.0, k - discount) / m for t, m, x, k in zip(types, totals, ms, c)]
        shared = sum(s * x for s, x in zip(shares, p))
        want = [math.log10((1 - L.SHARED) * x + L.SHARED * shared) for x in p]
        assert (got[w].c, got[w].n) == (sum(c), n)
        assert all(math.isclose(a, b, rel_tol=1e-9) for a, b in zip(got[w].lm, want)), w


def test_word_probabilities_sum_to_one():
    m = L._lattice(PRIOR, {}, {}, 0)
    part = [sum(every_path(m, w) for w in map("".join, itertools.product("ab", repeat=n))) for n in range(1, 9)]
    left = 1.0 - sum(part)
    assert 0 <= left < 1 and part[-1] < part[0]


def test_expected_counts():
    m = L._lattice(PRIOR, {}, {}, 0)
    begun, inner = Counter(), Counter()
    m.expect("abab", begun, inner)
    assert math.isclose(sum(begun.values()), 1.0, rel_tol=1e-9)
    spelled = sum(len(p) * x for p, x in (begun + inner).items())
    assert math.isclose(spelled, 4.0, rel_tol=1e-9)


def base(data, learned):
    tok = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    c, ends = Counter(), 0
    for r in data:
        if learned(r):
            c.update(tok(r[1]))
            ends += 1
    total, floor = sum(c.values()) + ends, sum(c.values()) + ends + 0.5 * (len(c) + (ends > 0) + 1)
    out = []
    for r in data:
        w = tok(r[1])
        s = sum(math.log10((c[x] + 0.5) / floor) for x in w) + math.log10((ends + 0.5) / floor)
        out.append((r[0], len(w) + 1, sum(c[x] > 0 for x in w) + (ends > 0), total, round(s, 5)))
    return Counter(out)


@pytest.mark.parametrize("head", [0, 10, 200_000])
def test_counts_and_base(spark, head):
    data = rows() + [(300 + i, word_salad(i, 40) + " The the", ["en", "de"][i % 2], "s") for i in range(40)]
    d = docs(spark, data).withColumn("train", F.col("doc_id") % 3 != 0)
    got = L.lm_score(d, "train", kind="lang", head_words=head).collect()
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == base(
        data, lambda r: r[0] is not None and r[0] % 3 != 0)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def whole_score(data, learned, passes):
    """log10 probability of every text, a class and a segmentation after the
    other."""
    tok = lambda t: (t or "").lower().split()
    kinds = sorted({r[2] for r in data if learned(r)}, key=lambda k: (k is None, k or ""))
    rows_of = {k: [tok(r[1]) for r in data if learned(r) and r[2] == k] for k in kinds}
    count = {k: Counter(w for t in rows_of[k] for w in t) for k in kinds}
    ends = sum(map(len, rows_of.values()))
    total, every = ends + sum(sum(c.values()) for c in count.values()), sum(count.values(), Counter())
    once, twice = (sum(n == x for n in every.values()) for x in (1, 2))
    discount = min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5
    models = {}
    for k in kinds:
        models[k] = L._lattice(PRIOR, {}, {}, 0)
        for _ in range(passes):
            begun, inner = Counter(), Counter()
            for w in count[k]:
                models[k].expect(w, begun, inner)
            models[k] = L._lattice(PRIOR, begun, inner, len(count[k]))
    share = {k: len(rows_of[k]) / ends for k in kinds}

    def word(w):
        p = {}
        for k in kinds:
            n = sum(count[k].values()) + len(rows_of[k]) if count[k] else 0
            p[k] = every_path(models[k], w) * (discount * len(count[k]) / n if n else 0.5)
            p[k] += (count[k][w] - discount) / n if count[k][w] else 0.0
        mixed = sum(share[k] * p[k] for k in kinds)
        return {k: (1 - L.SHARED) * p[k] + L.SHARED * mixed if len(kinds) > 1 else p[k] for k in kinds}

    out = {}
    for r in data:
        words = [word(w) for w in tok(r[1])]
        out[r[0]] = math.log10(ends / total * sum(share[k] * math.prod(w[k] for w in words) for k in kinds))
    return out


@pytest.mark.parametrize("head", [0, 3, 200_000])
@pytest.mark.parametrize("classes", [1, 3, 11])
def test_score_is_the_texts_probability(spark, monkeypatch, head, classes):
    """Ten classes and the null one too: each has its own model, and the
    score is the sum over them, not the likeliest one's term."""
    monkeypatch.setattr(L, "_prior", lambda model: PRIOR)
    r = random.Random(classes)
    kinds = [None, *"klmnopqrst"][-classes:]
    data = [(i, " ".join("".join(r.choices("abé", k=r.randrange(1, 6))) for _ in range(r.randrange(0, 7))),
             kinds[i % classes], "s") for i in range(66)]
    d = docs(spark, data).withColumn("train", F.col("doc_id") < 50)
    for passes in (0, 1):
        want = whole_score(data, lambda r: r[0] < 50, passes)
        got = {r.doc_id: r.score for r in L.lm_score(d, "train", kind="lang", head_words=head, passes=passes).collect()}
        assert got.keys() == want.keys()
        assert all(math.isclose(got[i], want[i], rel_tol=1e-9) for i in want)


def test_head_only_moves_the_work(spark):
    data = [(i, word_salad(i, 50), "en", "s") for i in range(60)]
    d = docs(spark, data).withColumn("train", F.col("doc_id") < 40)
    few = {r.doc_id: r.score for r in L.lm_score(d, "train", head_words=5).collect()}
    all_ = {r.doc_id: r.score for r in L.lm_score(d, "train").collect()}
    assert all(abs(few[i] - all_[i]) < 1e-6 * abs(all_[i]) for i in all_)


def test_head_does_not_choose_the_class(spark):
    """The words that tell the classes apart are too rare for the head."""
    r, data = random.Random(3), []
    for i in range(90):
        own = [f"{'xyz'[i % 3]}{r.randrange(60)}" for _ in range(12)]
        data.append((i, " ".join(own + ["the", "of", "and", "to", "in"] * 4), ["en", "de", "fr"][i % 3 if i < 80 else 0], "s"))
    d = docs(spark, data).withColumn("train", F.col("doc_id") < 60)
    few = {r.doc_id: r.score for r in L.lm_score(d, "train", kind="lang", head_words=5).collect()}
    all_ = {r.doc_id: r.score for r in L.lm_score(d, "train", kind="lang", head_words=200_000).collect()}
    assert all(abs(few[i] - all_[i]) < 1e-6 * abs(all_[i]) for i in all_)


def test_lm_edges(spark):
    d = docs(spark).withColumn("train", F.lit(False))
    got = L.lm_score(d, "train").collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows())
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in got)
    assert L.lm_score(docs(spark, []).withColumn("train", F.lit(True)), "train").count() == 0


def test_held_out_beats_the_base(spark):
    r = Q.op4_lattice_lm(spark, SF01.replace("sf0.01", "sf0.1")).where("held_out")
    s = r.agg(F.sum("score"), F.sum("base_score")).first()
    assert s[0] > s[1]
