"""Exact dedup, line dedup and mixing on edge cases and against plain Python."""

import hashlib
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from edges import docs, rows, word_salad
from tablewright.llm import exact_dedup as X
from tablewright.llm import line_dedup as L
from tablewright.llm import mixing as M


def normal(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def check_exact(data, got):
    groups = defaultdict(list)
    for r in data:
        groups[normal(r[1])].append(r[0])
    want = Counter()
    for ids in groups.values():
        keep = min((i for i in ids if i is not None), default=None)
        for i in ids:
            want[i, i if len(ids) == 1 else keep, len(ids), len(ids) == 1 or i == keep] += 1
    assert Counter((r.doc_id, r.keep_key, r.group_size, r.kept) for r in got) == want


def test_exact_dedup_edges(spark):
    got = X.exact_dedup(docs(spark)).collect()
    check_exact(rows(), got)
    assert X.exact_dedup(docs(spark, [])).count() == 0


def test_exact_dedup_refines(spark):
    # equal length and equal prefix, different ends; a bitmap so small that
    # every bit is set decides the same
    data = [(i, "p" * 80 + f"{i % 7:03d}", "en", "s") for i in range(60)] + [(100 + i, "q" * (100 + i), "en", "s") for i in range(40)]
    for bits in (1 << 24, 1 << 5):
        got = X.exact_dedup(docs(spark, data), bits=bits).collect()
        check_exact(data, got)
        for r in got:
            if r.full_hash and r.doc_id < 60:
                assert r.full_hash == hashlib.sha256(data[r.doc_id][1].encode()).hexdigest()
    hashed = [r.doc_id for r in X.exact_dedup(docs(spark, data)).collect() if r.full_hash]
    assert set(hashed) == set(range(60))            # lengths that occur once are never hashed


def plain_lines(data, ratio, least):
    total, pages = Counter(), Counter()
    for _, t, _, s in data:
        total[s] += 1
        pages.update((s, x) for x in {y.strip(" ") for y in (t or "").split("\n")} if x)
    out = []
    for i, t, _, s in data:
        ls = [] if t is None else t.split("\n")
        left = [x for x in ls if not x.strip(" ") or not (pages[s, x.strip(" ")] >= least and pages[s, x.strip(" ")] > ratio * total[s])]
        out.append((i, None if t is None else "\n".join(left), len(ls), len(ls) - len(left)))
    return Counter(out)


def test_line_dedup(spark):
    rng = random.Random(3)
    data = rows() + [(1000 + i, "\n".join([f"nav {rng.randrange(3)} ", word_salad(i, 5), "", rng.choice(["foot", "other"])]), "en", "h" + str(i % 2))
                     for i in range(60)] + [(2000 + i, "foot", None, None) for i in range(6)]
    d = docs(spark, data)
    for ratio, least in ((0.3, 4), (0.02, 4), (0.02, L.MIN_PAGES), (0.0, 1)):
        got = L.line_dedup(d, ratio=ratio, min_pages=least)
        assert got.columns == [c for c in d.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
        assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()) == plain_lines(data, ratio, least)
    assert L.line_dedup(docs(spark, [])).count() == 0


def test_equal_pages_count_once(spark):
    """A page copied onto all pages of a host but a few keeps its lines; a
    line of many different pages goes, from the copies too."""
    data = [(i, "copied page\nof two lines\nnav", "en", "h") for i in range(60)]
    data += [(100 + i, f"own {i}\nnav", "en", "h") for i in range(40)] + [(200 + i, "x", "en", "one") for i in range(5)]
    got = {r.doc_id: r.text for r in L.line_dedup(docs(spark, data), ratio=0.5, equal_once=True).collect()}
    assert got[0] == got[59] == "copied page\nof two lines" and got[100] == "own 0" and got[200] == "x"
    assert {r.doc_id: r.text for r in L.line_dedup(docs(spark, data), ratio=0.5).collect()}[0] == ""


def test_line_dedup_without_broadcast(spark, monkeypatch):
    data = [(i, f"same\n{i}", "en", "h") for i in range(20)]
    monkeypatch.setattr(L, "broadcast_if_small", lambda df, *_: df)
    assert all(r.n_dropped == 1 for r in L.line_dedup(docs(spark, data)).collect())


def fill(sizes, weights, total, epochs):
    """Clamp, share the excess anew, until no target is above its cap."""
    target, capped = {}, set()
    while True:
        rest = total - sum(epochs * sizes[s] for s in capped)
        open_ = [s for s in sizes if s not in capped]
        share = sum(weights[s] for s in open_)
        target = {s: epochs * sizes[s] for s in capped} | {s: rest * weights[s] / share for s in open_}
        above = [s for s in open_ if target[s] > epochs * sizes[s]]
        if not above:
            return target
        capped.update(above)


def check_mix(data, got):
    n = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for r in data:
        sizes[r[3]] += n(r[1])
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    target = fill(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, 1.5 * sum(sizes.values()), 2.0)
    taken, most = Counter(), Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 * (1 + target[r.source])
        assert 0 <= r.copies <= 2
        taken[r.source] += r.n * r.copies
        most[r.source] = max(most[r.source], r.n)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= most[s] + 1e-6


def test_mixing(spark):
    rng = random.Random(9)
    data = rows() + [(100 + i, word_salad(i, rng.randint(0, 60)), "en", rng.choice(["a", "b", "c", "d", "é", "Z", None])) for i in range(400)]
    d = docs(spark, data)
    got = M.mix_counts(d).withColumn("n", F.col("size"))
    assert got.columns[:len(d.columns) - 2] == [c for c in d.columns if c not in ("size", "copies")]
    first = got.collect()
    check_mix(data, first)
    assert Counter(first) == Counter(M.mix_counts(d.repartition(7)).withColumn("n", F.col("size")).collect())
    m = M.mix(d)
    assert m.columns == d.columns
    assert m.count() == sum(r.copies for r in first)
    assert M.mix_counts(docs(spark, [])).count() == 0


def test_empty_texts_at_the_cap(spark):
    """Sources at twice their size take no third copy of their empty texts."""
    data = [(i, "w " * 20, "en", "big") for i in range(200)]
    data += [(1000 + i, "" if i % 3 else f"few words {i}", "en", f"small{i % 4}") for i in range(300)]
    got = M.mix_counts(docs(spark, data)).withColumn("n", F.col("size")).collect()
    check_mix(data, got)
    capped = [r for r in got if r.source != "big"]
    assert all(r.target == 2 * r.source_size for r in capped) and {r.copies for r in capped} == {2}


def test_mixing_all_empty_and_one_source(spark):
    assert all(r.target == 0 and r.size == 0 for r in M.mix_counts(docs(spark, [(1, "", "en", "a"), (2, None, "en", "b")])).collect())
    data = [(i, "w " * 10, "en", "only") for i in range(50)]
    check_mix(data, M.mix_counts(docs(spark, data)).withColumn("n", F.col("size")).collect())
