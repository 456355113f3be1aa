"""SimHash fingerprints and components against brute force."""

import random
import re
from collections import Counter

import pytest
import xxhash

from edges import docs, rows, word_salad
from tablewright.llm import simhash as S
from tablewright.llm.common import connected_components


def slow(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    v = sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))
    return v - (1 << 64) if v >> 63 else v


def reach(fps, bits):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    fs = sorted(fps)
    for i, a in enumerate(fs):
        for b in fs[i + 1:]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= bits:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in fs}


def test_fingerprint():
    for r in rows()[:6] + rows()[9:]:
        assert S.fingerprint(r[1]) == slow(r[1])
    long = word_salad(4, 70_000)                   # more than two blocks
    assert S.fingerprint(long) == slow(long)
    for t in ("İ K ÀÉ", "a b\x85c d", "UPPER Lower É é", "a b c d e"):
        assert S.fingerprint(t) == slow(t)


def test_groups_edges(spark):
    got = S.simhash_groups(docs(spark)).collect()
    fps = {S.fingerprint(r[1]) for r in rows()}
    part = reach(fps, 2)
    low = {}
    for r in rows():
        p = part[S.fingerprint(r[1])]
        if r[0] is not None:
            low[p] = min(r[0], low.get(p, 1 << 60))
    want = Counter((r[0], S.fingerprint(r[1]), low.get(part[S.fingerprint(r[1])])) for r in rows())
    assert Counter((r.doc_id, r.fingerprint, r.component) for r in got) == want
    assert S.simhash_groups(docs(spark, [])).count() == 0


def test_dedup_keeps_one_of_each(spark):
    data = [r for r in rows() if r[0] is not None]
    d = docs(spark, data)
    left = S.simhash_dedup(d)
    assert left.columns == d.columns
    parts = {r.doc_id: r.component for r in S.simhash_groups(d).collect()}
    assert Counter(r.doc_id for r in left.collect()) == Counter(r[0] for r in data if parts[r[0]] == r[0])


@pytest.mark.parametrize("bits, limit", [(2, 2), (2, 1000), (1, 2), (0, 2), (1, 1000)])
def test_links_reach_what_pairs_reach(spark, bits, limit):
    rng = random.Random(bits * 10 + limit)
    fps = set()
    for _ in range(12):                            # clusters that share grid points
        seed = rng.getrandbits(64)
        for _ in range(25):
            v = seed
            for _ in range(rng.randint(0, 3)):
                v ^= 1 << rng.randrange(64)
            fps.add(v - (1 << 64) if v >> 63 else v)
    fps |= {0, -1, 1, 3, 7, -(1 << 63)}
    links = S.links(spark.createDataFrame([(f,) for f in fps], "_fp long"), bits, limit)
    for r in links.collect():
        assert ((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= bits
    part = {r.node: r.component for r in connected_components(links).collect()}
    assert {f: part.get(f, f) for f in fps} == reach(fps, bits)


def test_components_of_a_chain_a_star_and_nothing(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(5, 5), (7, 6)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(80)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
