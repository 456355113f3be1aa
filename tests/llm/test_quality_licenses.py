"""Quality cascade and licence scan on edge cases and against plain Python."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from edges import docs, rows, word_salad
from tablewright.llm import licenses as C
from tablewright.llm import quality as Q

WORD = r"[^\x20\x09-\x0D]+"


def plain(t):
    t = t or ""
    w = re.findall(WORD, t)
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    inside = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(WORD, x)]
    f = dict(n_words=len(w), word_chars=sum(map(len, w)), n_symbols=len(re.findall(r"[#*$%&|<>]", t)),
             n_dup_lines=len(lines) - len(set(lines)), n_repeat_words=len(inside))
    failed = f["n_words"] < 50 or 100 * f["n_repeat_words"] > 50 * f["n_words"]
    bad = (10 * f["n_symbols"] > len(w) or 2 * f["n_dup_lines"] > len(lines) or not 2 * len(w) <= f["word_chars"] <= 15 * len(w)
           or 5 * max(Counter(w).values(), default=0) > 2 * len(w) or 10 * sum("!!" in x for x in w) > 3 * len(w)
           or 2 * sum(bool(re.search(r"[A-Za-z\u0080-\U0010ffff]", x)) for x in w) < len(w))
    return (*f.values(), failed, not failed and not bad)


def junk():
    s = word_salad
    return [(100, s(5, 80) + " a b c" * 30, "en", "s"), (101, " ".join(f"{w}$$$" for w in s(6, 60).split()), "en", "s"),
            (102, " ".join(f"{w.upper()}!!" for w in s(7, 60).split()), "en", "s"), (103, "\n".join([s(8, 5)] * 3 + [s(9, 60)] * 1), "en", "s"),
            (104, " ".join(map(str, range(1000, 1080))), "en", "s"), (105, "to be or " * 40, "en", "s"), (106, s(10, 50), "en", "s"),
            (107, " ".join("x " + w for w in s(11, 60).split()), "en", "s"), (108, "a b " * 49 + "c", "en", "s")]


def test_quality(spark):
    data = rows() + junk()
    got = Q.quality(docs(spark, data))
    assert Counter(tuple(r) for r in got.collect()) == Counter((r[0], *plain(r[1])) for r in data)
    assert Q.quality(docs(spark, [])).count() == 0


def test_cascade_orders_by_rejection_per_cost():
    a, b, c = Q.symbols, Q.one_word, Q.shouting
    assert Q.cascade([(a, 1e-3, 0.1), (b, 1e-4, 0.1), (c, 1e-5, 0.0)]) == [b, a, c]
    assert Q.cascade([(c, 0.0, 0.0), (b, 0.0, 0.0)]) == [b, c]


def test_measure_is_bounded_and_any_order_decides_alike(spark):
    data = rows() + junk()
    d = docs(spark, data * 20)
    m = Q.measure(d, "text", Q.RULES, sample_rows=40)
    assert len(m) == len(Q.RULES) and all(0 <= share <= 1 for _, _, share in m)
    for order in (Q.RULES, Q.RULES[::-1]):
        for r in data:
            t = Q.Text(r[1])
            assert (not any(x(t) for x in Q.BASE + order)) == plain(r[1])[-1]


def lic(t, rows=C.TEMPLATES, threshold=C.THRESHOLD):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    words = lambda x: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", x)
    w = words(low)
    places = sorted((i, label) for label, p in C.PHRASES for i in range(len(w)) if w[i:i + len(p.split())] == p.split())
    best, labels = 0.0, set()
    for label, body in rows:
        tw = set(words(body.lower()))
        must = tw & set(C.TELLING.get(label, ()))
        # a telling word counts beside another word of the template
        own = [x in tw and (x not in must or any(0 <= j < len(w) and w[j] in tw for j in (i - 1, i + 1))) for i, x in enumerate(w)]
        for start in range(len(w)):
            if own[start]:
                have = {w[i] for i in range(start, min(len(w), start + 2 * len(tw))) if own[i]}
                if len(have) / len(tw) >= threshold - 1e-9 and must <= have:
                    labels.add(label)
                    best = max(best, len(have) / len(tw))
    return len(w), places, sorted(labels), best


def test_licenses(spark):
    data = rows() + [
        (200, "x\nReleased  under the MIT\tLicense.\ny", "en", "s"), (201, "MIT Licenses; the mit-license! mit\nlicense", "en", "s"),
        (202, "cc by cc by-nc CC.BY ccby cc\nby", "en", "s"), (203, "This work is licenced under GNU General Public License version 3", "en", "s"),
        (204, "all rights reserved, all rights reserved", "en", "s"), (205, "gnu general gnu general public license", "en", "s"),
        (206, "Licensed under the Apache License 2.0", "en", "s"), (207, "éapache license apache licenseé ÀPACHE LICENSE", "en", "s"),
        (208, "mKit worK Released under the MIT License", "en", "s"), (209, "Released under MIT\nLicense", "en", "s"),
        (210, "reserved rights all " + word_salad(1, 5000), "en", "s"),
        (211, "Permission is hereby granted, free of charge, to any person obtaining a copy of software and documentation files", "en", "s")]
    data = [(i, *r[1:]) for i, r in enumerate(data)] + [(None, "MIT License", "en", "s"), (None, None, None, None)]
    got = C.license_scan(docs(spark, data))
    for r in got.where("doc_id is not null").collect():
        n, places, labels, best = lic(data[r.doc_id][1])
        assert (r.n_words, sorted((p.at, p.label) for p in r.places), r.template_labels, round(r.containment, 9)) == (
            n, places, labels, round(best, 9)), r.doc_id
    assert got.count() == len(data)
    assert sorted(len(r.places) for r in got.where("doc_id is null").collect()) == [0, 1]
    twice = C.license_scan(docs(spark, [(1, "Released under the MIT License", "en", "s")] * 2 + [(1, "other", "en", "s")]))
    assert sorted(r.template_labels for r in twice.collect()) == [[], ["mit"], ["mit"]]      # each row by itself
    assert C.license_scan(docs(spark, [])).count() == 0


def random_blocks(n):
    """Shuffled parts of templates between other words, close and far apart."""
    r = random.Random(n)
    rows = [("one", "alpha beta gamma delta epsilon zeta eta theta iota kappa"), ("lgpl", "gamma lesser delta alpha"),
            ("two", "omega alpha"), ("mit", "mit beta theta of to"), ("of", "of to the")]
    every = sorted({w for _, b in rows for w in b.split()})
    data = []
    for i in range(n):
        own = r.choice(rows)[1].split()
        text = r.sample(own, r.randint(0, len(own))) + r.choices([*every, "x", "y", "z"], k=r.randint(0, 30))
        if r.random() < 0.5:
            r.shuffle(text)
        data.append((i, r.choice([" ", "\n", ", "]).join(text), "en", "s"))
    return rows, data


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.8, 1.0])
def test_random_blocks_brute_force(spark, threshold):
    rows, data = random_blocks(300)
    for r in C.license_scan(docs(spark, data), rows=rows, threshold=threshold).collect():
        assert (r.template_labels, r.containment) == lic(data[r.doc_id][1], rows, threshold)[2:], data[r.doc_id][1]


def test_filters_prune_and_lose_no_pair(spark):
    """Every share of a template's words; each filter drops places, and what
    is met is met with any of them."""
    rows, data = random_blocks(400)
    known = C.vocabulary(rows)
    d = docs(spark, data).select(F.col("doc_id").alias("_row"), C.words(F.col("text")).alias("_w"))
    held = d.select("_row", C._held("_w", known).alias("_held"))
    found = C._ordered(rows, 0.8, {w: i for i, w in enumerate(known)})
    n = {f: C.candidates(held, found, f).count() for f in ((), ("length",), ("positional",), ("length", "positional"))}
    assert n["length",] < n[()] and n["positional",] < n["length",] and n["length", "positional"] == n["positional",]
    prefixed = held.select(F.explode("_held").alias("x")).count()
    assert n[()] < prefixed * len(rows) / 2
    body = "one two three four five six seven eight nine ten"
    data = [(i, " ".join(w for k, w in enumerate(body.split()) if i >> k & 1) + " filler", "en", "s") for i in range(1, 1024, 3)]
    for th in (0.5, 0.8, 1.0):
        got = {r.doc_id for r in C.license_scan(docs(spark, data), rows=[("t", body)], threshold=th).collect() if r.template_labels}
        assert got == {r[0] for r in data if bin(r[0]).count("1") >= 10 * th}


def test_sibling_notices_keep_their_own_label(spark):
    want = {
        "Licensed under the GNU General Public License": [],       # the base phrase has it
        "This work is licensed under the GNU General Public License, version 3.": ["gpl"],
        "Licensed under the GNU Lesser General Public License": ["lgpl"],
        "Licensed under the GNU Affero General Public License": ["agpl"],
        "Licensed under CC BY 4.0.": [], "Licensed under CC BY-NC 4.0.": ["cc-by-nc"],
        "Licensed under CC BY-SA 4.0.": ["cc-by-sa"], "Licensed under CC BY-ND 4.0": ["cc-by-nd"],
        "Licensed under a Creative Commons Attribution 4.0 International License": ["cc-by"],
        "Released under the Apache License": [], "Released under the MIT License": ["mit"],
        "This work is licensed under the Mozilla Public License, version 3": [],
        "This Source Code Form is subject to the terms of the Common Public License, v. 2.0": []}
    got = C.license_scan(docs(spark, [(i, t, "en", "s") for i, t in enumerate(want)])).collect()
    assert {r.doc_id: r.template_labels for r in got} == dict(enumerate(want.values()))


def test_wrapped_notices_are_found(spark):
    """Notices over several lines are met, words strewn over a long line not;
    siblings keep their own label."""
    import textwrap
    body = {label: text for label, text in C.TEMPLATES}
    data, want = [], {}
    for i, (label, notice) in enumerate(body.items()):
        for k, width in enumerate((30, 70, 10_000)):
            lines = textwrap.wrap(word_salad(i, 40) + " " + notice + " " + word_salad(i + 50, 900), width)
            data.append((10 * i + k, "\n * ".join(lines), "en", "s"))
            want[10 * i + k] = [label]
    strewn = f"all {word_salad(1, 50)} rights {word_salad(2, 50)} reserved"
    data += [(900, strewn, "en", "s"), (901, None, "en", "s"), (902, "", "en", "s"), (903, "Released under MIT\nLicense", "en", "s"),
             (904, "Licensed under the terms of the GNU\nLesser General Public License", "en", "s")]
    data.append((905, "be nd atoned onor on\nLicensed under CC BY-NC 4.0", "en", "s"))
    want |= {905: ["cc-by-nc"], 900: [], 901: [], 902: [], 903: ["mit"], 904: ["lgpl"]}
    got = {r.doc_id: r.template_labels for r in C.license_scan(docs(spark, data)).collect()}
    assert got == want
