"""The toxicity scores and a whole run of the pipeline against plain Python
that shares no code with the operators: matches found by looking back from each
word, lines counted in dictionaries, all pairs of fingerprints, targets by
clamping and sharing anew, and the library's own encoder. Only the fitted model
(stems and weights) is taken from the operator."""

import math
import random
import re
from collections import Counter

import pytest
import sentencepiece

import corpus_pipeline as P
from edges import word_salad
from test_dedup_mix_lines import fill
from test_simhash import reach, slow
from tablewright.llm import sentencepiece_fst, toxicity as X

LISTED = {w: c for c, ws in X.LEXICON.items() for w in ws.split()}


def plain_features(text, stems):
    words = (text or "").split()
    classes, weights, ends = [], [], []
    for w in words:
        letters = [i for i, c in enumerate(w.lower()) if re.match(r"[^\W\d_]", c)]
        core = w.lower()[letters[0]:letters[-1] + 1] if letters else ""
        cls = LISTED.get(core, "other")
        weight = 4.0 if cls == "insult" else 0.0
        if cls in ("other", "insult"):
            known = [stems[core[:n]] for n in range(4, 9) if n <= len(core) and core[:n] in stems]
            if known and max(known) > 0:
                cls, weight = "insult", max(weight, max(known))
        bare = w.rstrip("\"'‘’“”»«)") or w
        classes.append(cls)
        weights.append(weight)
        ends.append("end" if bare[-1] in ".;!?|" else "pause" if bare[-1] in ",:" else "")

    def near(cls, j, reach):
        return any(classes[i] == cls and not any(ends[i:j]) for i in range(max(0, j - reach), j))

    def told(j):
        return any(classes[i] == "report" and "end" not in ends[i:j] for i in range(j))

    sums, top, n = dict.fromkeys(("plain", "targeted", "negated", "reported", "threat"), 0.0), 0.0, 0
    for j, cls in enumerate(classes):
        if cls == "insult":
            kind = "targeted" if near("target", j, 4) else "plain"
        elif cls == "target" and near("threat", j, 4) or cls == "threat" and near("target", j, 4):
            kind = "threat"
        else:
            continue
        kind = "negated" if near("negation", j, 3) else "reported" if told(j) else kind
        w = weights[j] or 4.0
        sums[kind] += w
        top, n = max(top, w), n + 1
    return [*(math.log(1 + v) for v in sums.values()), top, math.log(1 + n), math.log(1 + 100 * n / max(1, len(words)))]


def plain_score(text, stems, weights):
    return 1 / (1 + math.exp(-weights[0] - sum(w * f for w, f in zip(weights[1:], plain_features(text, stems)))))


def test_features_of_random_clauses():
    rng = random.Random(4)
    stems = {"zorg": 2.0, "zorglub": 3.5, "idio": 6.0, "blib": 1.7}
    words = [*LISTED, "zorglubs", "zorgen", "blibber", "the", "time", "of", "12", "%%", "İdiots", "Zorg", "(zorg)"]
    marks = [""] * 8 + [",", ".", ":", "!", "?\"", ",'", ";", "|", "…", "\")"]
    g = X.Grammar(stems)
    for _ in range(3000):
        t = " ".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randrange(25)))
        assert g.features(t) == pytest.approx(plain_features(t, stems), abs=1e-12), t


def fixture():
    """Toxic and clean rows, boilerplate, exact and near copies, empty texts."""
    rng = random.Random(8)
    data, labels = [], []

    def add(text, source, toxic=0):
        data.append((len(data), text, "en", source, len(text or "")))
        labels.append((len(data) - 1, 3, toxic))

    for i in range(240):
        words = word_salad(i, rng.randint(20, 90)).split()
        toxic = i % 6 == 0
        for _ in range(5 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["zorglub", "you idiot", "zorglin"]))
        source = rng.choice(["a", "a", "a", "b", "c", "é", None])
        lines = [" ".join(words[:15]), " ".join(words[15:])] + ["all rights of " + str(source), " next page "][:rng.randrange(3)]
        add("\n".join(lines), source, int(toxic))
    for i in range(1, 40, 5):
        if not labels[i][2]:
            for k in range(3):
                add(data[i][1], data[i][3])                                    # exact copies
            for k in range(3):
                add(re.sub(r"^\S+", f"start{k}", data[i][1]), rng.choice("abc"))    # near copies
    for t in (None, "", " \n\t", "one word"):
        add(t, "b")
    return data, labels


def plain_lines_once(rows):
    pages, total = Counter(), Counter()
    for s, t in {(s, t or "") for _, t, s in rows}:
        total[s] += 1
        pages.update((s, x) for x in {y.strip(" ") for y in t.split("\n")} if x)
    gone = {k for k, n in pages.items() if n >= P.MIN_PAGES and n > 0.02 * total[k[0]]}
    return [(i, t and "\n".join(x for x in t.split("\n") if (s, x.strip(" ")) not in gone), s) for i, t, s in rows], gone


def test_run_against_plain_python(spark, tmp_path):
    data, labels = fixture()
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    known.write.parquet(str(tmp_path / "labels.parquet"))
    stems, weights = X.fit(docs, known)
    score = {r[0]: plain_score(r[1], stems, weights) for r in data}
    for r in X.toxicity(docs, known).collect():
        assert r.score == pytest.approx(score[r.doc_id], abs=1e-6)
        assert r.predicted == int(r.score >= 0.5)
    clean = [(i, t, s) for i, t, _, s, _ in data if score[i] < 0.5]
    assert {i for i, _, toxic in labels if not toxic} <= {i for i, *_ in clean} and len(clean) < len(data) - 20

    lined, gone = plain_lines_once(clean)
    assert gone and any(a != b for a, b in zip(clean, lined))
    prints = {i: slow(t) for i, t, _ in lined}
    part = reach(set(prints.values()), 2)
    first = {}
    for i, _, _ in sorted(lined):
        first.setdefault(part[prints[i]], i)
    kept = [r for r in lined if r[0] in set(first.values())]
    assert len(kept) < len(lined) - 10

    n = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in kept}
    sizes = Counter()
    for i, _, s in kept:
        sizes[s] += n[i]
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    target = fill(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, 1.5 * sum(sizes.values()), 2.0)

    lib = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_fst.MODEL)
    rows = P.run(spark, str(tmp_path)).collect()
    copies = Counter(r.doc_id for r in rows)
    assert set(copies) <= set(n)
    for s in names:
        own = [i for i, _, t in kept if t == s]
        whole = math.floor(target[s] / sizes[s] + 1e-9)
        assert all(whole <= copies[i] <= min(2, whole + 1) for i in own)
        assert abs(sum(copies[i] * n[i] for i in own) - target[s]) <= max(n[i] for i in own) + 1e-6
    text = {i: t or "" for i, t, _ in kept}
    for r in rows:
        assert list(r.ids) == lib.encode(text[r.doc_id]) and r.n_pieces == len(r.ids) and r.round_trip
