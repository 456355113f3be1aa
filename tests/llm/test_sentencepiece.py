"""The transducer against the library's encoder and an exact round trip."""

import random

import pytest
import sentencepiece

from edges import docs, rows, word_salad
from tablewright.llm import sentencepiece_fst as P


@pytest.fixture(scope="module")
def both():
    return P.Transducer(open(P.MODEL, "rb").read()), sentencepiece.SentencePieceProcessor(model_file=P.MODEL)


def test_equals_library(both):
    fst, lib = both
    rng = random.Random(2)
    bits = ["a", "the", "ing", " ", "  ", "\n", "\t", "é", "日", "😀", ".", "1", "▁", "İ", "　", "​", "#", "ß"]
    texts = [" " * n + s for n in range(40) for s in ("", "the cat", "日")] + ["a" * 500, "\n\n x", "x\n y\n  z"]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randint(0, 15))) for _ in range(4000)]
    pieces = [lib.id_to_piece(i).replace("▁", " ") for i in range(259, lib.vocab_size())]
    texts += pieces + ["".join(rng.choice(pieces) for _ in range(3)) for _ in range(4000)] + [word_salad(1, 3000)]
    for t in texts:
        assert fst.encode(t) == lib.encode(t), t
        if "▁" not in t:
            assert fst.decode(fst.encode(t)) == t


def test_unigram_model_takes_the_least_weight():
    """A small unigram model, written by hand: the best path against all paths."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    m = pb.ModelProto()
    m.trainer_spec.model_type = 1
    m.normalizer_spec.add_dummy_prefix = True
    m.normalizer_spec.remove_extra_whitespaces = False
    rng = random.Random(4)
    m.pieces.add(piece="<unk>", score=0.0, type=2)
    scores = {p: -rng.uniform(1, 9) for p in ["▁", "a", "b", "ab", "ba", "▁a", "▁ab", "aba", "bab", "bb", "▁ba"]}
    for p, s in scores.items():
        m.pieces.add(piece=p, score=s, type=1)
    t = P.Transducer(m.SerializeToString())
    ids = {p: i + 1 for i, p in enumerate(scores)}

    def best(s):
        if not s:
            return 0.0
        return max((scores[s[:n]] + best(s[n:]) for n in range(1, 4) if s[:n] in scores), default=float("-inf"))

    back = {i: p for p, i in ids.items()}
    for _ in range(300):
        s = "".join(rng.choice("ab ") for _ in range(rng.randint(1, 8)))
        got = [back[i] for i in t.encode(s)]
        assert "".join(got) == "▁" + s.replace(" ", "▁")
        assert abs(sum(scores[p] for p in got) - best("▁" + s.replace(" ", "▁"))) < 1e-4


def test_caches_that_overflow_change_nothing(both, monkeypatch):
    text = word_salad(8, 4000)
    monkeypatch.setattr(P, "CACHE", 50)
    assert P.Transducer(open(P.MODEL, "rb").read()).encode(text) == both[1].encode(text)


def test_operator_edges(spark, both):
    got = sorted(((r.doc_id or 0, r.ids) for r in P.encode(docs(spark)).collect()), key=str)
    assert got == sorted(((r[0] or 0, both[1].encode(r[1] or "")) for r in rows()), key=str)
    assert all(r.round_trip and r.n_pieces == len(r.ids) for r in P.encode(docs(spark)).collect())
    assert P.encode(docs(spark, [])).count() == 0
    d = docs(spark, [(1, "a▁b", "en", "s")], clash=False)
    assert not P.encode(d).first().round_trip


def test_decode(spark):
    d = docs(spark, [r for r in rows() if r[0] not in (None, 11)], clash=False)
    texts = {r.doc_id: r.text for r in P.decode(P.encode(d)).collect()}
    assert texts == {r[0]: r[1] or "" for r in rows() if r[0] not in (None, 11)}
