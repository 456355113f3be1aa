"""Expected piece counts of the subword lattice against all segmentations."""


def test_expected_counts_look_up_a_stem_once():
    """The forward pass and the arcs in one walk: the sums of all segmentations,
    written out, and one table for pieces and stems."""
    import itertools
    import math
    from collections import Counter
    from tablewright.llm.lattice_lm import Lattice
    start = {"a": math.log(0.3), "ab": math.log(0.2)}
    inner = {"a": math.log(0.1), "b": math.log(0.2), "bc": math.log(0.15), "abc": math.log(0.05)}
    m = Lattice(start, inner, math.log(0.5), math.log(0.4))
    w, begun, got = "abcb", Counter(), Counter()
    m.expect(w, begun, got)
    weights, total = [], 0.0
    for cuts in itertools.product((0, 1), repeat=len(w) - 1):
        ends = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(w)]
        parts = [w[i:j] for i, j in zip(ends, ends[1:])]
        for bare in (True, False):
            if not bare and parts[0] not in start:
                continue
            rest = parts if bare else parts[1:]
            if any(len(p) > 1 and p not in inner for p in rest):
                continue
            p = math.exp(m.bare if bare else start[parts[0]])
            for x in rest:
                p *= math.exp(inner[x] if x in inner else m._weight(x))
            weights.append((p, "" if bare else parts[0], rest))
            total += p
    first, later = Counter(), Counter()
    for p, head, rest in weights:
        first[head] += p / total
        for x in rest:
            later[x] += p / total
    assert all(math.isclose(begun[k], v) for k, v in first.items()) and set(begun) == set(first)
    assert all(math.isclose(got[k], v) for k, v in later.items()) and set(got) == set(later)
    assert m.p_inner["ab"] == -1.0      # a stem that is no piece: one look-up tells
