"""Language-model scoring by subword lattice likelihood.

A word's probability is summed over all its segmentations into the pieces of
an existing vocabulary: a forward recursion in log space over the lattice of
pieces. No piece spans white space, so the marginal probability of a document
is the product over its words and the end of the text.

The vocabulary's own scores (merge ranks) weight the pieces by Zipf's law.
From the training rows come the counts of words, and expected counts of the
pieces over all segmentations of the training words (one forward-backward
pass), which sharpen the weights. A word of the training rows also has its
discounted relative frequency; the mass that the discount frees goes to the
lattice (absolute discounting, the discount from the counts of counts).

Training rows may name a class (their language). Each class then has a model
of its own, mixed with a little of all classes together. A text's probability
is the sum over the classes of the class's share of the rows times the text's
probability in it. Only the text decides; the class column of a scored row is
not looked at.

Distribution: a table of distinct words is counted with a combine before the
shuffle and scored once a word. Documents meet it again by word: the most
frequent words, at most ``HEAD_WORDS``, are sent to every task; the others are
joined, and as none of them is frequent, no key is hot. The logs are summed for
every class over all words, and the classes are added up last.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import cut, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Words sent to all tasks, at most, with up to ``HEAD_CLASSES`` classes; with
#: more classes fewer words. The bound of what is broadcast.
HEAD_WORDS = 200_000
HEAD_CLASSES = 8
#: Passes that re-estimate the piece weights.
PASSES = 1
#: Share of all classes together in the model of each.
SHARED = 0.05

BLANK = "▁"
_INF = float("inf")
#: Probability kept for bytes of characters without a piece.
_BYTES = 1e-5
#: Weight of the vocabulary's own scores, in pieces, against expected counts.
_PRIOR = 200.0
#: Distinct words counted in a task before they are passed on.
_HOLD = 300_000


class Lattice:
    """Log probabilities of the pieces that begin a word and that go on in
    one, of a bare beginning, of the end of a word, and of a byte."""

    def __init__(self, start: dict[str, float], inner: dict[str, float], bare: float, stop: float):
        self.start, self.inner, self.bare, self.stop = start, inner, bare, stop
        self.byte = math.log(_BYTES / 256)
        self.start_stems = {p[:n] for p in start for n in range(1, len(p) + 1)}
        self.inner_stems = {p[:n] for p in inner for n in range(1, len(p) + 1)}

    def arcs(self, w: str) -> list[list[tuple[int, str]]]:
        """For each place of a word the arcs that leave it, as where to and
        which piece. The last of the list holds the pieces that begin the
        word. Every lattice of one vocabulary has the same arcs."""
        n, out = len(w), []
        pieces, stems = self.inner, self.inner_stems
        for i in range(n):
            row, j, sub = [], i + 1, w[i]
            if sub not in pieces:
                row.append((j, sub))
            while sub in stems:
                if sub in pieces:
                    row.append((j, sub))
                j += 1
                if j > n:
                    break
                sub = w[i:j]
            out.append(row)
        row, j = [], 1
        while j <= n and (sub := w[:j]) in self.start_stems:
            if sub in self.start:
                row.append((j, sub))
            j += 1
        out.append(row)
        return out

    def _weight(self, piece: str) -> float:
        """Of a character without a piece: that of its bytes."""
        return self.byte * len(piece.encode("utf-8", "surrogatepass"))

    def _forward(self, w: str, arcs: list) -> list[float]:
        n, log1p, exp = len(w), math.log1p, math.exp
        weight, start = self.inner, self.start
        a = [-_INF] * (n + 1)
        a[0] = self.bare
        for j, sub in arcs[n]:
            a[j] = start[sub]
        for i in range(n):
            at = a[i]
            for j, sub in arcs[i]:
                p = weight.get(sub)
                x, y = at + (self._weight(sub) if p is None else p), a[j]
                if x < y:
                    x, y = y, x
                a[j] = x + log1p(exp(y - x)) if y > -700.0 + x else x
        return a

    def log_prob(self, w: str, arcs: list | None = None) -> float:
        """Natural log of the word's probability, over all segmentations."""
        return self._forward(w, self.arcs(w) if arcs is None else arcs)[len(w)] + self.stop

    def expect(self, w: str, begun: Counter, inner: Counter) -> None:
        """Adds the expected counts of the pieces over all segmentations:
        products of probabilities, or of their logs where those would come
        too near to zero."""
        n, exp = len(w), math.exp
        if not hasattr(self, "p_inner"):        # of a stem that is no piece, -1
            self.p_inner, self.p_start = dict.fromkeys(self.inner_stems, -1.0), dict.fromkeys(self.start_stems, -1.0)
            self.p_inner.update((k, exp(v)) for k, v in self.inner.items())
            self.p_start.update((k, exp(v)) for k, v in self.start.items())
            self.p_bare = exp(self.bare)
        p_inner, p_start = self.p_inner, self.p_start
        a = [0.0] * (n + 1)
        a[0] = self.p_bare
        firsts, row_of = [], []
        for j in range(1, n + 1):
            if (p := p_start.get(sub := w[:j])) is None:
                break
            if p >= 0.0:
                a[j] = p
                firsts.append((j, p, sub))
        for i in range(n):
            at, j, sub, row = a[i], i + 1, w[i], []
            if (p := p_inner.get(sub)) is None or p < 0.0:
                x = exp(self._weight(sub))
                row.append((j, x, sub))
                a[j] += at * x
            while p is not None:
                if p >= 0.0:
                    row.append((j, p, sub))
                    a[j] += at * p
                j += 1
                if j > n:
                    break
                p = p_inner.get(sub := w[i:j])
            row_of.append(row)
        if a[n] < 1e-200:
            return self._expect_logs(w, self.arcs(w), begun, inner)
        b = [0.0] * n + [1.0 / a[n]]
        for i in range(n - 1, -1, -1):
            at, x = a[i], 0.0
            for j, p, sub in row_of[i]:
                y = p * b[j]
                x += y
                inner[sub] += at * y
            b[i] = x
        begun[""] += self.p_bare * b[0]
        for j, p, sub in firsts:
            begun[sub] += p * b[j]

    def _expect_logs(self, w: str, arcs: list, begun: Counter, inner: Counter) -> None:
        n, exp, log1p = len(w), math.exp, math.log1p
        weighed = [[(j, self.inner[s] if s in self.inner else self._weight(s), s) for j, s in row] for row in arcs[:n]]
        a = self._forward(w, arcs)
        b = [-_INF] * n + [0.0]
        for i in range(n - 1, -1, -1):
            x = -_INF
            for j, p, _ in weighed[i]:
                y = p + b[j]
                hi, lo = (x, y) if x > y else (y, x)
                x = hi + log1p(exp(lo - hi)) if lo > -700.0 + hi else hi
            b[i] = x
        total = a[n]
        for i in range(n):
            for j, p, sub in weighed[i]:
                inner[sub] += exp(a[i] + p + b[j] - total)
        begun[""] += exp(self.bare + b[0] - total)
        for j, sub in arcs[n]:
            begun[sub] += exp(self.start[sub] + b[j] - total)


class Joint:
    """The lattices of all classes over one vocabulary: a word's arcs are
    found once and its forward recursion runs for all classes at once, place
    by place over many words."""

    def __init__(self, lattices: list[Lattice]):
        import numpy as np
        one = lattices[0]
        # a stem that is no piece has -1
        self.inner, self.start = dict.fromkeys(one.inner_stems, -1), dict.fromkeys(one.start_stems, -1)
        self.inner.update((p, i) for i, p in enumerate(one.inner))
        self.start.update((p, len(one.inner) + i) for i, p in enumerate(one.start))
        self.bytes = len(one.inner) + len(one.start) - 1   # ... + bytes of a character without a piece
        self.weight = np.array([[*m.inner.values(), *m.start.values(), *(m.byte * n for n in (1, 2, 3, 4))] for m in lattices]).T.copy()
        self.bare = np.array([m.bare for m in lattices])
        self.stop = np.array([m.stop for m in lattices])

    def log_probs(self, words: list[str]):
        """Natural logs of the words' probabilities over all segmentations: a
        row for each word, a column for each class."""
        import numpy as np
        inner, start, many_bytes = self.inner, self.start, self.bytes
        base, bases, ends = 0, [], []
        first_to, first_piece = [], []                  # arcs of the pieces that begin a word
        place, of, leaves, to, piece = [], [], [], [], []
        for w in words:
            n = len(w)
            for j in range(1, n + 1):
                p = start.get(w[:j])
                if p is None:
                    break
                if p >= 0:
                    first_to.append(base + j)
                    first_piece.append(p)
            for i in range(n):
                before, j, sub = len(to), i + 1, w[i]
                p = inner.get(sub)
                if p is None or p < 0:
                    to.append(base + j)
                    piece.append(many_bytes + len(sub.encode("utf-8", "surrogatepass")))
                while p is not None:
                    if p >= 0:
                        to.append(base + j)
                        piece.append(p)
                    j += 1
                    if j > n:
                        break
                    p = inner.get(w[i:j])
                leaves.append(len(to) - before)
            of.extend(range(base, base + n))
            place.extend(range(n))
            bases.append(base)
            base += n + 1
            ends.append(base - 1)
        a = np.full((base, len(self.bare)), -_INF)
        a[bases] = self.bare
        a[first_to] = self.weight[first_piece]
        step, source = np.repeat(place, leaves), np.repeat(of, leaves)
        order = np.argsort(step, kind="stable")
        source, to, piece = source[order], np.array(to, dtype=np.int64)[order], np.array(piece, dtype=np.int64)[order]
        cuts = np.cumsum(np.bincount(step)) if len(step) else []
        at = 0
        for end in cuts:                                # of one place no two arcs lead to the same
            t = to[at:end]
            a[t] = np.logaddexp(a[t], a[source[at:end]] + self.weight[piece[at:end]])
            at = end
        return a[ends] + self.stop


def _runs(words: list[str], characters: int = 32_768) -> Iterator[list[str]]:
    """``words`` in order, in lists of so many characters or of one word."""
    held, size = [], 0
    for w in words:
        if held and size + len(w) > characters:
            yield held
            held, size = [], 0
        held.append(w)
        size += len(w)
    if held:
        yield held


def _prior(model: str) -> tuple[dict[str, float], dict[str, float]]:
    """Zipf weights of the vocabulary: pieces that begin a word ('' is the
    bare blank) and pieces within one, each summing to one."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    m = pb.ModelProto()
    m.ParseFromString(Path(model).read_bytes())
    begun, inner = {"": 0.05}, {}
    for rank, p in enumerate(m.pieces):
        if p.type in (1, 4) and p.piece.strip(BLANK):
            weight = 1.0 / (rank + 10)
            if p.piece[0] == BLANK and BLANK not in p.piece[1:]:
                begun[p.piece[1:]] = weight
            elif BLANK not in p.piece:
                inner[p.piece] = weight
    return tuple({k: v / sum(d.values()) for k, v in d.items()} for d in (begun, inner))


def _lattice(prior: tuple, begun: dict, inner: dict, words: float) -> Lattice:
    """The lattice of the prior weights and expected counts over ``words``
    words."""
    def mixed(p: dict, got: dict) -> dict:
        total = _PRIOR + sum(got.get(k, 0.0) for k in p)
        return {k: (_PRIOR * v + got.get(k, 0.0)) / total for k, v in p.items()}

    first, rest = mixed(prior[0], begun), mixed(prior[1], inner)
    steps = sum(inner.values())
    # mean pieces within a word after the first; without counts, 1.5
    stop = (words + 1.0) / (words + steps + 2.5)
    left = 1.0 - stop - _BYTES
    log = math.log
    return Lattice({k: log(v) for k, v in first.items() if k}, {k: log(left * v) for k, v in rest.items()},
                   log(first[""]), log(stop))


def tokens(raw: bytes | None) -> list[bytes]:
    """The words of a text in UTF-8, A-Z lower-cased: ``bytes.lower`` changes
    no other letters, and ``bytes.split`` cuts at the six blanks."""
    return raw.lower().split() if raw else []


def count_words(d: DataFrame, classes: int) -> DataFrame:
    """(word, c, n) of ``d`` (_text, _class): occurrences of every word in the
    training rows of each class, as an array, and in all rows. Rows with a
    null class are not learned from."""
    def rows(counts: list[Counter]):
        import pyarrow as pa
        words = [w for c in counts for w in c]
        kind = [k - 1 for k, c in enumerate(counts) for _ in c]
        return pa.RecordBatch.from_pydict({
            "word": pa.array(words, pa.binary()).cast(pa.string()), "k": pa.array(kind, pa.int32()),
            "x": pa.array([x for c in counts for x in c.values()], pa.int64())})

    def run(batches: Iterator) -> Iterator:
        counts = [Counter() for _ in range(classes + 1)]  # those not learned from come first
        for b in slices(batches):
            for t, k in zip(b.column(0).cast("binary").to_pylist(), b.column(1).to_pylist()):
                counts[0 if k is None else k + 1].update(tokens(t))
                if sum(map(len, counts)) > _HOLD:
                    yield rows(counts)
                    for c in counts:
                        c.clear()
        yield rows(counts)

    of = [F.coalesce(F.sum(F.when(F.col("k") == k, F.col("x"))), F.lit(0)) for k in range(classes)]
    return (d.select("_text", "_class").mapInArrow(run, "word string, k int, x long")
            .groupBy("word").agg(F.array(*of).alias("c"), F.sum("x").alias("n")))


def re_estimate(words: DataFrame, prior: tuple, lattices: list[Lattice], types: list[int]) -> list[Lattice]:
    """One forward-backward pass over the distinct training words of every
    class. What comes to the driver is a number a piece and class: the
    vocabulary bounds it."""
    sent = words.sparkSession.sparkContext.broadcast(lattices)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        got = [(Counter(), Counter()) for _ in sent.value]
        for b in slices(batches):
            for w, c in zip(b.column("word").to_pylist(), b.column("c").to_pylist()):
                for k, x in enumerate(c):
                    if x:
                        sent.value[k].expect(w, *got[k])
        for k, pair in enumerate(got):
            for first, g in zip((True, False), pair):
                yield pa.RecordBatch.from_pydict({
                    "k": pa.array([k] * len(g), pa.int32()), "first": pa.array([first] * len(g), pa.bool_()),
                    "piece": pa.array(list(g), pa.string()), "x": pa.array(list(g.values()), pa.float64())})

    got = (words.select("word", "c").mapInArrow(run, "k int, first boolean, piece string, x double")
           .groupBy("k", "first", "piece").agg(F.sum("x").alias("x")).collect())
    by: dict = {}
    for r in got:
        by.setdefault((r.k, r["first"]), {})[r.piece] = r.x
    return [_lattice(prior, by.get((k, True), {}), by.get((k, False), {}), types[k]) for k in range(len(lattices))]


def score_words(words: DataFrame, lattices: list[Lattice], totals: list[int], types: list[int],
                shares: list[float], discount: float) -> DataFrame:
    """(word, c, n, lm): ``c`` over all classes, ``lm`` the log10 probability
    of the word in each class. Every word has its lattice probability in
    every class, whether or not a training row of the class holds it."""
    sent = words.sparkSession.sparkContext.broadcast(lattices)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        m, many = Joint(sent.value), np.array(totals, dtype=float)
        spared = np.array([math.log(discount * t / n) if n else math.log(0.5) for t, n in zip(types, totals)])
        own = math.log(1.0 - SHARED) if len(totals) > 1 else 0.0
        mixed = np.array([math.log(SHARED * s) if s and len(totals) > 1 else -_INF for s in shares])
        for b in slices(batches, 4096):
            c = np.array(b.column("c").flatten()).reshape(b.num_rows, -1)
            p = np.concatenate([m.log_probs(w) for w in _runs(b.column("word").to_pylist())]) + spared
            held = c > 0
            seen = np.full(p.shape, -_INF)
            seen[held] = np.log(((c - discount) / np.where(many > 0, many, 1.0))[held])
            p = np.logaddexp(p, seen)
            every = np.logaddexp.reduce(p + mixed, axis=1)
            out = np.logaddexp(p + own, every[:, None]) / math.log(10.0)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, out.shape[1]), pa.int32()), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays(
                [b.column("word"), pa.array(c.sum(axis=1), pa.int64()), b.column("n"), lists], names=["word", "c", "n", "lm"])

    return words.mapInArrow(run, "word string, c long, n long, lm array<double>")


def head_of(words: DataFrame, limit: int) -> tuple:
    """The most frequent words, ``limit`` at most: whole classes of near
    frequency, from the top down. Words with their place, counts, scores."""
    import numpy as np
    level = F.floor(F.log2("n") * 16).cast("int")
    rows, least = 0, None
    for r in words.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():  # some hundred rows
        rows += r["count"]
        if rows > limit:
            break
        least = r.level
    if least is None:
        return {}, np.zeros(0), np.zeros((0, 1))
    t = words.where(level >= least).select("word", "c", "lm").toArrow()
    lm = np.array(t.column("lm").combine_chunks().flatten()).reshape(t.num_rows, -1)
    return {w: i for i, w in enumerate(t.column("word").cast("binary").to_pylist())}, np.array(t.column("c")), lm


def lm_score(docs: DataFrame, train: str, key: str = "doc_id", text: str = "text", kind: str | None = None,
             model: str = MODEL, head_words: int = HEAD_WORDS, passes: int = PASSES) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``n_tokens`` (words and an end),
    ``n_known`` (tokens that the training rows hold), ``train_tokens``,
    ``base_score`` (unigrams with 0.5 added) and ``score``, the model's log10
    probability of the text, over all classes and segmentations. ``train`` names a boolean column: rows to learn from;
    ``kind`` a column with the class of a training row.

    Null and empty texts are an end alone. Without training rows the
    vocabulary's own weights score the words. Every class has a model, the rows
    of a null class one more; memory is a vocabulary a class. Long words take time linear in their
    length. Repeated rows stay repeated, an empty table gives no rows, other
    columns of ``docs`` are ignored, whatever their names."""
    import numpy as np
    d = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"),
                    F.coalesce(F.col(train), F.lit(False)).alias("_train"),
                    (F.col(kind).cast("string") if kind else F.lit(None).cast("string")).alias("_kind"))
    learned = d.where("_train").groupBy("_kind").count()
    top = learned.where("_kind is not null").orderBy(F.desc("count"), "_kind").collect()  # one row a class
    ends = learned.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    number = F.lit(len(top))
    for k, r in enumerate(top):
        number = F.when(F.col("_kind") == r["_kind"], F.lit(k)).otherwise(number)
    d = d.withColumn("_class", F.when(F.col("_train"), number).cast("int"))
    in_class = [r["count"] for r in top] + [ends - sum(r["count"] for r in top)]
    if len(in_class) > 1 and not in_class[-1]:
        in_class.pop()  # no row without a class of its own
    classes = len(in_class)

    words = cut(count_words(d, classes))
    every = F.aggregate("c", F.lit(0).cast("long"), lambda a, x: a + x)
    f = words.agg(
        F.coalesce(F.sum(every), F.lit(0)).alias("tokens"), F.count_if(every > 0).alias("types"),
        F.count_if(every == 1).alias("once"), F.count_if(every == 2).alias("twice"),
        *[F.coalesce(F.sum(F.get("c", F.lit(k))), F.lit(0)).alias(f"tokens{k}") for k in range(classes)],
        *[F.count_if(F.get("c", F.lit(k)) > 0).alias(f"types{k}") for k in range(classes)]).first()
    total, distinct = f.tokens + ends, f.types + (ends > 0)
    totals = [f[f"tokens{k}"] + n if f[f"tokens{k}"] else 0 for k, n in enumerate(in_class)]
    types = [f[f"types{k}"] for k in range(classes)]
    shares = [n / ends if ends else 1.0 for n in in_class]
    discount = min(0.95, max(0.1, f.once / (f.once + 2.0 * f.twice))) if f.once else 0.5

    prior = _prior(model)
    lattices = [_lattice(prior, {}, {}, 0) for _ in range(classes)]
    for _ in range(passes if f.types else 0):
        lattices = re_estimate(words, prior, lattices, types)
    scored = cut(score_words(words, lattices, totals, types, shares, discount))
    head = docs.sparkSession.sparkContext.broadcast(head_of(scored, head_words * HEAD_CLASSES // max(HEAD_CLASSES, classes)))

    floor = total + 0.5 * (distinct + 1)
    end_base = math.log10((ends + 0.5) / floor)
    end_lm = math.log10(ends / total) if ends else math.log10(0.5)
    entry = [math.log10(s) if s else -1e9 for s in shares]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        at, c, lm = head.value
        known, base = c > 0, np.log10((c + 0.5) / floor)
        for b in slices(batches):
            cols: list[list] = [[] for _ in range(7)]
            for i, t in enumerate(b.column("_text").cast("binary").to_pylist()):
                counts = Counter(tokens(t))
                place = np.fromiter((at.get(w, -1) for w in counts), dtype=np.int64, count=len(counts))
                many = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
                held = place >= 0
                here, many = place[held], many[held]
                by_class = np.array(entry) + (many @ lm[here] if len(here) else 0.0)
                rest = [] if len(here) == len(counts) else [x for x, h in zip(counts.items(), held.tolist()) if not h]
                n = len(rest)
                # no word holds a blank: the key of the row of sums joins with
                # nothing, and differs from row to row so that they do not meet
                tokens_here = 1 + sum(counts.values())
                for col, values in zip(cols, (
                        [i] * (n + 1), [w for w, _ in rest] + [b" %d %d" % (i, tokens_here)], [m for _, m in rest] + [0],
                        [0] * n + [int(ends > 0) + int(many @ known[here]) if len(here) else int(ends > 0)],
                        [0.0] * n + [end_base + (float(many @ base[here]) if len(here) else 0.0)],
                        [None] * n + [(end_lm + by_class).tolist()], [0] * n + [tokens_here])):
                    col += values
            row = pa.array(cols[0], pa.int32())
            kinds = (pa.int32(), pa.int64(), pa.float64(), pa.list_(pa.float64()), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("_key").take(row), b.column("_row").take(row), pa.array(cols[1], pa.binary()).cast(pa.string()),
                 *(pa.array(x, t) for x, t in zip(cols[2:], kinds))],
                names=["_key", "_row", "word", "_many", "_known", "_base", "_lm", "_n"])

    of = d.schema["_key"].dataType.simpleString()
    rows = d.select("_key", "_text", F.xxhash64("_key", "_text").alias("_row")).mapInArrow(
        run, f"_key {of}, _row long, word string, _many int, _known long, _base double, _lm array<double>, _n long")
    c = F.coalesce("c", F.lit(0))
    many = F.col("_many")
    met = rows.join(scored.select("word", "c", "lm"), "word", "left").select(
        "_key", "_row", "_n", (F.col("_known") + F.when(c > 0, many).otherwise(0)).alias("_known"),
        (F.col("_base") + F.when(many > 0, many * F.log10((c + 0.5) / F.lit(floor))).otherwise(0.0)).alias("_base"),
        *[F.when(many > 0, many * F.get("lm", F.lit(k))).otherwise(F.get("_lm", F.lit(k))).alias(f"_lm{k}") for k in range(classes)])
    # rows with equal key and text were summed as one: _same of them
    sums = met.groupBy("_key", "_row").agg(
        F.count_if(F.col("_n") > 0).alias("_same"), F.max("_n").alias("_n"), F.sum("_known").alias("_known"),
        F.sum("_base").alias("_base"), F.array(*[F.sum(f"_lm{k}") for k in range(classes)]).alias("_lm"))
    sums = sums.withColumn("_lm", F.transform("_lm", lambda x: x / F.col("_same"))).withColumn("_best", F.array_max("_lm"))
    rest = F.aggregate("_lm", F.lit(0.0), lambda a, x: a + F.pow(F.lit(10.0), x - F.col("_best")))
    each = sums.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_same").cast("int"))))
    return each.select(F.col("_key").alias(key), F.col("_n").alias("n_tokens"),
                       F.floor(F.col("_known") / F.col("_same") + 0.5).cast("long").alias("n_known"),
                       F.lit(total).cast("long").alias("train_tokens"),
                       (F.col("_base") / F.col("_same")).alias("base_score"), (F.col("_best") + F.log10(rest)).alias("score"))
