"""Toxicity by a weighted finite-state pattern grammar.

Small transducers read a text's words by class (insult, threat, target,
negation, reported speech, end of clause): one holds a negation open for a few
words, one a report until its clause ends, one a target, one a threat that
waits for its target. Their composition is a single machine whose arcs write
what kind of match a word completes: an insult that is plain, aimed at a
target, negated or reported, or a threat. So clauses are scored, not words:
the same insult counts by its surroundings.

The insults are a fixed list of English words and, as such lists exist for few
languages, stems learned from labelled rows: beginnings of words that toxic
rows hold far more often, weighted by log odds. How much each kind of match
counts is a logistic regression on labelled rows that the stems have not seen.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import cut, slices, text_or_empty

#: Labelled rows that are learned from, at most about this many.
SAMPLE_ROWS = 20_000
#: Stems that are kept, strongest first.
MAX_STEMS = 5_000
#: Rows that must hold a stem, and the least log odds of one.
MIN_ROWS, MIN_ODDS = 4, 1.5
STEM_LENGTHS = (4, 5, 6, 7, 8)

# English words by class.
LEXICON = {
    "insult": "idiot idiots clown clowns scum moron morons worthless pathetic disgusting trash loser losers stupid "
              "dumb fool fools jerk imbecile vermin garbage filthy coward cowards ugly liar liars",
    "threat": "kill hurt destroy beat burn shoot stab hang smash strangle",
    "target": "you your yours he him his she her they them their these those people everyone",
    "negation": "not no never neither nor isn't aren't wasn't weren't don't doesn't hardly",
    "report": "said says say called calls claimed claims wrote quoted quotes reported alleged according",
}
#: Log odds of a listed insult of which the labels say nothing.
PRIOR = 4.0

CLASSES = ("other", "insult", "threat", "target", "negation", "report", "end", "pause")
KINDS = ("plain", "targeted", "negated", "reported", "threat")
_OTHER, _INSULT, _THREAT, _TARGET, _NEGATION, _REPORT, _END, _PAUSE = range(len(CLASSES))


def _held(opens: int, words: int):
    """A transducer that stays open for ``words`` words after a class: its
    states count down. An end of clause closes it, and so does a pause."""
    def step(state: int, cls: int) -> int:
        return 0 if cls in (_END, _PAUSE) else words if cls == opens else max(0, state - 1)
    return step


def _until_end(opens: int):
    """Open until the clause ends; what is said begins after a pause."""
    def step(state: int, cls: int) -> int:
        return 0 if cls == _END else 1 if cls == opens else state
    return step


PARTS = (_held(_NEGATION, 3), _until_end(_REPORT), _held(_TARGET, 4), _held(_THREAT, 4))


def _kind(state: tuple, cls: int) -> int:
    """What the word of class ``cls`` completes in ``state``; -1: nothing."""
    negated, reported, target, threat = state
    if cls == _INSULT:
        return 2 if negated else 3 if reported else 1 if target else 0
    if (cls == _TARGET and threat) or (cls == _THREAT and target):
        return 2 if negated else 3 if reported else 4
    return -1


def compose() -> list[list[tuple[int, int]]]:
    """The product of ``PARTS``: for each reachable state and class the next
    state and the kind of match written."""
    start = (0,) * len(PARTS)
    number, todo, table = {start: 0}, [start], []
    while todo:
        state = todo.pop(0)
        row = []
        for cls in range(len(CLASSES)):
            to = tuple(p(s, cls) for p, s in zip(PARTS, state))
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            row.append((number[to], _kind(state, cls)))
        table.append(row)
    return table


_EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")
#: What a word ends with where a clause ends, and where it only pauses.
_ENDS = dict.fromkeys(".;!?|", _END) | dict.fromkeys(",:", _PAUSE)
_QUOTES = "\"'\u2018\u2019\u201c\u201d\u00bb\u00ab)"


class Grammar:
    """The composed machine with a lexicon of stems."""

    def __init__(self, stems: dict[str, float]):
        self.table = compose()
        self.stems = stems
        self.fixed = {w: CLASSES.index(c) for c, ws in LEXICON.items() for w in ws.split()}
        self.seen: dict[str, tuple] = {}

    def word(self, raw: str) -> tuple[int, float, int]:
        """Class and weight of a word, and the class of what follows it: 0, or
        an end or a pause, whether or not a quotation closes behind that."""
        if len(self.seen) >= 1 << 18:
            self.seen.clear()
        core = _EDGES.sub("", raw.lower())
        cls = self.fixed.get(core, _OTHER)
        weight = PRIOR if cls == _INSULT else 0.0
        if cls in (_OTHER, _INSULT):
            learned = max((self.stems.get(core[:n], 0.0) for n in STEM_LENGTHS if n <= len(core)), default=0.0)
            if learned > 0:
                cls, weight = _INSULT, max(weight, learned)
        out = self.seen[raw] = (cls, weight, _ENDS.get((raw.rstrip(_QUOTES) or raw)[-1], 0))
        return out

    def features(self, text: str | None) -> list[float]:
        """For every kind the matches' summed weight, then the largest weight,
        the number of matches and their share of the words, on log scales."""
        sums, top, n, state = [0.0] * len(KINDS), 0.0, 0, 0
        words, table, seen = (text or "").split(), self.table, self.seen
        for raw in words:
            cls, weight, ends = seen.get(raw) or self.word(raw)
            state, kind = table[state][cls]
            if kind >= 0:
                n += 1
                w = weight or PRIOR
                sums[kind] += w
                top = max(top, w)
            if ends:
                state = table[state][ends][0]
        rate = 100.0 * n / max(1, len(words))
        return [*map(math.log1p, sums), top, math.log1p(n), math.log1p(rate)]


N_FEATURES = len(KINDS) + 3


def fold(key: str) -> Column:
    """crc32 of the key as text, modulo 5; fold 0 is held out."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str,
                    sample_rows: int) -> DataFrame:
    """(_fold, _text, _toxic) of about ``sample_rows`` labelled rows outside
    fold 0, near copies left out: of rows that share the least hash of their
    five-word shingles one stays, so that a text copied often does not make
    its words into stems."""
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_toxic")).where(
        "_toxic is not null and _key is not null").where(fold("_key") != 0)
    share = min(1.0, sample_rows / max(1, known.count()))
    # at most about sample_rows small rows: that bounds the broadcast
    known = known.where(F.pmod(F.xxhash64("_key", F.lit(7)), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    known = known.groupBy("_key").agg(F.max("_toxic").alias("_toxic")).limit(2 * sample_rows)
    d = docs.select(F.col(key).alias("_key"), text_or_empty(text).alias("_text"))
    d = d.join(F.broadcast(known), "_key").withColumn("_fold", fold("_key"))

    def sign(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from xxhash import xxh64_intdigest
        for b in slices(batches):
            mins = []
            for t in b.column("_text").to_pylist():
                w = t.split()
                mins.append(min((xxh64_intdigest(" ".join(w[i:i + 5])) >> 1 for i in range(max(1, len(w) - 4))), default=0))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(mins, pa.int64())], names=[*b.schema.names, "_least"])

    d = d.select("_key", "_text", "_toxic", F.col("_fold").cast("int").alias("_fold"))
    kind = d.schema["_key"].dataType.simpleString()
    signed = d.mapInArrow(sign, f"_key {kind}, _text string, _toxic int, _fold int, _least long")
    one = signed.groupBy("_least", "_toxic").agg(F.min_by(F.struct("_text", "_fold"), "_key").alias("_r"))
    return cut(one.select("_r._fold", "_r._text", "_toxic"))


def _stems_of(text: str) -> set[str]:
    cores = {_EDGES.sub("", w) for w in set(text.lower().split())}
    return {c[:n] for c in cores for n in STEM_LENGTHS if n <= len(c)}


def _stem_rows(rows: DataFrame, only: frozenset | None) -> DataFrame:
    """(stem, n): in how many of ``rows`` (_text) each stem stands."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        count: Counter = Counter()
        for b in slices(batches):
            for t in b.column(0).to_pylist():
                found = _stems_of(t)
                count.update(found if only is None else found & only)
        if count:
            yield pa.RecordBatch.from_pydict({"stem": pa.array(list(count), pa.string()), "n": pa.array(list(count.values()), pa.int64())})

    return rows.select("_text").mapInArrow(run, "stem string, n long").groupBy("stem").agg(F.sum("n").alias("n"))


def learn_stems(sample: DataFrame, min_rows: int = MIN_ROWS, min_odds: float = MIN_ODDS,
                max_stems: int = MAX_STEMS) -> dict[str, float]:
    """Stem to log odds, from a bounded sample; the ``max_stems`` highest
    stay. Only stems that ``min_rows`` toxic rows hold are counted in the
    others. The driver sees all of those: the sample's rows are their bound."""
    toxic, clean = sample.where("_toxic = 1"), sample.where("_toxic = 0")
    n1, n0 = toxic.count(), clean.count()
    if not n1 or not n0:
        return {}
    held = {r.stem: r.n for r in _stem_rows(toxic, None).where(F.col("n") >= min_rows).collect()}
    wanted = frozenset(held)
    rare = {r.stem: r.n for r in _stem_rows(clean, wanted).collect()}
    odds = {s: math.log((n + 0.5) / (n1 + 1)) - math.log((rare.get(s, 0) + 1.0) / (n0 + 1)) for s, n in held.items()}
    out: dict[str, float] = {}
    for s in sorted(odds, key=lambda s: (len(s), s)):
        known = max((out[s[:n]] for n in STEM_LENGTHS if n < len(s) and s[:n] in out), default=0.0)
        if odds[s] >= min_odds and odds[s] > known + 0.5:
            out[s] = odds[s]
    return dict(sorted(out.items(), key=lambda x: (-x[1], x[0]))[:max_stems])


def _featured(rows: DataFrame, stems: dict[str, float], keep: str) -> DataFrame:
    """``keep`` and the features of ``_text``, as ``f0``, ``f1``, ..."""
    sent = rows.sparkSession.sparkContext.broadcast(stems)
    names = [f"f{i}" for i in range(N_FEATURES)]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        g = Grammar(sent.value)
        for b in slices(batches):
            found = [g.features(t) for t in b.column(1).to_pylist()]
            cols = [pa.array([f[i] for f in found], pa.float64()) for i in range(N_FEATURES)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=[keep, *names])

    d = rows.select(keep, "_text")
    kind = d.schema[keep].dataType.simpleString()
    return d.mapInArrow(run, f"`{keep}` {kind}, " + ", ".join(f"{n} double" for n in names))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        sample_rows: int = SAMPLE_ROWS) -> tuple[dict[str, float], list[float]]:
    """(stems, weights): the weights of the features, the constant first.

    Stems come from folds 1 to 3 and weights from fold 4. Without rows of both
    labels the listed insults alone decide: a fixed weight for the largest
    match."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    sample = labelled_sample(docs, labels, key, text, label, sample_rows)
    stems = learn_stems(sample.where("_fold <> 4"))
    rows = cut(_featured(sample.where("_fold = 4"), stems, "_toxic"))
    if rows.select("_toxic").distinct().count() < 2:
        return stems, [-2.0] + [0.0] * len(KINDS) + [1.0, 0.0, 0.0]
    names = [f"f{i}" for i in range(N_FEATURES)]
    d = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    m = LogisticRegression(labelCol="_toxic", regParam=0.002, maxIter=60).fit(d)
    return stems, [float(m.intercept), *map(float, m.coefficients)]


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
             label: str = "toxic", sample_rows: int = SAMPLE_ROWS, threshold: float = 0.5) -> DataFrame:
    """(key, score, predicted) for every row of ``docs``: the probability that
    its label is 1, and 1 if it reaches ``threshold``. Only the text is scored;
    labels of fold 0 are never seen.

    A null or empty text has no matches and gets the score of such texts. Long
    texts are read whole, in time linear in their length. Repeated rows stay
    repeated, an empty table gives no rows, an empty label table leaves the
    listed words; other columns are ignored, whatever their names."""
    stems, weights = fit(docs, labels, key, text, label, sample_rows)
    d = _featured(docs.select(F.col(key), F.col(text).alias("_text")), stems, key)
    z = F.lit(weights[0])
    for i, w in enumerate(weights[1:]):
        z = z + F.lit(w) * F.col(f"f{i}")
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    return d.select(key, score.alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def toxic_filter(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """``docs`` without the rows that are predicted toxic. Null and empty
    texts score as texts without a match and stay; repeated rows go or stay
    together; no rows give no rows; all columns stay as they are."""
    stems, weights = fit(docs, labels, key, text, **kw)
    sent = docs.sparkSession.sparkContext.broadcast(stems)
    at = docs.columns.index(text)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        g = Grammar(sent.value)
        for b in slices(batches):
            keep = [weights[0] + sum(w * x for w, x in zip(weights[1:], g.features(t))) < 0
                    for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
