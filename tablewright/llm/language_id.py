"""Language of texts, by interpolated Kneser-Ney models of characters.

Each language has a model of the characters of its lower-cased words, a word
being a run of letters between a start and an end mark. A character's
probability after the (up to four) before it is the discounted share of its
count after them plus the discounted mass times its probability after one
fewer. The longest histories, and those that begin with the start mark, count
occurrences; the others count how many different characters stand before
(Kneser and Ney's continuation counts). Counts, discounts and shares come from
joins and groupings in Spark; the finished shares go to the tasks as arrays of
64-bit hashes in order, one pair a language and history length, looked up by
bisection.

The language of a text is that with the lowest cross-entropy, the mean
negative log2 probability of its characters and word ends. Sampled rows that
took no part in the counts calibrate two things: above which cross-entropy a
text is rejected as not in the language, and how sharply differences of
cross-entropy tell for the score."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import broadcast_if_small, cut, slices

#: Characters of a gram: the one predicted and its history.
ORDER = 5

#: Rows of a language that the model is fitted on, chosen by hash.
SAMPLE_ROWS = 4000

#: One sampled row in so many calibrates and is not counted, in languages
#: with at least ``CALIBRATED_FROM`` sampled rows.
CALIBRATE, CALIBRATED_FROM = 5, 100

#: Grams kept by all languages and lengths together, the most frequent of
#: each; the mass of others goes to the shorter history. Bounds what is sent.
MODEL_GRAMS = 1_000_000

#: Share of a language's calibration rows that its threshold rejects.
REJECTED = 0.005

#: Sharpness of scores is chosen among these.
SHARPNESS = (0.5, 1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0)

#: Distinct words whose sums a task holds.
HELD_WORDS = 200_000

START, END = "\x02", "\x03"
UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
_MUL = np.uint64(0xD6E8FEB86659FD93)


def words(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def _powers(order: int) -> list[np.uint64]:
    out = [np.uint64(1)]
    while len(out) < order:
        out.append(np.uint64((int(out[-1]) * int(_MUL)) & 0xFFFFFFFFFFFFFFFF))
    return out


def _codes(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _hashes(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """[l - 1][e]: of the l characters that end at place e, if there are."""
    out = [codes.copy()]
    for l, power in enumerate(_powers(order)[1:], 2):
        h = out[-1].copy()
        h[l - 1:] += codes[:len(codes) - l + 1] * power
        out.append(h)
    return out


class Sorted:
    """Values by hash: an array of the hashes in order and one of the values."""

    def __init__(self, grams: list[str], values: np.ndarray, length: int):
        keys = _hashes(_codes("".join(grams)), length)[-1][length - 1::length] if grams else np.empty(0, np.uint64)
        order = np.argsort(keys)
        self.keys, self.values = keys[order], np.asarray(values, np.float32)[order]

    def get(self, keys: np.ndarray, missing: float) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), missing)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], missing)


@dataclass
class Model:
    """``shares[i][l - 1]``, ``rests[i][l - 1]``: of language i and grams of l
    characters, the discounted share by gram and the mass left by history.
    ``base[i]``: the probability of each character before any is known."""

    order: int
    languages: list[str]
    shares: list[list[Sorted]]
    rests: list[list[Sorted]]
    base: list[float]
    limits: list[float]
    sharpness: float = 1.0

    def probabilities(self, hashes: list[np.ndarray], at: np.ndarray, length: np.ndarray) -> np.ndarray:
        """(places ``at``, languages): of the character there after those
        before it, ``length`` being how many the gram has."""
        out = np.empty((len(at), len(self.languages)))
        for i in range(len(self.languages)):
            p = np.full(len(at), self.base[i])
            for l in range(1, self.order + 1):
                share = self.shares[i][l - 1].get(hashes[l - 1][at], 0.0)
                before = hashes[l - 2][at - 1] if l > 1 else np.zeros(len(at), np.uint64)
                p = np.where(l <= length, share + self.rests[i][l - 1].get(before, 1.0) * p, p)
            out[:, i] = p
        return out

    def sums(self, new: list[str]) -> np.ndarray:
        """For each word: log2 probabilities by language, then the number of
        characters they are of (its end included) and of letters."""
        codes = _codes("".join(START + w + END for w in new))
        sizes = np.array([len(w) + 2 for w in new])
        starts = np.cumsum(sizes) - sizes
        place = np.arange(len(codes)) - np.repeat(starts, sizes)
        hashes = _hashes(codes, self.order)
        at = np.flatnonzero(place > 0)
        length = np.minimum(place[at] + 1, self.order)
        full = np.choose(length - 1, [h[at] for h in hashes]) * np.uint64(8) + length.astype(np.uint64)
        _, first, back = np.unique(full, return_index=True, return_inverse=True)
        logs = np.log2(self.probabilities(hashes, at[first], length[first]))[back]
        rows = np.add.reduceat(logs, starts - np.arange(len(new)))
        letters = np.array([sum(map(str.isalpha, w)) for w in new])
        rows *= (letters > 0)[:, None]
        return np.concatenate([rows, ((sizes - 1) * (letters > 0))[:, None], letters[:, None]], 1)


class Scorer:
    """Cross-entropies of texts; sums of words already seen are held."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}
        self.rows = np.empty((0, len(model.languages) + 2))

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(texts x languages) bits a character, and the letters of each."""
        lists = [words(t) if t else [] for t in texts]
        if len(self.known) > HELD_WORDS:
            self.known, self.rows = {}, self.rows[:0]
        new = list(dict.fromkeys(w for ws in lists for w in ws if w not in self.known))
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.rows = np.concatenate([self.rows, self.model.sums(new)])
        total = np.zeros((len(texts), self.rows.shape[1]))
        for i, ws in enumerate(lists):
            if ws:
                ids = np.fromiter(map(self.known.__getitem__, ws), np.int64, len(ws))
                total[i] = self.rows[ids].sum(0)
        n = len(self.model.languages)
        return -total[:, :n] / np.maximum(total[:, n:n + 1], 1), total[:, n + 1].astype(np.int64)


def _sample(df: DataFrame, text: str, language: str, rows: int) -> DataFrame:
    """(lang, text, calibrates): about ``rows`` rows of each language."""
    d = df.where(F.col(language).isNotNull() & F.col(text).isNotNull())
    sizes = broadcast_if_small(cut(d.groupBy(F.col(language).alias("lang")).agg(F.count(F.lit(1)).alias("n"))),
                               F.octet_length("lang") + 32)
    h = F.pmod(F.xxhash64("text"), F.lit(1 << 40))
    return (d.select(F.col(language).alias("lang"), F.col(text).alias("text")).join(sizes, "lang")
            .where(h * F.col("n") < F.lit(rows) * F.lit(1 << 40).cast("double"))
            .select("lang", "text", ((F.pmod(F.xxhash64("text", F.lit(7)), F.lit(CALIBRATE)) == 0)
                                     & (F.least("n", F.lit(rows)) >= CALIBRATED_FROM)).alias("calibrates")))


def _word_counts(sampled: DataFrame) -> DataFrame:
    """(lang, word, n), counted in each task before the shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            c = Counter()
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                c.update((lang, w) for w in words(text))
            rows = [(l, w, n) for (l, w), n in c.items() if any(map(str.isalpha, w))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], ["lang", "word", "n"])

    return sampled.select("lang", "text").mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def gram_counts(word_counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, l, gram, c): occurrences of the grams of ``order`` characters
    and of shorter ones after a start mark, continuations of the others."""
    p = F.concat(F.lit(START), F.col("word"), F.lit(END))
    ends = F.sequence(F.lit(2), F.length("word") + 2)
    gram = F.explode(F.transform(ends, lambda i: F.substring(p, F.greatest(F.lit(1), i - order + 1), F.least(i, F.lit(order)))))
    seen = cut(word_counts.select("lang", "n", gram.alias("gram")).groupBy("lang", "gram").agg(F.sum("n").alias("c")))
    of = lambda l: seen.where(F.length("gram") == l)
    table = of(order)
    out = table.withColumn("l", F.lit(order))
    for l in range(order - 1, 0, -1):
        after = table.groupBy("lang", F.expr("substring(gram, 2)").alias("gram")).agg(F.count(F.lit(1)).alias("c"))
        table = after.unionByName(of(l)) if l > 1 else after
        out = out.unionByName(table.withColumn("l", F.lit(l)))
    return out.select("lang", "l", "gram", "c")


def shares(counts: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """(lang, l, gram, share) and (lang, l, history, rest) of counted grams;
    ``most`` grams are kept of a language and length."""
    n = lambda k: F.sum((F.col("c") == k).cast("long"))
    discount = counts.groupBy("lang", "l").agg(
        F.greatest(F.lit(0.05), F.least(F.lit(0.95), F.coalesce(F.try_divide(n(1), n(1) + 2 * n(2)), F.lit(0.5)))).alias("d"))
    history = F.expr("substring(gram, 1, l - 1)").alias("history")
    total = counts.groupBy("lang", "l", history).agg(F.sum("c").alias("total"))
    most_frequent = Window.partitionBy("lang", "l").orderBy(F.desc("c"), "gram")
    share = cut(counts.withColumn("_place", F.row_number().over(most_frequent)).where(F.col("_place") <= most)
                .select("lang", "l", "gram", "c", history).join(total, ["lang", "l", "history"]).join(discount, ["lang", "l"])
                .select("lang", "l", "gram", "history", ((F.col("c") - F.col("d")) / F.col("total")).alias("share")))
    rest = share.groupBy("lang", "l", "history").agg((1 - F.sum("share")).alias("rest"))
    return share.select("lang", "l", "gram", "share"), rest


def fit(df: DataFrame, text: str = "text", language: str = "lang", order: int = ORDER,
        sample_rows: int = SAMPLE_ROWS, model_grams: int = MODEL_GRAMS) -> Model:
    """The models of all non-null values of ``language``, of at most about
    ``sample_rows`` rows of each, whole texts. Rows with a null text or
    language, and texts without a letter, teach nothing; a language of which
    only such rows are there, or none, is not learned. Repeated texts are in
    the sample together or not at all. At most ``model_grams`` grams reach the
    driver."""
    sampled = cut(_sample(df, text, language, sample_rows))
    counted = cut(_word_counts(sampled.where("not calibrates")))
    languages = [r[0] for r in counted.select("lang").distinct().orderBy("lang").collect()]
    model = Model(order, languages, [], [], [], [float("inf")] * len(languages))
    if not languages:
        return model
    share, rest = shares(cut(gram_counts(counted, order)), max(1, model_grams // (len(languages) * order)))
    got = {}
    for name, frame in (("share", share), ("rest", rest)):
        gram = frame.columns[2]
        t = frame.toArrow().to_pandas()
        got[name] = {k: (v[gram].tolist(), v[name].to_numpy()) for k, v in t.groupby(["lang", "l"])}
    for lang in languages:
        model.shares.append([Sorted(*got["share"].get((lang, l), ([], [])), l) for l in range(1, order + 1)])
        model.rests.append([Sorted(*got["rest"].get((lang, l), ([], [])), l - 1) if l > 1 else _of_all(got["rest"], lang)
                            for l in range(1, order + 1)])
        model.base.append(1 / (len(model.shares[-1][0].keys) + 1))
    return _calibrated(model, sampled.where("calibrates"))


def _of_all(rest: dict, lang: str) -> Sorted:
    """The mass that grams of one character leave: after no history."""
    s = Sorted([], np.empty(0), 1)
    if (lang, 1) in rest:
        s.keys, s.values = np.zeros(1, np.uint64), np.asarray(rest[lang, 1][1][:1], np.float32)
    return s


def _calibrated(model: Model, held: DataFrame) -> Model:
    """``limits`` and ``sharpness`` from rows that were not counted; without
    such rows nothing is rejected and sharpness is 1."""
    h = _entropies(held, model, ("lang",)).where("n_letters > 0")
    place = F.array_position(F.lit(model.languages), F.col("lang"))
    d = cut(h.where(place > 0).withColumn("own", F.element_at("entropies", place.cast("int"))))
    fits = d.agg(*[F.avg(-F.log(F.aggregate("entropies", F.lit(0.0), lambda s, x: s + F.exp(F.lit(t) * (F.col("own") - x))))).alias(f"t{i}")
                   for i, t in enumerate(SHARPNESS)]).first()
    if fits[0] is not None:
        model.sharpness = SHARPNESS[max(range(len(SHARPNESS)), key=lambda i: fits[i])]
        for lang, limit in d.groupBy("lang").agg(F.percentile_approx("own", 1 - REJECTED, 10_000)).collect():
            model.limits[model.languages.index(lang)] = limit
    return model


def _entropies(df: DataFrame, model: Model, carry: tuple[str, ...], text: str = "text") -> DataFrame:
    sent = df.sparkSession.sparkContext.broadcast(model)
    src = df.select(*[F.col(f"`{c}`") for c in carry], F.col(text).alias("_whole_text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for b in slices(batches):
            h, letters = scorer.entropies(b.column(len(carry)).to_pylist())
            at = pa.array(np.arange(len(h) + 1) * h.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(carry)], pa.ListArray.from_arrays(at, pa.array(h.ravel())), pa.array(letters)],
                [*carry, "entropies", "n_letters"])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in src.schema.fields[:-1])
    return src.mapInArrow(score, kept + "entropies array<double>, n_letters long")


def identify(df: DataFrame, model: Model, text: str = "text", carry: tuple[str, ...] | None = None) -> DataFrame:
    """The columns ``carry`` of ``df`` (none named: all) and: ``lang_pred``
    (the language of the lowest cross-entropy, ties to the first by code
    point), ``score`` (0 to 1, its calibrated share of the likelihood),
    ``entropy`` (bits a character), ``rejected`` (above the language's limit).

    A null text, one without a letter, and every text if the model has no
    language get ``und``, score 0, null entropy, and are rejected. Texts are
    read whole. Repeated rows give repeated rows, no rows none; columns of
    the four names are replaced."""
    new = ("lang_pred", "score", "entropy", "rejected")
    carry = tuple(c for c in (df.columns if carry is None else carry) if c not in new)
    tmp = {"entropies": "_entropies", "n_letters": "_n_letters"}  # a caller's columns of these names stay
    src = df.select(F.col(text).alias("_text_read"), *[F.col(f"`{c}`").alias(tmp.get(c, c)) for c in carry])
    h = _entropies(src, model, tuple(tmp.get(c, c) for c in carry), "_text_read")
    known = (F.col("n_letters") > 0) & F.lit(bool(model.languages))
    low = F.array_min("entropies")
    at = F.array_position("entropies", low).cast("int")
    names, limits = F.lit(model.languages or [UNKNOWN]), F.lit(model.limits or [0.0])
    rest = F.aggregate("entropies", F.lit(0.0), lambda s, x: s + F.exp(F.lit(model.sharpness) * (low - x)))

    def told(value: Column, otherwise: Column) -> Column:
        return F.when(known, value).otherwise(otherwise)

    return h.select(
        *[F.col(f"`{tmp.get(c, c)}`").alias(c) for c in carry], told(F.get(names, at - 1), F.lit(UNKNOWN)).alias("lang_pred"),
        told(1 / rest, F.lit(0.0)).alias("score"), told(low, F.lit(None)).cast("double").alias("entropy"),
        told(low > F.get(limits, at - 1), F.lit(True)).alias("rejected"))
