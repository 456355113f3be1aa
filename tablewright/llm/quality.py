"""Quality rules as a short-circuit cascade.

Every rule looks at a text and rejects it or not; a text is kept if no rule
rejects it. What a rule costs and how often it rejects is measured on a bounded
sample, on the executors; the rules then run in the order of rejections per
second, each only on the texts that the rules before it let through. The order
changes the time a text takes, never its verdict.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import slices

#: Rows on which cost and selectivity are measured.
SAMPLE_ROWS = 2000

MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"
_BLANKS = b" \t\n\r\x0b\x0c"


class Text:
    """One text and what is known of it, each fact found when first asked for."""

    def __init__(self, text: str | None):
        self.raw = (text or "").encode("utf-8", "surrogatepass")
        self.chars = len(text or "")

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @cached_property
    def word_chars(self) -> int:
        return self.chars - len(self.raw) + len(self.raw.translate(None, _BLANKS))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.raw.split(b"\n") if x.strip(_BLANKS)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words that stand in a window of three which occurs twice or more."""
        import numpy as np
        n = len(self.words)
        if n < 4:
            return 0
        seen: dict[bytes, int] = {}
        a = np.fromiter((seen.setdefault(w, len(seen)) for w in self.words), dtype=np.int64, count=n)
        pairs = a[:-1] * len(seen) + a[1:]
        if len(seen) > 1 << 20:  # three ids would not fit into 63 bits
            pairs = np.unique(pairs, return_inverse=True)[1]
        _, at, count = np.unique(pairs[:-1] * len(seen) + a[2:], return_inverse=True, return_counts=True)
        again = count[at] > 1
        inside = np.zeros(n, dtype=bool)
        for i in range(3):
            inside[i:n - 2 + i] |= again
        return int(inside.sum())

    @cached_property
    def top_word(self) -> int:
        return Counter(self.words).most_common(1)[0][1] if self.words else 0


# A rule is true for a text that it rejects.

def too_short(t: Text) -> bool:
    return len(t.words) < MIN_WORDS


def repetitive(t: Text) -> bool:
    return 100 * t.n_repeat_words > 50 * len(t.words)


def symbols(t: Text) -> bool:
    return 10 * t.n_symbols > len(t.words)


def duplicate_lines(t: Text) -> bool:
    return 2 * t.n_dup_lines > len(t.lines)


def word_length(t: Text) -> bool:
    return not 2 * len(t.words) <= t.word_chars <= 15 * len(t.words)


def one_word(t: Text) -> bool:
    """One word makes up more than two fifths of the text."""
    return 5 * t.top_word > 2 * len(t.words)


def shouting(t: Text) -> bool:
    """More than three tenths of the words hold a doubled exclamation mark."""
    return 10 * sum(b"!!" in w for w in t.words) > 3 * len(t.words)


_LETTER = re.compile(rb"[A-Za-z\x80-\xff]")


def few_letters(t: Text) -> bool:
    """Less than half of the words hold a letter."""
    return 2 * sum(1 for w in t.words if _LETTER.search(w)) < len(t.words)


Rule = Callable[[Text], bool]
#: The two rules of the base verdict, and those that follow it.
BASE: tuple[Rule, ...] = (too_short, repetitive)
RULES: tuple[Rule, ...] = (symbols, duplicate_lines, word_length, one_word, shouting, few_letters)


def measure(docs: DataFrame, text: str, rules: tuple[Rule, ...], sample_rows: int = SAMPLE_ROWS) -> list[tuple]:
    """(rule, seconds a text, share rejected) of every rule over a sample of
    about ``sample_rows`` rows, chosen by a hash of the text; at most twice as
    many are looked at. Every rule meets each text afresh."""
    n = docs.count()
    share = min(1.0, sample_rows / max(1, n))
    d = docs.select(F.col(text).alias("_text")).where(
        F.pmod(F.xxhash64("_text"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000) + 1)).limit(2 * sample_rows)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in slices(batches):
            texts = b.column(0).to_pylist()
            for k, rule in enumerate(rules):
                fresh = [Text(t) for t in texts]
                began = time.perf_counter()
                hits = sum(map(rule, fresh))
                spent = time.perf_counter() - began
                yield pa.RecordBatch.from_pydict({"rule": pa.array([k], pa.int32()), "n": pa.array([len(texts)], pa.int64()),
                                                  "hits": pa.array([hits], pa.int64()), "s": [spent]})

    got = (d.mapInArrow(run, "rule int, n long, hits long, s double").groupBy("rule")
           .agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"), F.sum("s").alias("s")).collect())
    by = {r.rule: r for r in got}
    return [(rule, by[k].s / by[k].n, by[k].hits / by[k].n) if k in by and by[k].n else (rule, 0.0, 0.0)
            for k, rule in enumerate(rules)]


def cascade(measured: list[tuple]) -> list[Rule]:
    """The rules by rejections per second, best first; ties by name."""
    return [r for r, _, _ in sorted(measured, key=lambda m: (-m[2] / max(m[1], 1e-9), m[0].__name__))]


def quality(docs: DataFrame, key: str = "doc_id", text: str = "text", base: tuple[Rule, ...] = BASE,
            rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``docs``: ``key``, the counts ``n_words``,
    ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed`` (a rule of ``base`` rejects it) and ``kept`` (no rule
    rejects it).

    Null and empty texts have no words and are rejected as too short. Memory
    is that of one batch of texts; a long text is looked at whole. Repeated
    rows stay repeated, an empty table gives no rows, other columns of
    ``docs`` are ignored."""
    measured = measure(docs, text, base + rules, sample_rows)
    first, order = cascade(measured[:len(base)]), cascade(measured[len(base):])
    d = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    counts = ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in slices(batches):
            out: dict[str, list] = {c: [] for c in ("n_words", *counts, "base_failed", "kept")}
            for raw in b.column(1).to_pylist():
                t = Text(raw)
                failed = any(r(t) for r in first)
                out["kept"].append(not failed and not any(r(t) for r in order))
                out["base_failed"].append(failed)
                out["n_words"].append(len(t.words))
                for c in counts:
                    out[c].append(getattr(t, c))
            cols = [b.column(0)] + [pa.array(v, pa.bool_() if k in ("kept", "base_failed") else pa.int64()) for k, v in out.items()]
            yield pa.RecordBatch.from_arrays(cols, names=[key, *out])

    kind = d.schema["_key"].dataType.simpleString()
    longs = ", ".join(f"{c} long" for c in ("n_words", *counts))
    return d.mapInArrow(run, f"`{key}` {kind}, {longs}, base_failed boolean, kept boolean")
