"""Periodic runs of words, by multi-scale minimizers.

A run is a stretch of consecutive words with smallest period q, at least
``max(least, 2 * q)`` words long, that no neighbouring word extends. Periods
below ``SCANNED`` come from direct scans of each lag. For the others there is
a scale for every power of two ``b``: the minimum of the hashes of ``b / 2``
words over windows of ``b / 2`` places. A window and its shift by a period
q >= b lie in the run both and have the same words, so the same place is their
minimum, and two selected places with equal words lie q apart. Such pairs at a
distance of b to 2 * b are the seeds; each is extended word by word both ways.

Places that repeat at less than half a hash's words lie in a run of a smaller
period: they make a clump, an arithmetic progression. No pair within a clump
seeds anything (its run has that smaller period), and between two clumps one
pair for each lag is enough, as the other pairs of that lag extend to the same
run. So the seeds of a scale stay linear in its selected places, also in a
text that is one word over and over.

Hashes only propose seeds; all runs come from compared words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import slices

#: Least number of words of a run.
LEAST = 12

#: Periods below this are found by a scan of their lag; a power of two.
SCANNED = 16

#: Words that a task looks at together; a longer text is looked at alone.
GROUP_WORDS = 1 << 17

_MUL = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MUL
    return x ^ (x >> np.uint64(29))


def _extended(a: np.ndarray, p: int, q: int) -> tuple[int, int]:
    """The largest range (i, j) around p with a[x] == a[x + q] in all of it."""
    j, step = p, 64
    while j + q < len(a):
        same = a[j:j + step][:len(a) - q - j] == a[j + q:j + q + step]
        if not same.all():
            j += int(same.argmin())
            break
        j, step = j + len(same), step * 2
    i, step = p, 64
    while i > 0:
        low = max(0, i - step)
        same = (a[low:i] == a[low + q:i + q])[::-1]
        if not same.all():
            i -= int(same.argmin())
            break
        i, step = low, step * 2
    return i, j


def _clump_seeds(p: np.ndarray, at: np.ndarray, end: np.ndarray, one: int, two: int) -> np.ndarray:
    """(place, lag) between the clumps one and two, one pair for each lag."""
    x, y = p[at[one]:end[one]], p[at[two]:end[two]]
    if len(x) > 1 and len(y) > 1 and x[1] - x[0] != y[1] - y[0]:
        return np.array([(u, v - u) for u in x for v in y])
    first = np.stack([np.full(len(y), x[0]), y - x[0]], 1)
    return np.concatenate([first, np.stack([x, y[0] - x], 1)])


def _seeds(hashes: np.ndarray, b: int) -> np.ndarray:
    """(place, lag) of the seeds with a lag from b to 2 * b, by lag and place.
    ``hashes``: of the ``b / 2`` words from every place."""
    k = w = b // 2
    n = len(hashes)
    if n < w:
        return np.empty((0, 2), np.int64)
    bits = np.uint64(n.bit_length())
    low = (hashes >> bits << bits) | np.arange(n, dtype=np.uint64)  # the leftmost of equal hashes
    t = 1
    while t < w:
        low = np.minimum(low[:-t], low[t:])
        t *= 2
    place = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    place = place[np.r_[True, place[1:] != place[:-1]]]
    order = np.argsort(hashes[place], kind="stable")
    p, h = place[order], hashes[place[order]]
    same, gap = h[1:] == h[:-1], p[1:] - p[:-1]
    near = same & (gap < 2 * b)
    used = np.r_[near, False] | np.r_[False, near]  # the rest has no partner
    if not used.any():
        return np.empty((0, 2), np.int64)
    p, h = p[used], h[used]
    gap = p[1:] - p[:-1]
    link = (h[1:] == h[:-1]) & (gap <= k // 2)
    new = ~link
    new[1:] |= link[1:] & link[:-1] & (gap[1:] != gap[:-1])
    at = np.flatnonzero(np.r_[True, new])
    end = np.r_[at[1:], len(p)]
    lone, out, j = end - at == 1, [], 1
    while j < len(at):
        one, two = np.arange(len(at) - j), np.arange(j, len(at))
        close = (h[at[one]] == h[at[two]]) & (p[at[two]] - p[end[one] - 1] < 2 * b)
        if not close.any():
            break
        one, two = one[close], two[close]
        flat = lone[one] & lone[two]
        x, y = p[at[one[flat]]], p[at[two[flat]]]
        out.append(np.stack([x, y - x], 1))
        out += [_clump_seeds(p, at, end, u, v) for u, v in zip(one[~flat], two[~flat])]
        j += 1
    pairs = np.concatenate(out) if out else np.empty((0, 2), np.int64)
    pairs = pairs[(pairs[:, 1] >= b) & (pairs[:, 1] < 2 * b)]
    return np.unique(pairs[:, ::-1], axis=0)[:, ::-1]


def find_runs(a: np.ndarray, longest: int, least: int = LEAST, scanned: int = SCANNED,
              within: list[int] | None = None) -> dict[tuple[int, int], int]:
    """(start, end) -> period of every run in the numbers ``a``.

    ``a`` may be several texts one after another with a number of its own
    between them, ``longest`` being the words of the longest. ``within[e]``:
    how far the texts of at least 2**e words reach, if the longest come first."""
    runs: dict[tuple[int, int], int] = {}
    for q in range(1, min(scanned, longest // 2 + 1)):
        x = np.flatnonzero(a[q:] == a[:-q])
        cut = np.flatnonzero(x[1:] - x[:-1] != 1)
        i, j = x[np.r_[0, cut + 1]] if len(x) else x, x[np.r_[cut, len(x) - 1]] + 1 if len(x) else x
        long = j - i + q >= max(least, 2 * q)
        for s, e in zip(i[long].tolist(), j[long].tolist()):
            runs.setdefault((s, e + q), q)  # the smallest period of the stretch came first
    b, k = scanned, 1
    hashes = _mixed(a.astype(np.uint64) + np.uint64(1))
    while 2 * b <= longest:
        while k < b // 2:
            hashes = _mixed(hashes[:-k] * np.uint64(3) + hashes[k:]) if len(hashes) > k else hashes[:0]
            k *= 2
        if within:
            hashes = hashes[:within[(2 * b).bit_length() - 1]]
        lag, done = 0, 0
        for p, q in _seeds(hashes, b).tolist():
            if q != lag:
                lag, done = q, -1
            if p < done:
                continue
            i, j = _extended(a, p, q)
            done = j
            if j - i >= q and j - i + q >= least:
                runs.setdefault((i, j + q), q)
        b *= 2
    return runs


def _number(words: list[bytes], first: int) -> np.ndarray:
    ids = {w: i for i, w in enumerate(dict.fromkeys(words), first)}
    return np.fromiter(map(ids.__getitem__, words), np.int64, len(words))


def _grouped(texts: list[bytes | None]) -> Iterator[list[tuple[int, list[bytes]]]]:
    """(place in the batch, words) in groups of bounded size, longest first."""
    group, size = [], 0
    for i, t in enumerate(texts):
        words = t.split() if t else []  # of bytes: at the six ASCII blanks
        if group and size + len(words) > GROUP_WORDS:
            yield group
            group, size = [], 0
        group.append((i, words))
        size += len(words) + 1
    if group:
        yield group


def _runs_of(group: list[tuple[int, list[bytes]]], least: int, scanned: int) -> Iterator[tuple[int, list[bytes], list]]:
    """(place, words, [(start, length, period)]) of every text of a group."""
    group.sort(key=lambda x: -len(x[1]))
    starts = np.cumsum([0, *(len(w) + 1 for _, w in group)])
    a = np.full(starts[-1], 0, np.int64)
    ids = _number([w for _, words in group for w in words], len(group))
    mask = np.ones(starts[-1], bool)
    mask[starts[1:] - 1] = False
    a[mask] = ids
    a[~mask] = np.arange(len(group))  # a number of its own ends every text
    longest = len(group[0][1])
    sizes = np.array([len(w) for _, w in group])
    within = [int(starts[np.count_nonzero(sizes >= 1 << e)]) for e in range(longest.bit_length() + 1)]
    found = [[] for _ in group]
    for (s, e), q in find_runs(a, longest, least, scanned, within).items():
        d = int(np.searchsorted(starts, s, "right")) - 1
        found[d].append((s - int(starts[d]), e - s, q))
    for (i, words), runs in zip(group, found):
        yield i, words, sorted(runs, key=lambda r: (r[0], r[2]))


def _collapsed(words: list[bytes], runs: list) -> bytes:
    if runs:
        drop = np.zeros(len(words) + 1, np.int64)
        for s, n, q in runs:
            drop[s + q] += 1
            drop[s + n] -= 1
        words = [w for w, d in zip(words, np.cumsum(drop).tolist()) if not d]
    return b" ".join(words)


def periodic_runs(df: DataFrame, text: str = "text", least: int = LEAST, scanned: int = SCANNED) -> DataFrame:
    """All columns of ``df`` and: ``n_words``, ``runs`` (start, length and
    period of every run, in words, by start and period) and ``collapsed`` (the
    words joined by one blank, without those that a run has after its first
    period).

    Words are what the six ASCII white-space characters separate. Null text:
    no words, no runs, null ``collapsed``; text without words: empty. Repeated
    rows give repeated rows; no rows give none. Nothing is limited: every run
    of every period is found, over whole texts. Columns of those three names
    are replaced."""
    new = ("n_words", "runs", "collapsed")
    keep = [c for c in df.columns if c not in new]
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(len(keep)).cast(pa.binary()).to_pylist()
            n, runs, left = [0] * len(texts), [[]] * len(texts), [None] * len(texts)
            for group in _grouped(texts):
                for i, words, found in _runs_of(group, least, scanned):
                    n[i] = len(words)
                    runs[i] = [{"start": s, "length": x, "period": q} for s, x, q in found]
                    left[i] = None if texts[i] is None else _collapsed(words, found)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(n, pa.int64()), pa.array(runs, run_type),
                 pa.array(left, pa.binary()).cast(pa.string())], [*keep, *new])

    src = df.select(*[F.col(f"`{c}`") for c in keep], F.col(text).alias("_whole_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    return src.mapInArrow(search, (schema + ", " if schema else "")
                          + "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
