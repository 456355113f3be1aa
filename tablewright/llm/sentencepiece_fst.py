"""SentencePiece encoding and decoding as a weighted finite-state transducer.

A model file is compiled to three machines, which are composed with each input
while its shortest path is sought:

* the normaliser: one state, white space to U+2581, a dummy prefix in front;
* the pieces: an arc for every piece that the model can produce, over the
  characters it spells, and for a character that no piece spells an arc that
  writes its UTF-8 bytes as byte pieces (byte fallback);
* for byte-pair models the pair acceptor: an arc of weight 0 from piece to
  piece if byte-pair merging leaves the two side by side, of infinite weight
  if not.

Path weights add up and the least one wins (the tropical semiring). An arc of a
unigram model weighs its negative score. An arc of a byte-pair model weighs 1;
a piece sequence is the byte-pair encoding of its text exactly if merging
leaves each two neighbours side by side, so one path is finite: that of the
model's own encoder. (The shortest path over a byte-pair model's scores alone,
which are merge ranks, would be another segmentation; hence the acceptor.)

Merging never joins characters that stand side by side in no piece. Input is
cut there, and the path of every distinct stretch is kept in a bounded cache.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import slices

BLANK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Entries of each half of a cache in one Python worker.
CACHE = 1 << 18

#: Stretches up to so many characters share the paths of their ends; longer
#: ones are searched from place to place, in memory linear in their length.
SHORT = 40

_INF = float("inf")
_UNIGRAM, _BPE = 1, 2
_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE, _UNUSED = 1, 2, 3, 4, 6, 5


class _Cache(dict):
    """A dictionary that computes what is missing. When it is full, what it
    holds becomes the elder half, from which entries that are asked for again
    come back; the elder half before goes."""

    def __init__(self, make):
        super().__init__()
        self.make, self.elder = make, {}

    def __missing__(self, key):
        if len(self) >= CACHE:
            self.elder = dict(self)
            self.clear()
        value = self.elder.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def forget(self) -> None:
        self.clear()
        self.elder = {}


class Transducer:
    """The compiled machines of one model file."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb
        m = pb.ModelProto()
        m.ParseFromString(model)
        norm, self.kind = m.normalizer_spec, m.trainer_spec.model_type
        if self.kind not in (_UNIGRAM, _BPE):
            raise ValueError("neither a unigram nor a byte-pair model")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces:
            raise ValueError("character maps and blank removal in a normaliser are not compiled")
        self.prefix = BLANK if norm.add_dummy_prefix else ""
        self.ids: dict[str, int] = {}
        self.weight: dict[str, float] = {}
        self.bytes: dict[int, int] = {}
        self.spelled: list[bytes] = []
        self.unknown = 0
        for i, p in enumerate(m.pieces):
            if p.type in (_NORMAL, _USER):
                self.ids[p.piece], self.weight[p.piece] = i, -p.score
                self.spelled.append(p.piece.replace(BLANK, " ").encode())
            elif p.type == _BYTE:
                self.bytes[v := int(p.piece[1:-1], 16)] = i
                self.spelled.append(bytes([v]))
            else:
                self.unknown = i if p.type == _UNKNOWN else self.unknown
                self.spelled.append(" ⁇ ".encode() if p.type == _UNKNOWN else b"")
        self._compile()

    # --- compiling ----------------------------------------------------------

    def _compile(self) -> None:
        self.side: dict[str, tuple] = {}
        arcs = set(self.ids)
        self._next: dict[str, dict[str, bool]] = {}
        self._pairs = 0
        self.ends: dict[tuple[str, str], bytes | None] = {}
        if self.kind == _BPE:
            halves = {p: self._halves(p) for p in self.ids if len(p) > 1}
            arcs -= {p for p, h in halves.items() if h is None}
            self._formed: dict[str, float] = {}
            self._split = {p: h for p, h in halves.items() if h}
        self.arcs = arcs
        self.stems = {p[:n] for p in arcs for n in range(1, len(p) + 1)}
        self.char = _Cache(self._char)
        self.unknown_weight = 10.0 + max(self.weight.values(), default=0.0)
        # Stretches: a blank after something else always starts one, and a line
        # end is one, unless a piece of this model says otherwise.
        self.cuts = not any(BLANK in p.lstrip(BLANK) or "\n" in p for p in arcs if len(p) > 1)
        self.runs = re.compile(rf"{BLANK}+[^{BLANK}\n]*|[^{BLANK}\n]+")
        self.line_end = self.char["\n"]
        self.joints = {p[i:i + 2] for p in arcs for i in range(len(p) - 1)}
        self.coded = _Cache(self.char.__getitem__)
        self.coded.update((p, self.ids[p].to_bytes(4, "little")) for p in self.ids)
        self.stretch = _Cache(self._stretches)
        self.word = _Cache(lambda w: self._stretches(BLANK + w))

    def _halves(self, piece: str) -> tuple[str, str] | None:
        """The two parts whose merge makes ``piece`` when it is encoded by
        itself; None if encoding it gives something else."""
        parts, weight = list(piece), self.weight
        while len(parts) > 2:
            joins = [(weight[j], i) for i in range(len(parts) - 1) if (j := parts[i] + parts[i + 1]) in weight]
            if not joins:
                return None
            i = min(joins)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return (parts[0], parts[1])

    def _time(self, s: str) -> float:
        """When merging makes ``s``: its rank, not before its parts are there."""
        if len(s) == 1:
            return -1.0
        if (t := self._formed.get(s)) is None:
            t = self._formed[s] = max(self.weight[s], *map(self._time, self._split[s]))
        return t

    def _edge(self, s: str, half: int) -> tuple:
        """(part, from, until) of what stands at one end of ``s`` over the
        merges. Times count four to a rank: at equal rank, merges left of the
        seam (0) come before one at the seam (1) and those right of it (2), and
        on one side a part comes before the longer one that it goes into."""
        key = f"{half}{s}"
        if (e := self.side.get(key)) is None:
            mark, out, until, part = 2 * (1 - half), [], _INF, s
            while True:
                born = 4 * self._time(part) + mark + len(part) / 1024
                out.append((part, born, until))
                if part not in self._split:
                    break
                part, until = self._split[part][half], born
            e = self.side[key] = tuple(out)
        return e

    def _follows(self, a: str, b: str) -> bool:
        """The pair acceptor: whether merging leaves the two pieces side by
        side, that is, no two parts that meet at the seam at some time are
        merged before either is used up in its own piece."""
        ok = True
        for x, born_x, until_x in self._edge(a, 1):
            for y, born_y, until_y in self._edge(b, 0):
                end = min(until_x, until_y)
                if max(born_x, born_y) < end and (w := self.weight.get(x + y)) is not None and 4 * w + 1 < end:
                    ok = False
        if self._pairs >= CACHE:
            self._next.clear()
            self._pairs = 0
        self._pairs += 1
        self._next.setdefault(a, {})[b] = ok
        return ok

    # --- composing ------------------------------------------------------------

    def _char(self, c: str) -> bytes:
        """The ids that the arc of one character writes."""
        if c in self.ids:
            ids = [self.ids[c]]
        elif self.bytes:
            ids = [self.bytes[b] for b in c.encode("utf-8", "surrogatepass")]
        else:
            ids = [self.unknown]
        return b"".join(i.to_bytes(4, "little") for i in ids)

    def _stretch(self, s: str) -> bytes:
        """The shortest path over one stretch: its ids, 4 bytes each."""
        if self.kind == _BPE and len(s) <= SHORT:
            return self._path("", s)
        last, back = self._least_pieces(s) if self.kind == _BPE else self._least_weight(s)
        out, at = [], len(s)
        while at:
            out.append(self.coded[last[at]])
            at = back[at]
        return b"".join(reversed(out))

    def _stretches(self, s: str) -> bytes:
        """The ids of a text without blanks inside, cut between characters
        that stand side by side in no piece: its parts are paths of their own,
        and a word is looked up without the marks around it."""
        joints = self.joints
        if len(s) <= SHORT:
            if len(s) < 2 or s[-2:] in joints:
                return self._stretch(s)
            head = s[:-1]       # "word," is "word" and ","
            return (self.word[head[1:]] if head[0] == BLANK else self.stretch[head]) + self.stretch[s[-1]]
        cuts = [i for i in range(1, len(s)) if s[i - 1:i + 1] not in joints]
        if not cuts:
            return self._stretch(s)
        parts = [s[i:j] for i, j in zip([0, *cuts], [*cuts, len(s)])]
        return b"".join(self.word[x[1:]] if x[0] == BLANK else self.stretch[x] for x in parts)

    def _path(self, before: str, rest: str) -> bytes | None:
        """Byte-pair model: the ids of the path of finite weight over ``rest``
        after the piece ``before``, or None; as ``_least_pieces``, longest arcs
        first. Ends of words recur more than words do, so what a state leads to
        is held and shared by all words that come to it."""
        key = (before, rest)
        if (held := self.ends.get(key, 0)) != 0:
            return held
        n, found = len(rest), []
        arcs, stems, j, sub = self.arcs, self.stems, 1, rest[0]
        if sub not in arcs:
            found.append(sub)
        while sub in stems:
            if sub in arcs:
                found.append(sub)
            j += 1
            if j > n:
                break
            sub = rest[:j]
        seen, out = self._next.get(before), None
        for sub in reversed(found):
            if before:
                ok = seen.get(sub) if seen is not None else None
                if not (self._follows(before, sub) if ok is None else ok):
                    continue
            if len(sub) == n:
                out = self.coded[sub]
                break
            if (tail := self._path(sub, rest[len(sub):])) is not None:
                out = self.coded[sub] + tail
                break
        if len(self.ends) >= CACHE:
            self.ends.clear()
        self.ends[key] = out
        return out

    def _least_pieces(self, s: str) -> tuple[list, list]:
        """Byte-pair model: every prefix of a text has one path of finite
        weight, so a depth-first search over arcs of finite weight, longest
        first, finds the shortest path; a place that it had to leave is on no
        such path and is not entered again."""
        n = len(s)
        back, last = [0] * (n + 1), [""] * (n + 1)
        arcs, stems, pairs, follows = self.arcs, self.stems, self._next, self._follows
        dead = bytearray(n + 1)
        open_: list[tuple[int, list[str]]] = []
        i, before, found = 0, "", None
        while True:
            if found is None:
                found, j, sub = [], i + 1, s[i]
                if sub not in arcs:
                    found.append(sub)
                while sub in stems:
                    if sub in arcs:
                        found.append(sub)
                    j += 1
                    if j > n:
                        break
                    sub = s[i:j]
            seen = pairs.get(before)
            while found:
                sub = found.pop()
                j = i + len(sub)
                if dead[j]:
                    continue
                if i:
                    ok = seen.get(sub) if seen is not None else None
                    if not (follows(before, sub) if ok is None else ok):
                        continue
                back[j], last[j] = i, sub
                if j == n:
                    return last, back
                open_.append((i, found))
                i, before, found = j, sub, None
                break
            else:
                dead[i] = 1
                i, found = open_.pop()
                before = last[i]

    def _least_weight(self, s: str) -> tuple[list, list]:
        """Unigram model: the least sum of negative scores."""
        n = len(s)
        dist, back, last = [0.0] + [_INF] * n, [0] * (n + 1), [""] * (n + 1)
        arcs, stems, weight = self.arcs, self.stems, self.weight
        for i in range(n):
            j, sub = i + 1, s[i]
            if sub not in arcs and dist[i] + self.unknown_weight < dist[j]:
                dist[j], back[j], last[j] = dist[i] + self.unknown_weight, i, sub
            while sub in stems:
                if sub in arcs and dist[i] + weight[sub] < dist[j]:
                    dist[j], back[j], last[j] = dist[i] + weight[sub], i, sub
                j += 1
                if j > n:
                    break
                sub = s[i:j]
        return last, back

    def forget(self) -> None:
        """Empties the caches: a Python worker may live on for other work."""
        for cache in (self.stretch, self.word):
            cache.forget()
        self._next.clear()
        self.ends.clear()
        self._pairs = 0

    def encode_bytes(self, text: str | None) -> bytes:
        """The ids of ``text``, 4 bytes each."""
        if not text:
            return b""
        if not self.cuts:
            return self._stretch(self.prefix + text.replace(" ", BLANK))
        out: list[bytes] = []
        prefix = self.prefix
        for at, line in enumerate(text.split("\n")):
            if at:
                out.append(self.line_end)
                prefix = ""
            if "  " in line or BLANK in line or (prefix and line[:1] == " "):
                out += map(self.stretch.__getitem__, self.runs.findall(prefix + line.replace(" ", BLANK)))
            elif prefix:
                out += map(self.word.__getitem__, line.split(" "))
            else:
                words = line.split(" ")
                if words[0]:
                    out.append(self.stretch[words[0]])
                out += map(self.word.__getitem__, words[1:])
        return b"".join(out)

    def encode(self, text: str | None) -> list[int]:
        b = self.encode_bytes(text)
        return [int.from_bytes(b[i:i + 4], "little") for i in range(0, len(b), 4)]

    def decode(self, ids) -> str:
        """The text of ``ids``; bytes that are no UTF-8 become U+FFFD."""
        text = b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


_COMPILED: dict[int, Transducer] = {}


def _transducer(model: bytes) -> Transducer:
    """Compiled once in a Python worker."""
    key = hash(model)
    if key not in _COMPILED:
        _COMPILED[key] = Transducer(model)
    return _COMPILED[key]


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """(key, ids, n_pieces, round_trip) for every row: the piece ids of the
    whole text and whether decoding them gives the text back.

    A null text encodes like an empty one, to no pieces. A text that holds
    U+2581 itself decodes to a blank there, as with any SentencePiece model:
    ``round_trip`` is then false. Long texts without blanks are one stretch,
    in time linear in their length. Repeated rows stay repeated, an empty
    table gives no rows, other columns of ``docs`` are ignored. The model file
    is read where the driver runs and sent along (its size is its bound)."""
    spec = docs.sparkSession.sparkContext.broadcast(Path(model).read_bytes())
    d = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        t = _transducer(spec.value)
        for b in slices(batches):
            texts = b.column(1).to_pylist()
            coded = [t.encode_bytes(x) for x in texts]
            sizes = np.fromiter((len(c) // 4 for c in coded), dtype=np.int32, count=len(coded))
            ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32)
            flat = pa.array(np.frombuffer(b"".join(coded), dtype="<i4"))
            same = [t.decode(np.frombuffer(c, dtype="<i4").tolist()) == (x or "") for c, x in zip(coded, texts)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(ends), flat), pa.array(sizes), pa.array(same)],
                names=[key, "ids", "n_pieces", "round_trip"])
        t.forget()

    kind = d.schema["_key"].dataType.simpleString()
    return d.mapInArrow(run, f"`{key}` {kind}, ids array<int>, n_pieces int, round_trip boolean")


def decode(coded: DataFrame, key: str = "doc_id", ids: str = "ids", model: str = MODEL) -> DataFrame:
    """(key, text): the texts that ``ids`` spell; a null list spells ''."""
    spec = coded.sparkSession.sparkContext.broadcast(Path(model).read_bytes())
    d = coded.select(F.col(key).alias("_key"), F.col(ids).alias("_ids"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        t = _transducer(spec.value)
        for b in slices(batches):
            texts = [t.decode(x or ()) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    kind = d.schema["_key"].dataType.simpleString()
    return d.mapInArrow(run, f"`{key}` {kind}, text string")
