"""Ranked lexical search of many items at once, sharing their common parts.

The items of a block are evaluated together. Terms that the same items use the
same number of times form a set; a set's accumulator (the sum of its terms'
impacts in a document) is made once and serves all its items. The sets of an
item, the most shared first, make a sequence; neighbouring sets that several
items have side by side become one node, in rounds, until no pair of nodes is
shared. The nodes form a DAG: each is added up once a document from the two
below it, and an item is the sum of the few nodes left in its sequence.

Two passes over the documents: one counts the items' terms in each (stored),
the other turns counts into impacts, runs the DAG over slices of documents and
keeps each item's best ``k`` of a task. A last window ranks what tasks kept."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.common import cut, slices
from tablewright.session import scratch_path

#: Documents returned for an item.
BEST = 10

#: Bytes of item texts evaluated together; more items are taken in blocks.
BLOCK_BYTES = 1 << 20

#: Accumulators (nodes x documents) held at once, 8 bytes each.
CELLS = 4 << 20

#: Terms are runs of ASCII letters, digits and all beyond ASCII; A-Z lower-cased.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return text.translate(_TERM_BYTES).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass
class Dag:
    """``leaf``: the accumulator of each term; ``scale``: (node, leaf, times);
    ``rounds``: (nodes, left, right); ``parts``, ``starts``: the nodes whose
    sum is an item, one item after the other; ``items``: its number."""

    n_leaves: int
    n_nodes: int
    leaf: np.ndarray
    scaled: np.ndarray
    rounds: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    parts: np.ndarray
    starts: np.ndarray
    items: np.ndarray


def share(items: list[dict[int, int]], n_terms: int) -> Dag:
    """The DAG of ``items`` (term -> times used). Terms in no item get leaf -1.
    Work is linear in the terms of all items for each round."""
    uses: list[list[tuple[int, int]]] = [[] for _ in range(n_terms)]
    for i, item in enumerate(items):
        for t, times in item.items():
            uses[t].append((i, times))
    leaf, sets = np.full(n_terms, -1, np.int64), {}
    for t, use in enumerate(uses):
        if use:
            leaf[t] = sets.setdefault(tuple(use), len(sets))
    scaled, rows = {}, [[] for _ in items]
    for use, s in sorted(sets.items(), key=lambda x: (-len(x[0]), x[1])):
        for i, times in use:
            rows[i].append(scaled.setdefault((s, times), len(scaled)))
    n, rounds = len(scaled), []
    while True:
        pairs = Counter(p for row in rows for p in zip(row, row[1:]))
        pairs = {p: c for p, c in pairs.items() if c > 1}
        if not pairs:
            break
        new: dict[tuple[int, int], int] = {}
        for i, row in enumerate(rows):
            taken = set()
            for at in sorted(range(len(row) - 1), key=lambda x: (-pairs.get((row[x], row[x + 1]), 0), x)):
                if (row[at], row[at + 1]) in pairs and not {at - 1, at, at + 1} & taken:
                    taken.add(at)
            out, at = [], 0
            while at < len(row):
                if at in taken:
                    out.append(new.setdefault((row[at], row[at + 1]), n + len(new)))
                    at += 1
                else:
                    out.append(row[at])
                at += 1
            rows[i] = out
        ends = np.array(list(new), np.int64).reshape(-1, 2)
        rounds.append((np.arange(n, n + len(new)), ends[:, 0], ends[:, 1]))
        n += len(new)
    full = [i for i, row in enumerate(rows) if row]
    return Dag(len(sets), n, leaf, np.array(list(scaled), np.int64).reshape(-1, 2), rounds,
               np.array([s for i in full for s in rows[i]], np.int64),
               np.cumsum([0, *(len(rows[i]) for i in full)])[:-1].astype(np.int64), np.array(full, np.int64))


def evaluate(dag: Dag, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_docs: int) -> np.ndarray:
    """Scores (items of ``dag.items`` x documents) of the impacts."""
    leaves = np.zeros((dag.n_leaves, n_docs), np.int64)
    used = dag.leaf[term] >= 0
    np.add.at(leaves, (dag.leaf[term[used]], doc[used]), impact[used])
    nodes = np.empty((dag.n_nodes, n_docs), np.int64)
    np.multiply(leaves[dag.scaled[:, 0]], dag.scaled[:, 1:], out=nodes[:len(dag.scaled)])
    for node, left, right in dag.rounds:
        nodes[node] = nodes[left] + nodes[right]
    return np.add.reduceat(nodes[dag.parts], dag.starts) if len(dag.parts) else np.empty((0, n_docs), np.int64)


class Best:
    """The ``k`` best (score, null key last, key) of every item seen so far."""

    def __init__(self, n_items: int, k: int):
        self.k, self.rows, self.least = k, np.empty((4, 0), np.int64), np.ones(n_items, np.int64)

    def add(self, scores: np.ndarray, null: np.ndarray, key: np.ndarray) -> None:
        i, d = np.nonzero(scores >= self.least[:, None])
        if not len(i):
            return
        rows = np.concatenate([self.rows, np.stack([i, scores[i, d], null[d], key[d]])], 1)
        rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
        first = np.flatnonzero(np.r_[True, rows[0, 1:] != rows[0, :-1]])
        place = np.arange(rows.shape[1]) - np.repeat(first, np.diff(np.r_[first, rows.shape[1]]))
        self.rows = rows[:, place < self.k]
        full = place == self.k - 1
        self.least[rows[0, full]] = rows[1, full]


def _counted(documents: DataFrame, key: str, text: str, known: dict[bytes, int]) -> DataFrame:
    """(key, n, terms, times) of every document with a term; stored."""
    spark = documents.sparkSession
    number = spark.sparkContext.broadcast(known)
    kind = documents.schema[key].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = number.value
        for batch in slices(batches):
            n, which, times, at = [], [], [], [0]
            for t in batch.column(1).cast(pa.binary()).to_pylist():
                words = terms(t)
                n.append(len(words))
                found = Counter(words)
                for w in ids.keys() & found.keys():
                    which.append(ids[w])
                    times.append(found[w])
                at.append(len(which))
            lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x, pa.int32())) for x in (which, times)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), *lists], [key, "n", "terms", "times"])

    path = scratch_path(spark, "counted-terms")
    (documents.select(key, text).where(F.col(text).isNotNull())
     .mapInArrow(count, f"`{key}` {kind}, n long, terms array<int>, times array<int>")
     .where("n > 0").write.parquet(path))
    return spark.read.parquet(path)


def _best(counted: DataFrame, key: str, keys: list, item_field, weights: np.ndarray, dag: Dag,
          n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item key, its number, key, score): the best ``k`` of each item and task."""
    sent = counted.sparkSession.sparkContext.broadcast((dag, weights, keys))
    kind = counted.schema[key].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type
    item_kind, key_kind = to_arrow_type(item_field.dataType), to_arrow_type(counted.schema[key].dataType)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dag, w, names = sent.value
        best = Best(len(dag.items), k)
        for batch in slices(batches, max(16, min(4096, CELLS // max(1, dag.n_nodes + dag.n_leaves)))):
            n = batch.column(1).to_numpy()
            which, times = batch.column(2), batch.column(3)
            size = np.diff(which.offsets.to_numpy())
            doc = np.repeat(np.arange(len(n)), size)
            term, tf = (x.flatten().to_numpy().astype(np.int64) for x in (which, times))
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            impact = w[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
            ids = batch.column(0)
            best.add(evaluate(dag, term, doc, impact, len(n)),
                     np.asarray(ids.is_null()).astype(np.int64), ids.cast(pa.int64()).fill_null(0).to_numpy())
        i, score, null, ids = best.rows
        number = dag.items[i]
        yield pa.RecordBatch.from_arrays(
            [pa.array([names[x] for x in number.tolist()], item_kind), pa.array(number, pa.int64()),
             pa.array(ids, pa.int64(), mask=null.astype(bool)).cast(key_kind), pa.array(score, pa.int64())],
            ["item", "number", "key", "score"])

    return counted.mapInArrow(search, f"item {item_field.dataType.simpleString()}, number long, key {kind}, score long")


def _item_terms(c: str) -> Column:
    lower = F.translate(F.col(c), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"), F.lit(1))


def lexical_search(documents: DataFrame, items: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id",
                   text: str = "text", item_text: str = "text", k: int = BEST,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_key, rank, doc_key, score): the ``k`` documents of the highest
    score above 0 for every item, equal scores by ascending key.

    A term's weight is floor(1000 * ln((2N + 2) / (2 df + 1))), its impact in
    a document weight * (10^9 tf div (1000 tf + 8 m)), m = 25 + 75 n N div L,
    and a score the sum over the item's terms, repeats included; N and L count
    the documents with a term and all their terms. Keys of documents are whole
    numbers; a null key comes last among equal scores.

    Null and empty texts have no terms: such documents never show, such items
    give no row. Equal rows of ``items`` count once; rows of one key and
    different texts are items of their own, each ranked from 1. Repeated rows
    of documents are documents of their own. Other columns are not read. All
    documents are read once to count and the counts once a block; blocks hold
    ``block_bytes`` of item texts, whose terms are all that is sent to tasks."""
    spark: SparkSession = documents.sparkSession
    q = cut(items.select(F.col(item_key).alias("item"), F.col(item_text).alias("t"))
            .where(F.col("t").isNotNull()).distinct())
    size = q.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    placed = q.withColumn("block", F.pmod(F.xxhash64("item", "t"), F.lit(blocks)))
    out = []
    for b in range(blocks):
        block = placed.where(F.col("block") == b).select("item", _item_terms("t").alias("terms")).collect()
        known: dict[bytes, int] = {}
        wanted = [Counter(known.setdefault(w.encode(), len(known)) for w in r.terms) for r in block]
        if not known:
            continue
        counted = _counted(documents, doc_key, text, known)
        n_docs, n_terms = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            break
        weights = np.zeros(len(known), np.int64)
        for t, df in counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1))).collect():
            weights[t] = weight(n_docs, df)
        dag = share([{t: c for t, c in x.items() if weights[t]} for x in wanted], len(known))
        out.append(_best(counted, doc_key, [r.item for r in block], q.schema["item"], weights, dag, n_docs, n_terms, k)
                   .withColumn("block", F.lit(b)))
    names = (F.col("item").alias(item_key), "rank", F.col("key").alias(doc_key), "score")
    if not out:
        kinds = f"item {q.schema['item'].dataType.simpleString()}, rank int, key {documents.schema[doc_key].dataType.simpleString()}, score long"
        return spark.createDataFrame([], kinds).select(*names)
    found = out[0]
    for f in out[1:]:
        found = found.unionByName(f)
    order = Window.partitionBy("block", "number").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(*names)
