"""Helpers the operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.session import shared_dir

#: A word of the contracts: a run without the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

#: Largest table that is ever broadcast by hint, after its bytes are counted.
BROADCAST_BYTES = 8 << 20

#: Rows of texts that a Python task works on at once.
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: later steps read the
    stored rows, so a lost executor costs no recomputation of what came
    before. Reliable ``checkpoint``, never ``localCheckpoint``."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, row_bytes: Column | int,
                       limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (stored already) with a broadcast hint if its rows, counted in
    bytes by ``row_bytes``, stay within ``limit``; otherwise unchanged, for a
    shuffled join."""
    size = df.agg(F.sum(F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes)).first()[0]
    return F.broadcast(df) if (size or 0) <= limit else df


def slices(batches: Iterator, rows: int = SLICE_ROWS) -> Iterator:
    """Arrow batches cut into smaller ones, for tasks over texts: what is made
    of a batch (Python strings, results on their way back to the JVM) stays
    small, however many rows Spark sends at once."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def text_or_empty(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of the undirected ``edges``, component
    being the smallest node reachable.

    Alternating large-star and small-star rounds: every step is a grouped
    minimum (combined before the shuffle) and a join that adaptive execution
    may split when one node has very many edges. Each round's edges are
    stored; the loop ends when a round changes nothing. No edges: no rows."""
    e = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
            .where("u <> v").distinct())
    state = _fingerprint(e)
    while True:
        e = cut(_small_star(_large_star(e)))
        now = _fingerprint(e)
        if now == state:
            break
        state = now
    # every edge now leads from a node to the smallest node of its component
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _fingerprint(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = low.select("u", F.col("m").alias("v"))
    return moved.unionByName(kept).distinct()
