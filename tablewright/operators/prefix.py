"""Ranks and running sums over tables of any size.

A window without a partition key sorts the whole table in one task. Here the
rows are dealt out by ranges of the order, sorted within each partition, and
stored; each partition's count or sum (one row a partition) gives the offset
of the next, and a row's rank is its partition's offset and its place there.
With ``by`` the same holds within each group, so one group with a third of
all rows is ranked by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.sources.files import stored

#: monotonically_increasing_id counts from the partition's number times this.
_PLACES = 1 << 33


def _columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def range_sorted(df: DataFrame, order: Sequence[str | Column], by: Sequence[str] = (),
                 partitions: int | None = None) -> DataFrame:
    """``df`` in range partitions of (``by``, ``order``), sorted within them
    and stored, with ``_pid`` (the partition) and ``_at`` (a row's place in
    it, from 0). Rows that are equal in all of ``order`` stand side by side in
    one partition: add a key where many are."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*[F.col(c) for c in by], *_columns(order)]
    d = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id()
    return stored(d.withColumn("_pid", F.floor(place / _PLACES).cast("int")).withColumn("_at", place % _PLACES))


def _joined(rows: DataFrame, parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """``rows`` and the columns of ``parts`` for its partition and group."""
    keyed = parts.withColumnsRenamed({c: f"_by_{c}" for c in ("_pid", *by)})
    same = F.col("_pid") == F.col("_by__pid")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    if not by:                                  # one row a partition
        keyed = F.broadcast(keyed)
    return rows.join(keyed, same).drop(*[f"_by_{c}" for c in ("_pid", *by)])


def _before(parts: DataFrame, by: Sequence[str], sums: dict[str, str]) -> DataFrame:
    """``parts`` with, for each name and column of ``sums``, the column's sum
    over the earlier partitions (of the group): a window over one row a
    partition and group."""
    w = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("_pid", *by, *[c for c in parts.columns if c not in ("_pid", *by, *sums.values())],
                        *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(name) for name, c in sums.items()])


def global_rank(df: DataFrame, order: Sequence[str | Column], by: Sequence[str] = (), name: str = "rank",
                partitions: int | None = None) -> DataFrame:
    """``df`` with ``name``: the row's number from 1 in ``order``, in each group
    of ``by`` (nulls are one group). Ties are numbered in some order; add a
    unique key to ``order`` for one that is always the same. No rows: none."""
    rows = range_sorted(df, order, by, partitions)
    parts = rows.groupBy("_pid", *by).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    ranked = _joined(rows, _before(parts, by, {"_offset": "_n"}), by)
    return ranked.withColumn(name, F.col("_offset") + F.col("_at") - F.col("_first") + 1).drop("_pid", "_at", "_offset", "_first")


def running_sums(df: DataFrame, order: Sequence[str | Column], sums: dict[str, str], by: Sequence[str] = (),
                 partitions: int | None = None) -> DataFrame:
    """``df`` with, for each name and column of ``sums``, the column's sum over
    the rows up to and with this one in ``order`` (nulls add nothing), in each
    group of ``by``. ``order`` must tell rows apart."""
    rows = range_sorted(df, order, by, partitions)
    parts = rows.groupBy("_pid", *by).agg(*[F.sum(c).alias(f"_s_{name}") for name, c in sums.items()])
    before = _before(parts, by, {f"_o_{name}": f"_s_{name}" for name in sums})
    inside = Window.partitionBy("_pid", *by).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    here = rows.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_i_{name}") for name, c in sums.items()])
    out = _joined(here, before, by)
    return out.select(*df.columns, *[(F.col(f"_o_{name}") + F.col(f"_i_{name}")).alias(name) for name in sums])
