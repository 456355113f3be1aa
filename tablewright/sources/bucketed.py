"""Bucketed tables (J1-J5, S4): rows dealt out by their join key once, when they
are written, so that later joins and group statistics need no Exchange.

A hot key would fill one bucket, so the bucket is that of the key and a salt
(``salts`` values, from columns that tell rows apart): a group's rows lie in
several buckets, its partial aggregates are merged, and the small side of a
join has each row once a salt. Two large tables with as many buckets and no
salt meet bucket by bucket.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.session import scratch_path

SALT = "_salt"


def write_bucketed(df: DataFrame, keys: Sequence[str], buckets: int, salts: int = 1,
                   salt_by: Sequence[str] = (), columns: Sequence[str] = ()) -> DataFrame:
    """``df`` (or its ``columns``) as a table of ``buckets`` by ``keys`` and
    ``_salt``, sorted in each, one file a bucket, under the shared folder; read
    back. ``salt_by`` (all columns by default) spreads the rows of a key; equal
    rows stay together, and salts are dealt to buckets by hash: take more of
    them than buckets. With one salt there is no ``_salt``. The table is
    known to the session's catalog under a name of its own."""
    kept = list(columns or df.columns)
    by = list(keys)
    if salts > 1:
        df = df.withColumn(SALT, F.pmod(F.xxhash64(*(salt_by or df.columns)), F.lit(salts)).cast("int"))
        by, kept = [*by, SALT], [*kept, SALT]
    name = f"bucketed_{uuid.uuid4().hex}"
    (df.select(*kept).repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy(*by)
     .option("path", scratch_path(df.sparkSession, "bucketed")).saveAsTable(name))
    return df.sparkSession.table(name)


def join_bucketed(large: DataFrame, small: DataFrame, keys: Sequence[str], salts: int = 1) -> DataFrame:
    """Inner equi-join with a bucketed table: ``small`` moves (each row once a
    salt), ``large`` does not. Keys that are null join nothing."""
    if salts == 1:
        return large.join(small, list(keys))
    each = small.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return large.join(each, [*keys, SALT]).drop(SALT)


def grouped_bucketed(large: DataFrame, keys: Sequence[str], sums: dict[str, str], count: str = "count",
                     salts: int = 1) -> DataFrame:
    """Rows (``count``) and, for each name and column of ``sums``, the sum by
    ``keys`` of a bucketed table: no Exchange of rows, only of one row a key
    and salt. Null keys are a group."""
    by = [*keys, SALT] if salts > 1 else list(keys)
    parts = large.groupBy(*by).agg(F.count(F.lit(1)).alias(count), *[F.sum(c).alias(n) for n, c in sums.items()])
    if salts == 1:
        return parts
    return parts.groupBy(*keys).agg(F.sum(count).alias(count), *[F.sum(n).alias(n) for n in sums])
