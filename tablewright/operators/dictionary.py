"""Dictionary encoding of token arrays (P8, P9): a distributed table of token
numbers, and rows as sparse vectors over it.

The numbers are dense and come from range partitions and their offsets, so the
vocabulary is never in one task or on the driver. Rows meet the dictionary by
token; a row's tokens are counted first, so a token is looked up once a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.prefix import global_rank


def token_dictionary(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """``token``, ``token_id`` (from 0, in the order of the tokens' bytes) and
    ``n_rows`` (rows that hold it). Null tokens and null arrays have none."""
    each = df.select(F.explode(F.array_distinct(tokens)).alias("token")).where("token is not null")
    counted = each.groupBy("token").agg(F.count(F.lit(1)).alias("n_rows"))
    ranked = global_rank(counted, ["token"], name="token_id")
    return ranked.select("token", (F.col("token_id") - 1).alias("token_id"), "n_rows")


def sparse_vectors(df: DataFrame, key: Sequence[str], dictionary: DataFrame, tokens: str = "tokens") -> DataFrame:
    """A row for each ``key``: ``indices`` (ascending numbers of its tokens),
    ``counts`` (how often each stands there) and ``n_unknown`` (tokens that the
    dictionary lacks, repeats counted). Keys without tokens have empty arrays;
    rows of equal key are one vector; a null key is a key."""
    ids = dictionary.select(F.col("token").alias("_token"), F.col("token_id").alias("_id"))
    many = (df.select(*key, F.explode_outer(tokens).alias("_word"))
            .groupBy(*key, "_word").agg(F.count(F.lit(1)).alias("_many")))
    met = many.join(ids, F.col("_word") == F.col("_token"), "left")
    pair = F.when(F.col("_id").isNotNull(), F.struct("_id", "_many"))
    unknown = F.when(F.col("_id").isNull() & F.col("_word").isNotNull(), F.col("_many")).otherwise(0)
    rows = met.groupBy(*key).agg(F.sort_array(F.collect_list(pair)).alias("_v"), F.sum(unknown).alias("n_unknown"))
    return rows.select(*key, F.col("_v._id").alias("indices"), F.col("_v._many").alias("counts"), "n_unknown")


def decode_vectors(vectors: DataFrame, key: Sequence[str], dictionary: DataFrame) -> DataFrame:
    """``key``, ``token``, ``n``: the tokens of ``sparse_vectors`` again."""
    each = vectors.select(*key, F.explode(F.arrays_zip("indices", "counts")).alias("_e"))
    return (each.select(*key, F.col("_e.indices").alias("token_id"), F.col("_e.counts").alias("n"))
            .join(dictionary.select("token_id", "token"), "token_id").select(*key, "token", "n"))
