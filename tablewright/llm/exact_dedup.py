"""Exact deduplication by progressive refinement: length, prefix hash, full
hash. DataFrame functions only.

Rows that nothing else resembles leave early: a row goes on only while its
group (same normalised length, then also same prefix hash) holds two rows or
more, and only rows that go on have their whole content hashed.

1. One scan of the texts yields a count per (length, prefix hash), combined
   before the shuffle. Lengths with one row are dropped, then prefix groups
   with one row.
2. The surviving groups become a bitmap of ``bits`` bits (``bits / 8`` bytes,
   whatever the number of groups: its size is the broadcast's bound). A row
   whose bit is unset is alone. A row whose bit is set by another group's hash
   only costs one hash more; it stays alone, as the full hash decides.
3. A second scan hashes the survivors in place. Texts are never shuffled, only
   32-byte hashes. Groups are counted with a combine before the shuffle, so a
   group holding a third of all rows is one buffer per task; the join back is
   an ordinary equi-join, which adaptive execution splits when skewed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import broadcast_if_small, cut, text_or_empty

#: Characters of the normalised text that the prefix hash covers.
PREFIX_CHARS = 64
#: Bits of the survivors' bitmap: 2 MB once set up.
BITMAP_BITS = 1 << 24


def normalised(text: str) -> Column:
    """The text with every run of ASCII white space made one space; null: ''."""
    return F.regexp_replace(text_or_empty(text), r"[\x20\x09-\x0D]+", " ")


def _bit(bits: int) -> Column:
    return F.pmod(F.xxhash64("_len", "_pre"), F.lit(bits))


def survivors_bitmap(groups: DataFrame, bits: int) -> DataFrame:
    """(_bucket, _map): one bit per surviving (length, prefix) group."""
    b = groups.select(_bit(bits).alias("_b"))
    return b.groupBy(F.bitmap_bucket_number("_b").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_b")).alias("_map"))


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text",
                carry: tuple[str, ...] = (), prefix_chars: int = PREFIX_CHARS,
                bits: int = BITMAP_BITS) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``carry`` columns, ``keep_key``
    (smallest key among the equal texts), ``group_size``, ``kept`` and
    ``full_hash`` (null where the text was alone before its full hash).

    Null and empty texts are equal to each other and to no other text. Rows
    repeated with the same key count in ``group_size`` and share one decision,
    so all rows with the smallest key are kept. Null keys sort last: a group
    with only null keys has a null ``keep_key`` and keeps its rows. An empty
    table gives no rows. Other columns of ``docs`` are ignored, whatever their
    names."""
    d = docs.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_carry{i}") for i, c in enumerate(carry)],
                    normalised(text).alias("_text"))
    d = d.withColumns({"_len": F.length("_text"),
                       "_pre": F.xxhash64(F.substring("_text", 1, prefix_chars))})

    by_prefix = d.groupBy("_len", "_pre").agg(F.count(F.lit(1)).alias("_n"))
    by_length = by_prefix.groupBy("_len").agg(F.sum("_n").alias("_rows")).where("_rows > 1")
    alive = by_prefix.where("_n > 1").join(by_length, "_len", "left_semi")
    bitmap = cut(survivors_bitmap(alive, bits))

    p = F.bitmap_bit_position("_b").cast("int")
    byte = F.conv(F.hex(F.substring("_map", F.floor(p / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, p % 8) == 1, F.lit(False))
    rows = (d.withColumn("_b", _bit(bits))
            .withColumn("_bucket", F.bitmap_bucket_number("_b"))
            .join(F.broadcast(bitmap), "_bucket", "left")
            .withColumn("_full", F.when(hit, F.unhex(F.sha2("_text", 256)))))
    rows = cut(rows.select("_key", *[f"_carry{i}" for i in range(len(carry))], "_full"))

    groups = (rows.where("_full is not null").groupBy("_full")
              .agg(F.min("_key").alias("_keep"), F.count(F.lit(1)).alias("_size"))
              .where("_size > 1"))
    # stored, so that the join's own shuffles are all it needs and adaptive
    # execution may split the rows of a large group
    groups = broadcast_if_small(cut(groups), 80)
    # rows without a full hash are alone; they would all meet in one task of
    # the join under its null key
    alone = rows.where("_full is null").withColumns({"_keep": F.col("_key"), "_size": F.lit(None).cast("long")})
    out = rows.where("_full is not null").join(groups, "_full", "left").unionByName(alone)
    return out.select(
        F.col("_key").alias(key), *[F.col(f"_carry{i}").alias(c) for i, c in enumerate(carry)],
        F.when(F.col("_size").isNull(), F.col("_key")).otherwise(F.col("_keep")).alias("keep_key"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("_size").isNull() | F.col("_key").eqNullSafe(F.col("_keep"))).alias("kept"),
        F.lower(F.hex("_full")).alias("full_hash"))
