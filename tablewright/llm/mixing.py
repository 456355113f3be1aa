"""Mixing sources to target weights by capped water-filling. DataFrame
functions only.

Sources get a share of the mix by weight. A source's target stops at
``max_epochs`` times its size; what is above goes to the other sources by
weight, until no target is above its cap. A source's target is then met by
whole repetitions of all its rows and one fractional repetition: the rows that
come first by a seeded hash, up to the remainder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.columns import hash60
from tablewright.llm.common import WORD, broadcast_if_small, cut, text_or_empty

#: The weights of the sources in code-point order, over and over.
WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MAX_EPOCHS = 2.0
SEED = 17

#: Hash buckets that locate a source's cut before single rows are looked at.
BUCKET_BITS = 12


def word_count(text: str) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def water_fill(sources: DataFrame, total: Column, max_epochs: float) -> DataFrame:
    """Adds ``target`` to ``sources`` (``size``, ``weight``; one row each).

    The fixed point of clamping and sharing anew, in closed form: sort by
    cap / weight; the sources before the first one that the common level does
    not fill stand at their caps, the others get the level times their
    weight. The two windows run over one row per source, never over rows of
    the corpus."""
    cap = F.col("size") * F.lit(max_epochs)
    order = Window.orderBy(F.col("_cap") / F.col("weight"), "_rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    s = sources.withColumns({"_cap": cap, "_total": total})
    s = s.withColumn("_level", (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
                     / F.sum("weight").over(after))
    fits = F.when(F.col("_level") <= F.col("_cap") / F.col("weight"), F.col("_level"))
    level = F.first(fits, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return s.withColumn("target", F.least("_cap", F.coalesce(level * F.col("weight"), F.col("_cap"))))


def source_plan(rows: DataFrame, weights: tuple, total_share: float, max_epochs: float) -> DataFrame:
    """(_source, source_size, target, _whole, _rest) from ``rows``
    (_source, _size, _h)."""
    s = rows.groupBy("_source").agg(F.sum("_size").alias("size"))
    rank = F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last())) - 1
    s = s.withColumn("_rank", rank)
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                            (F.col("_rank") % len(weights) + 1).cast("int")))
    every = Window.partitionBy(F.lit(0))
    s = water_fill(s, F.sum("size").over(every) * F.lit(total_share), max_epochs)
    whole = F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(F.lit(0)).cast("long")
    s = s.withColumn("_whole", whole)
    return s.select("_source", F.col("size").alias("source_size"), "target", "_whole",
                    (F.col("target") - F.col("_whole") * F.col("size")).alias("_rest"))


def source_cuts(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` with ``_cut``: rows with ``_h`` up to it are in the fractional
    repetition.

    Sizes are summed per source and hash bucket first (combined before the
    shuffle); only the bucket in which a source's remainder ends is sorted row
    by row, 1 / 4096 of the source. Rows with an equal hash go together. The
    row at the cut is in if that comes nearer to the remainder."""
    shift = 60 - BUCKET_BITS
    bucket = F.shiftright("_h", shift)
    sums = rows.groupBy("_source", bucket.alias("_bucket")).agg(F.sum("_size").alias("_sum"))
    same = lambda a, b: a["_source"].eqNullSafe(b["_source"])
    run = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    need = plan.select("_source", "_rest")
    at = sums.join(need, same(sums, need)).select(sums["_source"], "_bucket", "_sum", "_rest")
    at = at.withColumn("_cum", F.sum("_sum").over(run))
    edge = (at.where("_cum > _rest").groupBy("_source")
            .agg(F.min(F.struct("_bucket", (F.col("_cum") - F.col("_sum")).alias("_before"), "_rest")).alias("_e"))
            .select(F.col("_source").alias("_esource"), F.col("_e._bucket").alias("_ebucket"),
                    F.col("_e._before").alias("_before"), F.col("_e._rest").alias("_erest")))
    edge = cut(edge)
    inner = rows.join(broadcast_if_small(edge, 256), rows["_source"].eqNullSafe(F.col("_esource"))
                      & (bucket == F.col("_ebucket")))
    ties = inner.groupBy("_esource", "_ebucket", "_before", "_erest", "_h").agg(F.sum("_size").alias("_sum"))
    upto = Window.partitionBy("_esource").orderBy("_h").rowsBetween(Window.unboundedPreceding, 0)
    ties = ties.withColumn("_cum", F.col("_before") + F.sum("_sum").over(upto))
    over, under = F.col("_cum") - F.col("_erest"), F.col("_erest") - (F.col("_cum") - F.col("_sum"))
    last = (ties.where((over <= 0) | (over < under)).groupBy("_esource").agg(F.max("_h").alias("_last")))
    edge = edge.join(last.withColumnRenamed("_esource", "_lsource"), F.col("_esource").eqNullSafe(F.col("_lsource")), "left")
    edge = edge.select("_esource", F.coalesce("_last", F.shiftleft("_ebucket", shift) - 1).alias("_ecut"))
    # no edge: the remainder is the whole source
    return (plan.join(edge, plan["_source"].eqNullSafe(edge["_esource"]), "left")
            .withColumn("_cut", F.coalesce("_ecut", F.lit((1 << 60) - 1)))
            .select("_source", "source_size", "target", "_whole", F.col("_rest").alias("_left"), "_cut"))


def _decided(docs: DataFrame, key: str, text: str, source: str, weights: tuple,
             total_share: float, max_epochs: float, seed: int) -> DataFrame:
    """``docs`` with ``_size``, ``_csize``, ``_ctarget`` and ``_copies``."""
    facts = {"_source": F.col(source), "_size": word_count(text),
             "_h": hash60(seed, F.col(key), F.md5(text_or_empty(text)))}
    rows = cut(docs.select(*[v.alias(k) for k, v in facts.items()]))
    plan = cut(source_plan(rows, weights, total_share, max_epochs))
    cuts = cut(source_cuts(rows, plan))
    cuts = broadcast_if_small(cuts, F.lit(64) + F.coalesce(F.octet_length(F.col("_source").cast("string")), F.lit(0)))
    cuts = cuts.select(F.col("_source").alias("_csource"), F.col("source_size").alias("_csize"),
                       F.col("target").alias("_ctarget"), "_whole", "_left", "_cut")
    d = docs.withColumns({"_size": facts["_size"], "_h": facts["_h"]})
    d = d.join(cuts, d[source].eqNullSafe(F.col("_csource")), "left")
    return d.withColumn("_copies", F.col("_whole") + ((F.col("_left") > 0) & (F.col("_h") <= F.col("_cut"))).cast("long"))


def mix_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
               weights: tuple = WEIGHTS, total_share: float = TOTAL_SHARE,
               max_epochs: float = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """``docs`` with ``size`` (words), ``source_size``, ``target`` and
    ``copies`` (how often the mix takes the row); a column of ``docs`` with
    one of these names is replaced.

    Null sources are one source and come last. A null or empty text has size 0
    and is in the mix like other rows of its hash; where whole repetitions meet
    the target there is no other, and none of a source of size 0. The choice is a function of
    seed, key and text alone: reruns and lost executors give the same rows;
    rows repeated with the same key and text go together. A source of size 0
    has target 0. An empty table gives no rows."""
    d = _decided(docs, key, text, source, weights, total_share, max_epochs, seed)
    new = ["size", "source_size", "target", "copies"]
    return d.select(*[c for c in docs.columns if c not in new], F.col("_size").alias("size"),
                    F.col("_csize").alias("source_size"), F.col("_ctarget").alias("target"),
                    F.col("_copies").alias("copies"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple = WEIGHTS, total_share: float = TOTAL_SHARE,
        max_epochs: float = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as ``mix_counts`` says,
    with the columns of ``docs`` unchanged. Nulls, empty texts, repeated rows
    and empty tables as there."""
    d = _decided(docs, key, text, source, weights, total_share, max_epochs, seed)
    return (d.where("_copies > 0")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
            .select(*docs.columns))
