"""Line deduplication by site-relative frequency. DataFrame functions only.

For every host and line: pages of the host that contain the line, divided by
the pages of the host. Lines above ``ratio`` are boilerplate of that host and
are dropped from its pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import broadcast_if_small, cut, text_or_empty

#: A line on more than this share of its host's pages is boilerplate.
RATIO = 0.02
#: A line on one page of its host is no boilerplate, however few pages it has.
MIN_PAGES = 2


def _lines(text: str) -> Column:
    return F.split(text_or_empty(text), "\n", -1)


def _key(line: Column) -> Column:
    """16 bytes that stand for a line, blanks around it aside."""
    return F.unhex(F.md5(F.trim(line)))


def boilerplate(docs: DataFrame, host: str, text: str, ratio: float, min_pages: int,
                equal_once: bool = False) -> DataFrame:
    """(_host, _lines): the boilerplate lines' keys of each host that has any.
    ``equal_once``: pages of a host with the same text are one page, in both
    counts, by digests of their texts.

    Every page counts a line once (distinct within the row, before any
    shuffle); counts are combined before the shuffle, so neither a host with a
    third of all pages nor a line on all of them meets in one task. A host has
    at most (its mean lines per page) / ``ratio`` such lines, which bounds the
    array."""
    d = docs.select(F.col(host).alias("_host"), text,
                    F.array_distinct(F.transform(F.filter(_lines(text), lambda x: F.trim(x) != ""), _key)).alias("_keys"))
    pages = d.select("_host")
    lines = d.select("_host", F.explode("_keys").alias("_line"))
    if equal_once:
        d = d.withColumn("_page", F.unhex(F.md5(text_or_empty(text))))
        pages = d.select("_host", "_page").distinct()
        lines = d.select("_host", "_page", F.explode("_keys").alias("_line")).distinct()
    per_line = (lines
                .groupBy("_host", "_line").agg(F.count(F.lit(1)).alias("_pages"))
                .where(F.col("_pages") >= min_pages))
    per_host = pages.groupBy("_host").agg(F.count(F.lit(1)).alias("_total"))
    frequent = (per_line.join(per_host, per_line["_host"].eqNullSafe(per_host["_host"]))
                .where(F.col("_pages") > F.lit(ratio) * F.col("_total"))
                .select(per_line["_host"].alias("_host"), "_line"))
    return frequent.groupBy("_host").agg(F.collect_set("_line").alias("_lines"))


def line_dedup(docs: DataFrame, host: str = "source", text: str = "text",
               ratio: float = RATIO, min_pages: int = MIN_PAGES, equal_once: bool = False) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and the columns
    ``n_lines`` and ``n_dropped`` (new ones: a column of ``docs`` with such a
    name is replaced). Every row stays, one with nothing but boilerplate as an
    empty text.

    Lines end at ``\\n``. Blank lines are never boilerplate. A null text has
    no lines and stays null; pages without a host (null) count as one host.
    Repeated rows are pages like any other, but with ``equal_once``: then a
    host's pages of the same text count as one, so that a page that is copied
    widely keeps its lines. ``min_pages``: pages that a line must stand on
    besides. An empty table gives no rows."""
    found = cut(boilerplate(docs, host, text, ratio, min_pages, equal_once))
    found = broadcast_if_small(found, F.size("_lines") * 24 + F.coalesce(F.octet_length(F.col("_host").cast("string")), F.lit(0)) + 32)
    found = found.withColumnsRenamed({"_host": "_ld_host", "_lines": "_ld_lines"})
    lines = _lines(text)
    kept = F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains("_ld_lines", _key(x)))
    d = docs.join(found, docs[host].eqNullSafe(found["_ld_host"]), "left")
    touched = F.col(text).isNotNull() & F.col("_ld_lines").isNotNull()
    n = F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long")
    left = F.when(touched, kept)
    out = d.withColumns({"n_lines": n, "_ld_kept": left})
    out = out.withColumns({
        "n_dropped": F.when(F.col("_ld_kept").isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.size("_ld_kept")).cast("long"),
        text: F.when(F.col("_ld_kept").isNull(), F.col(text)).otherwise(F.array_join("_ld_kept", "\n"))})
    new = ["n_lines", "n_dropped"]
    return out.select(*[c for c in docs.columns if c not in new], *new)
