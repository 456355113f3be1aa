"""The corpus pipeline: toxic documents go, boilerplate lines go, one document
of every group of near copies stays, sources are mixed to target weights, and
the mix is encoded to piece ids.

Each stage is one call of an operator of ``tablewright.llm`` and works on all
that the stage before kept. All but the last return the columns of
``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import line_dedup, mixing, sentencepiece_fst, simhash, toxicity as tox
from tablewright.llm.common import table
from tablewright.session import scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go. Null and empty texts stay, as do
    all without a label to learn from; no rows give none."""
    return tox.toxic_filter(docs, table(spark, sf_dir, "labels"))


#: Pages of a source that a line must stand on to be taken out: in a small
#: source two pages are above 2 % already, and those may be near copies, of
#: which the next stage keeps one.
MIN_PAGES = 4


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on more than 2 % of a source's documents are taken out; the
    length follows the text. Documents of one source and text count as one,
    so that none of them loses its text for being copied. Null and empty texts
    stay; no rows give none."""
    d = line_dedup.line_dedup(docs, min_pages=MIN_PAGES, equal_once=True)
    return d.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of every component of fingerprints stays; of rows
    repeated with it one. All texts without a word are one component."""
    return simhash.simhash_dedup(docs, shingle=simhash.SHINGLE_WORDS, max_bits=simhash.MAX_BITS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it. Texts without a word have
    no size and are in by their hash; no rows give none."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and piece ids of every row of the mix; none for null and empty
    texts, no rows for no rows."""
    return sentencepiece_fst.encode(docs).select("doc_id", "ids", "n_pieces", "round_trip")


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", lines),
    ("simhash near-dedup", near_copies),
    ("mixing", mixture),
    ("sentencepiece", encode),
]

#: XXH64 fingerprints, the fitted grammar and piece ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are stored as Parquet
    in the shared folder and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
