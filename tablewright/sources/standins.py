"""Stand-in inputs derived from the driver's tables.

The reference reads a hospital-infection text file and a taxi-trip CSV that
are not available. Their shapes are rebuilt from the given parquet tables so
that every query's work grows with those tables:

- ``cases``: one row per lineitem, hospital/state/measure columns from the
  supplier, nation and part it points to; about a third of the rows carry
  the sentinel text ``Not Available`` (return flag ``N``).
- ``trips``: lineitem joined to part, a fare and four numeric features.
- ``values``: events, a skewed numeric column for fences and histograms.
- ``customer_lines`` / ``customer_csv``: the customer table written as
  tab-separated lines (with a header line) or CSV into the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.sources.files import load_table, write_csv, write_lines

SENTINEL = "Not Available"

CUSTOMER_FIELDS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
TRIP_FEATURES = ["l_quantity", "l_discount", "l_tax", "p_size"]


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hospital, state, measure_name, measure_id, comparison, score_text:
    all strings, as the cleaned infection table before its cast.

    The fact table is joined to one dimension at a time (supplier, nation,
    part), so each dimension is the build side: broadcast while small,
    sort-merge joined (AQE splitting a hot supplier or part) when large.
    Only the columns used are read from each table."""
    li = load_table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    su = load_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    na = load_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    pa = load_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    j = (li.join(su, li.l_suppkey == su.s_suppkey, "inner")
           .join(na, F.col("s_nationkey") == na.n_nationkey, "inner")
           .join(pa, li.l_partkey == pa.p_partkey, "inner"))
    flagged = F.col("l_returnflag") == "N"
    return j.select(
        F.col("s_name").alias("hospital"),
        F.col("n_name").alias("state"),
        F.col("p_type").alias("measure_name"),
        F.col("p_brand").alias("measure_id"),
        F.when(flagged, F.lit(SENTINEL)).otherwise(F.col("l_returnflag")).alias("comparison"),
        F.when(flagged, F.lit(SENTINEL))
         .otherwise(F.col("l_quantity").cast("int").cast("string")).alias("score_text"))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fare (l_extendedprice) and the features l_quantity, l_discount, l_tax,
    p_size, all double, plus the row's lineitem keys for hashing."""
    li = load_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_extendedprice", "l_quantity", "l_discount", "l_tax")
    pa = load_table(spark, sf_dir, "part").select("p_partkey", "p_size")
    j = li.join(pa, li.l_partkey == pa.p_partkey, "inner")
    return j.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_extendedprice").cast("double").alias("fare"),
        *[F.col(c).cast("double").alias(c) for c in TRIP_FEATURES])


def values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, event_type, value: a skewed numeric column."""
    return load_table(spark, sf_dir, "events").select("event_id", "event_type", "value")


def values_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``values``, with nulls put in: event_type ``error`` becomes null and
    value below 1 becomes null (the test tables hold no nulls)."""
    v = values(spark, sf_dir)
    return v.select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type"),
        F.when(F.col("value") >= 1, F.col("value")).alias("value"))


#: Places of the seven wanted fields in a case line of twelve.
CASE_FIELDS = {"hospital": 1, "city": 3, "state": 4, "measure_name": 8, "measure_id": 9,
               "comparison": 10, "score_text": 11}


def case_lines(spark: SparkSession, sf_dir: str) -> str:
    """Write the case table with a city (state and supplier number) as lines of
    twelve tab-separated fields, of which fields 1, 3, 4 and 8-11 are used,
    with a header line, into the shared folder; return the path."""
    li = load_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    su = load_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    na = load_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    pa = load_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    j = (li.join(su, li.l_suppkey == su.s_suppkey, "inner")
           .join(na, F.col("s_nationkey") == na.n_nationkey, "inner")
           .join(pa, li.l_partkey == pa.p_partkey, "inner"))
    flagged = F.col("l_returnflag") == "N"
    text = lambda c: F.col(c).cast("string")
    used = {"hospital": F.col("s_name"),
            "city": F.concat_ws("-", "n_name", (F.col("s_suppkey") % 7).cast("string")),
            "state": F.col("n_name"), "measure_name": F.col("p_type"), "measure_id": F.col("p_brand"),
            "comparison": F.when(flagged, F.lit(SENTINEL)).otherwise(F.col("l_returnflag")),
            "score_text": F.when(flagged, F.lit(SENTINEL)).otherwise(
                F.col("l_quantity").cast("int").cast("string"))}
    at = {i: used[c] for c, i in CASE_FIELDS.items()}
    other = [text("l_orderkey"), text("l_partkey"), text("l_suppkey"), F.lit("")]
    line = F.concat_ws("\t", *[at.get(i, other[i % len(other)]) for i in range(12)])
    names = {i: c for c, i in CASE_FIELDS.items()}
    header = spark.range(1).select(F.lit("\t".join(names.get(i, f"x{i}") for i in range(12))).alias("value"))
    return write_lines(header.unionByName(j.select(line.alias("value"))), "case-lines")


def customer_lines(spark: SparkSession, sf_dir: str) -> str:
    """Write the customer table as tab-separated lines with a header line
    into the shared folder; return the path (read back with S1)."""
    cu = load_table(spark, sf_dir, "customer").select(*CUSTOMER_FIELDS)
    header = spark.range(1).select(F.lit("\t".join(CUSTOMER_FIELDS)).alias("value"))
    body = cu.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in CUSTOMER_FIELDS])
                     .alias("value"))
    return write_lines(header.unionByName(body), "customer-lines")


def damaged_lines(spark: SparkSession, sf_dir: str, sep: str = ",") -> str:
    """Write the customer table as lines without a header, of which some have a
    field too few (keys that end in 3) or a balance that is no number (in 7);
    return the path."""
    cu = load_table(spark, sf_dir, "customer").select(*CUSTOMER_FIELDS)
    last = F.col("c_custkey") % 10
    cut = F.when(last != 3, F.col("c_mktsegment"))
    balance = F.when(last == 7, F.lit(SENTINEL)).otherwise(F.col("c_acctbal").cast("string"))
    line = F.concat_ws(sep, F.col("c_custkey").cast("string"), "c_name", F.col("c_nationkey").cast("string"), balance, cut)
    return write_lines(cu.select(line.alias("value")), "damaged-lines")


def customer_csv(spark: SparkSession, sf_dir: str) -> str:
    """Write the customer table as CSV with a header into the shared folder."""
    cu = load_table(spark, sf_dir, "customer").select(*CUSTOMER_FIELDS)
    return write_csv(cu, "customer-csv")
