"""File sources and sinks, SQL views.

Written files always go to a new path under the shared folder named by
``spark.checkpoint.dir`` (see ``session.shared_dir``), never to a
machine-local temporary folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.session import drop_scratch, scratch_path, shared_dir


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables. Column pruning and filters reach
    the scan through Catalyst."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, one string column ``value``."""
    return spark.read.text(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True, sep: str = ",") -> DataFrame:
    """CSV with a header line. Without ``schema`` every column is a
    string (no ``inferSchema``: it would scan the data twice)."""
    reader = spark.read.option("header", header).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_csv_doubles(spark: SparkSession, path: str, columns: list[str],
                     header: bool = True, sep: str = ",") -> DataFrame:
    """S3: CSV read as an all-double table; text that is not a number
    becomes null (PERMISSIVE mode), as a one-type numeric matrix would."""
    schema = T.StructType([T.StructField(c, T.DoubleType(), True) for c in columns])
    return (spark.read.option("header", header).option("sep", sep)
            .option("mode", "PERMISSIVE").schema(schema).csv(path))


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
                     sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """S2, S3 with nothing lost unseen: the rows that fit ``schema``, and the
    other lines as ``line`` and ``reason``: ``fields`` (too few or too many) or
    the first column whose text is not of its type. An empty field is null and
    no fault; an empty line is no line. The file is read once; both frames come
    from the parsed rows stored as parquet."""
    types = {f.name: f.dataType.simpleString() for f in schema.fields}
    read = (spark.read.option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_line")
            .schema(T.StructType([*schema.fields, T.StructField("_line", T.StringType())])).csv(path))
    kept = write_table(read, "csv-checked")
    names = [f"`{c}` string" for c in types]
    parts = F.from_csv("line", ", ".join([*names, "_faulty string"]),
                       {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_faulty"})
    reason = F.when(F.col("_parts._faulty").isNotNull(), F.lit("fields"))
    for c, kind in types.items():
        text = F.col("_parts").getField(c)
        reason = reason.when(text.isNotNull() & text.try_cast(kind).isNull(), F.lit(f"{c}: not {kind}"))
    bad = kept.where("_line is not null").select(F.col("_line").alias("line")).withColumn("_parts", parts)
    return (kept.where("_line is null").drop("_line"),
            bad.select("line", reason.otherwise(F.lit("unreadable")).alias("reason")))


def write_lines(df: DataFrame, name: str = "lines") -> str:
    """Write a one-string-column frame as text; return the new path."""
    path = scratch_path(df.sparkSession, name)
    df.write.text(path)
    return path


def write_csv(df: DataFrame, name: str = "csv", header: bool = True) -> str:
    """Write a frame as CSV with a header; return the new path."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("header", header).csv(path)
    return path


def write_table(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a derived table (the cleaned case table, a feature frame) as
    parquet into the shared folder and return it read back. Many later
    actions then scan the written columns (pruned, filters pushed) instead
    of recomputing the joins and cleaning each time, and the lineage is
    cut on shared storage, so a lost executor does not reach back to the
    raw inputs."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def stored(df: DataFrame) -> DataFrame:
    """``df`` stored once by a reliable checkpoint in the shared folder: a query
    that reads it several times does not compute it several times, and a lost
    executor does not reach back to the raw inputs."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def settle(df: DataFrame, path: str) -> DataFrame:
    """``df``, read from the scratch files at ``path``, stored by a reliable
    checkpoint; the files are then deleted. Spark removes a checkpoint itself
    when nothing refers to it
    (``spark.cleaner.referenceTracking.cleanCheckpoints``)."""
    out = stored(df)
    drop_scratch(df.sparkSession, path)
    return out


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Name a plan for SQL (``registerTempTable`` is the old name)."""
    df.createOrReplaceTempView(name)
    return df


def run_sql(spark: SparkSession, text: str) -> DataFrame:
    """Run a SQL string; Catalyst plans it like the DataFrame form."""
    return spark.sql(text)
