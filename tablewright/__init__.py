"""tablewright: table preparation, statistics and model fitting on Spark.

Every operator is a function from DataFrame to DataFrame built on Spark SQL
and ``pyspark.ml``. Sub-packages:

- ``sources``   line, CSV and parquet readers, SQL views, stand-in tables
- ``functions`` column-expression helpers (field access, safe casts, hashes)
- ``operators`` cleaning, statistics, joins, ranking, sampling, models, metrics
- ``plans``     the registered queries and their DuckDB oracles
"""

from tablewright.session import get_spark, shared_dir

__all__ = ["get_spark", "shared_dir"]
