"""Total order that can be checked (F1).

A global sort is a range partitioning and a sort inside each partition; written, partition i becomes the i-th file. So a row's place in
the order is (file, place in the file), which the file source gives back as metadata: nothing has to be numbered before the write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_ordered(df: DataFrame, path: str, *keys) -> None:
    """Write ``df`` in the order of ``keys`` over all files."""
    df.orderBy(*keys).write.mode("overwrite").parquet(path)


def read_positions(spark: SparkSession, path: str, name: str = "position") -> DataFrame:
    """The rows below ``path`` with their place in the whole, from 1."""
    rows = spark.read.parquet(path)
    rows = rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    # one row per file
    offsets = sizes.select(F.col("_file").alias("_of"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_off"))
    joined = rows.join(F.broadcast(offsets), F.col("_file") == F.col("_of"))
    return joined.withColumn(name, F.col("_off") + F.col("_row") + 1).drop("_file", "_row", "_of", "_off")
