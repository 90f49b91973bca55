"""Delimited text scan of the ``raw`` table (A1) and its text writer.

Hive's delimited text format: ``,`` between fields, no quoting, no header, ``\\N``
for NULL. The CSV reader with an explicit schema reads it in parallel splits; a
field that does not parse as its type becomes NULL (PERMISSIVE), a short row is
padded with NULLs and extra fields are dropped, as Hive does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("dob", T.StringType()),
    T.StructField("house_id", T.IntegerType()),
    T.StructField("house_zip", T.IntegerType()),
    T.StructField("payment_date", T.StringType()),
    T.StructField("payment_amount", T.IntegerType()),
    T.StructField("rent_amount", T.IntegerType()),
])

NULL_TOKEN = "\\N"


def read_delimited(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA, sep: str = ",") -> DataFrame:
    return (spark.read.schema(schema)
            .option("sep", sep)
            .option("quote", "")        # Hive text has no quoting
            .option("escape", "")
            .option("header", "false")
            .option("nullValue", NULL_TOKEN)
            .option("emptyValue", "")
            .option("mode", "PERMISSIVE")
            .csv(path))


def write_delimited(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """Write rows as Hive delimited text (the CSV writer would trim padding spaces)."""
    line = F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_TOKEN)) for c in df.columns])
    df.select(line.alias("value")).write.mode(mode).text(path)
