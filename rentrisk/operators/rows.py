"""Row-shape helpers: field replacement, casts, report frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def replace_field(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Replace one existing field's value, keeping column order."""
    if name not in df.columns:
        raise ValueError(f"no field {name!r} in {df.columns}")
    return df.select(*[value.alias(c) if c == name else F.col(c) for c in df.columns])


def widen(df: DataFrame, long_cols: list[str], double_cols: list[str]) -> DataFrame:
    """C5, first half: widen discrete ints to bigint and continuous ints to double."""
    return df.select(*[F.col(c).cast("bigint").alias(c) if c in long_cols
                       else F.col(c).cast("double").alias(c) if c in double_cols
                       else F.col(c) for c in df.columns])


def truncate_to_int(c) -> Column:
    """C5, second half: double -> int truncating toward zero (3.99 -> 3, -3.99 -> -3)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("int")


def flag(value: bool, name: str = "is_syn") -> Column:
    """Constant boolean column."""
    return F.lit(bool(value)).alias(name)


def to_df(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    """A4: rows + schema -> DataFrame (for small, fixed inputs such as reports)."""
    return spark.createDataFrame(rows, schema)
