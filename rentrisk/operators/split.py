"""Train/test split by id cut, class split, class counts, size multiplier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_COLUMNS = ["id", "name", "age", "house_id", "house_zip", "rent_amount", "default_amount"]
MODEL_COLUMNS = ["label", "name", "age", "house_id", "house_zip", "rent_amount", "id"]


def train_rows(payment: DataFrame, cut: int, ordered: bool = False) -> DataFrame:
    """C3 (train side) + C2: ``id < cut`` (pushed to the Parquet scan), with ``is_syn = false``."""
    df = payment.where(F.col("id") < F.lit(cut)).select(*SAMPLE_COLUMNS, F.lit(False).alias("is_syn"))
    return df.orderBy("id") if ordered else df


def test_rows(payment: DataFrame, cut: int, ordered: bool = False) -> DataFrame:
    """C3 (test side) + C1: ``id >= cut``, ``default_amount`` renamed to ``label``."""
    df = payment.where(F.col("id") >= F.lit(cut)).select(
        F.col("default_amount").alias("label"), *[c for c in MODEL_COLUMNS if c != "label"])
    return df.orderBy("id") if ordered else df


def model_rows(train: DataFrame) -> DataFrame:
    """C1 on the train table: the columns the pipeline reads."""
    return train.select(F.col("default_amount").alias("label"), *[c for c in MODEL_COLUMNS if c != "label"])


def is_minority(col: str = "default_amount") -> Column:
    return F.col(col) != 0


def majority(df: DataFrame) -> DataFrame:
    return df.where(F.col("default_amount") == 0)


def minority(df: DataFrame) -> DataFrame:
    return df.where(is_minority())


def class_counts(df: DataFrame) -> DataFrame:
    """H1: both class sizes in one pass (one row)."""
    return df.agg(F.count_if(F.col("default_amount") == 0).alias("majority"),
                  F.count_if(F.col("default_amount") != 0).alias("minority"))


def size_multiplier(counts: DataFrame) -> DataFrame:
    """H2: ``max(majority div minority, 2)``; NULL when there is no minority row."""
    m = F.when(F.col("minority") > 0, F.greatest(
        F.expr("cast(majority div minority as int)"), F.lit(2)))
    return counts.select("majority", "minority", m.alias("multiplier"))
