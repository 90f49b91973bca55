"""Saved model versions and their reports.

Every fit is saved below ``prefix_yyyyMMdd_HHmmss`` (UTC) and reports one row per candidate: which model, which parameter, its mean validation metric
and whether it was chosen. A version is found again by its time or by its report.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentrisk.operators import gram as G

SUFFIX = re.compile(r"_(\d{8}_\d{6})$")
REPORT = "model string, reg_param double, avg_metric double, chosen boolean"


def save(spark: SparkSession, cv: G.CrossValidated, prefix: str, suffix: str) -> str:
    """Write the best model's coefficients; returns its path."""
    if not SUFFIX.search(f"_{suffix}"):
        raise ValueError("suffix must look like yyyyMMdd_HHmmss")
    path = f"{prefix}_{suffix}"
    G.coefficient_rows(spark, cv.best, cv.names).write.mode("errorifexists").parquet(path)
    return path


def report(spark: SparkSession, cv: G.CrossValidated, path: str) -> DataFrame:
    """One row per candidate."""
    rows = [(path, reg, metric, reg == cv.best.reg_param) for reg, metric in cv.averages()]
    return spark.createDataFrame(rows, REPORT)


def versions(spark: SparkSession, prefix: str) -> list[str]:
    """Paths of the saved versions, oldest first."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{prefix}_*")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern) or []
    # a status gives the full path; the caller's spelling of the prefix is kept
    names = sorted({SUFFIX.search(s.getPath().getName()).group(1) for s in found if SUFFIX.search(s.getPath().getName())})
    return [f"{prefix}_{n}" for n in names]


def newest(spark: SparkSession, prefix: str) -> str:
    found = versions(spark, prefix)
    if not found:
        raise FileNotFoundError(f"no model below {prefix}")
    return found[-1]


def best(reports: DataFrame) -> DataFrame:
    """The chosen candidate of the greatest metric over all reports, of equals the newest: one row."""
    chosen = reports.where(F.col("chosen") & F.col("avg_metric").isNotNull() & ~F.isnan("avg_metric"))
    key = F.struct("avg_metric", F.regexp_extract("model", r"_(\d{8}_\d{6})$", 1), "model")
    return chosen.agg(F.max_by(F.struct("model", "reg_param", "avg_metric"), key).alias("b")).select("b.*")


def load(spark: SparkSession, path: str) -> DataFrame:
    """``feature, value, coefficient`` of a saved version."""
    return spark.read.parquet(path)
