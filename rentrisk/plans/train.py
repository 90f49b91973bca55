"""Flows 3 and 4: train (cross-validated lasso + validation report) and test (scoring + metrics).

The reference coalesces to one partition before fitting and scoring; here the
frames keep their partitioning and the training frame is persisted for the
CV passes only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentrisk.functions.dates import time_suffix
from rentrisk.operators import model as M
from rentrisk.operators import split as S
from rentrisk.operators.metrics import regression_metrics, report_row
from rentrisk.sources.tables import write_report


def utc_suffix(spark: SparkSession) -> str:
    """``yyyyMMdd_HHmmss`` of the current UTC time (computed once, by Spark)."""
    return spark.range(1).select(time_suffix().alias("s")).first()["s"]


def train_flow(spark: SparkSession, train_table: DataFrame, model_prefix: str, report_path: str | None = None,
               suffix: str | None = None, **cv_kw):
    """Fit the CV pipeline on the whole train table; save the model; append the validation row."""
    rows = S.model_rows(train_table)
    cvm = M.fit(rows, M.cross_validator(**{"encoding": "dictionary", **cv_kw}))
    path = f"{model_prefix}_{suffix or utc_suffix(spark)}"
    M.save(cvm, path)
    report = M.validation_report(spark, cvm, path)
    if report_path:
        write_report(report, report_path)
    return cvm, path, report


def test_flow(spark: SparkSession, payment: DataFrame, cut: int, model_path: str,
              report_path: str | None = None) -> DataFrame:
    """Score the rows from the id cut up with the saved model; one metrics row."""
    cvm = M.load(model_path)
    scored = M.score(cvm, S.test_rows(payment, cut))
    report = report_row(regression_metrics(scored.withColumn("label", F.col("label").cast("double"))), model_path)
    # one row, computed once: what is written is what is returned
    report = spark.createDataFrame(report.collect(), report.schema)
    if report_path:
        write_report(report, report_path)
    return report
