"""Regression metrics as one DataFrame aggregate (H3).

Same definitions as Spark's ``RegressionEvaluator`` / mllib ``RegressionMetrics``:
r2 = 1 - SSE / (n * var_pop(y)); explained variance = mean((p - mean(y))^2)
= var_pop(p) + (mean(p) - mean(y))^2; mae; mse; rmse. No driver round trip and
no single-partition coalesce: partial aggregates combine map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRIC_COLUMNS = ["r2", "explained_var", "mae", "mse", "rmse"]


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    y = F.col(label).cast("double")
    p = F.col(prediction).cast("double")
    s = df.agg(F.count(F.lit(1)).alias("_n"), F.sum((y - p) * (y - p)).alias("_sse"),
               F.sum(F.abs(y - p)).alias("_sae"), F.var_pop(y).alias("_vy"), F.var_pop(p).alias("_vp"),
               F.avg(y).alias("_my"), F.avg(p).alias("_mp"))
    n = F.col("_n").cast("double")
    sst = n * F.col("_vy")
    # 0/0 (constant label predicted exactly) is NaN, as in Spark's evaluator
    r2 = F.when(sst != 0, 1 - F.col("_sse") / sst).when(F.col("_sse") == 0, F.lit(float("nan"))) \
        .otherwise(F.lit(float("-inf")))
    mse = F.col("_sse") / n
    return s.select(
        r2.alias("r2"),
        (F.col("_vp") + (F.col("_mp") - F.col("_my")) * (F.col("_mp") - F.col("_my"))).alias("explained_var"),
        (F.col("_sae") / n).alias("mae"), mse.alias("mse"), F.sqrt(mse).alias("rmse"))


def report_row(metrics: DataFrame, model: str) -> DataFrame:
    """A5 + M7: the one-row ``test`` report (model, r2, explained_var, mae, mse, rmse)."""
    return metrics.select(F.lit(model).alias("model"), *METRIC_COLUMNS)
