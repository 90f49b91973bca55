"""The four jobs of the application: extract -> transform -> load over catalog tables.

Arguments mirror the reference's job parameters (source/sink tables, partition,
id cut, SMOTE k and bucket length, model path); all randomness is seeded.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentrisk.plans.clean import DEFAULT_AS_OF, DEFAULT_DOB, clean_payments, rejected_rows
from rentrisk.plans.sample import sample_train
from rentrisk.plans.train import test_flow, train_flow
from rentrisk.sources.tables import Table


def clean_job(raw: DataFrame, payment: Table, ds: str, *, as_of: _dt.date = DEFAULT_AS_OF,
              default_dob: str = DEFAULT_DOB, seed: int = 0, mode: str = "failfast",
              rejects: str | None = None) -> None:
    """``mode='permissive'`` leaves unparseable rows out of the table and writes them, with reasons, to ``rejects``."""
    if mode == "permissive":
        if not rejects:
            raise ValueError("permissive mode needs a path for the rejected rows")
        rejected_rows(raw, default_dob).withColumn("ds", F.lit(ds)).write.mode("append").parquet(rejects)
    payment.overwrite(clean_payments(raw, as_of=as_of, default_dob=default_dob, seed=seed, mode=mode), ds)


def sample_job(spark: SparkSession, payment: Table, train: Table, ds: str, test_set_first_id: int, *,
               k: int = 10, seed: int = 0, mode: str = "exact", bucket_length: float | None = None,
               num_tables: int = 2) -> None:
    lsh = dict(bucket_length=bucket_length, num_tables=num_tables) if mode == "lsh" else {}
    rows = sample_train(payment.scan(spark, ds), test_set_first_id, k=k, seed=seed, mode=mode, **lsh)
    train.overwrite(rows, ds)


def train_job(spark: SparkSession, train: Table, ds: str, model_prefix: str, report_path: str,
              suffix: str | None = None, **cv_kw):
    """``cv_kw`` go to ``model.cross_validator`` (e.g. ``encoding='hash'`` at large scale)."""
    return train_flow(spark, train.scan(spark, ds), model_prefix, report_path, suffix=suffix, **cv_kw)


def test_job(spark: SparkSession, payment: Table, ds: str, test_set_first_id: int, model_path: str,
             report_path: str) -> DataFrame:
    return test_flow(spark, payment.scan(spark, ds), test_set_first_id, model_path, report_path)
