"""Typed payment rows from delimited raw files as they arrive (row-wise part of flow 1)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from rentrisk.plans.clean import DEFAULT_AS_OF, DEFAULT_DOB, _dates_ok, _typed, rejected_rows, trim_raw
from rentrisk.sources.delimited import NULL_TOKEN, RAW_SCHEMA


def typed_stream(spark: SparkSession, raw_dir: str, *, as_of: _dt.date = DEFAULT_AS_OF,
                 default_dob: str = DEFAULT_DOB, max_files_per_trigger: int = 100) -> DataFrame:
    """Streaming DataFrame of typed rows (no id). Rows with unparseable dates would stop the stream;
    they are left to :func:`rejected_stream`."""
    t = trim_raw(_raw_stream(spark, raw_dir, max_files_per_trigger)).where(_dates_ok(default_dob))
    return _typed(t, default_dob, as_of, False, [])


def rejected_stream(spark: SparkSession, raw_dir: str, *, default_dob: str = DEFAULT_DOB,
                    max_files_per_trigger: int = 100, **_) -> DataFrame:
    """Streaming DataFrame of the rows that :func:`typed_stream` leaves out, with the reason."""
    return rejected_rows(_raw_stream(spark, raw_dir, max_files_per_trigger), default_dob)


def _raw_stream(spark: SparkSession, raw_dir: str, max_files_per_trigger: int) -> DataFrame:
    return (spark.readStream.schema(RAW_SCHEMA).option("sep", ",").option("quote", "").option("escape", "")
           .option("nullValue", NULL_TOKEN).option("maxFilesPerTrigger", max_files_per_trigger).csv(raw_dir))


def start_rejects(spark: SparkSession, raw_dir: str, out_dir: str, checkpoint_dir: str, **kw):
    """Append the rejected rows as Parquet; a query of its own, with its own ``checkpoint_dir``."""
    return (rejected_stream(spark, raw_dir, **kw).writeStream.format("parquet")
            .option("path", out_dir).option("checkpointLocation", checkpoint_dir)
            .outputMode("append").start())


def start(spark: SparkSession, raw_dir: str, out_dir: str, checkpoint_dir: str, **kw):
    """Append typed rows as Parquet; progress is tracked in ``checkpoint_dir`` (shared storage)."""
    return (typed_stream(spark, raw_dir, **kw).writeStream.format("parquet")
            .option("path", out_dir).option("checkpointLocation", checkpoint_dir)
            .outputMode("append").start())
