"""A corpus pipeline of five stages over ``documents``; part of ``rentrisk.llm``.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it as Parquet into the cluster's
shared folder and gives it to the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentrisk.llm import minhash, mixing, packing, pii, quality
from rentrisk.llm.common import read
from rentrisk.session import apply_conf, ensure_checkpoint_dir, materialize


def _ready(spark: SparkSession) -> None:
    apply_conf(spark)
    ensure_checkpoint_dir(spark)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    _ready(spark)
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, 0.8) the smallest doc_id stays."""
    _ready(spark)
    return minhash.keep_one(docs, width=5, percent=80)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by marks of its kind; n_chars follows the text."""
    _ready(spark)
    return pii.mask(docs).withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
        F.length("text")).cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per copy that the mix takes; n_chars follows the text."""
    _ready(spark)
    return mixing.apply(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece's place in the training sequences."""
    _ready(spark)
    return packing.pack_documents(docs).withColumnRenamed("key", "doc_id")


STAGES = [("quality rules", quality_rules), ("near duplicates", near_dedup), ("personal data", mask_pii),
          ("mixing", mix_sources), ("packing", pack_sequences)]

#: Drawn and tokenised stages cannot be SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
