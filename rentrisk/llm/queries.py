"""The registered queries: one per operator, over its whole table, with its production parameters.

Each gets its rows through the operator; the digest columns are derived from its output here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentrisk.llm import (ann, langid, minhash, mixing, negatives, packing, pii, quality, qualitymodel, records,
                          suffixes, urlfilter, whitening)
from rentrisk.llm.common import read
from rentrisk.llm.oracles import ORACLES
from rentrisk.session import scratch_path

__all__ = ["ORACLES", "QUERIES"]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = urlfilter.rules_frame(spark, urlfilter.RULES)
    return urlfilter.filter_urls(read(spark, sf_dir, "pages"), rules)


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    return ann.nearest(rows, rows.filter(F.col("vec_id") % 50 == 0))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read(spark, sf_dir, "documents"))
    return found.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in pii.BASE],
                        F.sha2(pii.digest(pii.BASE), 256).alias("base_sha256"), pii.digest(pii.KINDS).alias("spans"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~langid.in_fold("doc_id")))
    return langid.predict(docs, model)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.Mix(read(spark, sf_dir, "documents"))
    return mix.taken().withColumnRenamed("key", "doc_id")


def op7_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "records")
    records.write_records(read(spark, sf_dir, "documents"), path)
    rows = records.starts(spark, path)
    return rows.select(F.col("key").alias("doc_id"), "start", F.col("n_ids").alias("n_tokens"), "ids_crc32")


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), width=2, percent=80)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(read(spark, sf_dir, "documents")).drop("kept")


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qualitymodel.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = whitening.whiten(read(spark, sf_dir, "embeddings"), count=32, scale=64, shift=1_000_000)
    return done.withColumn("deviation", F.col("deviation").cast("long"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    rows = read(spark, sf_dir, "embeddings").withColumn("label", F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label))
    return negatives.mine(rows, vec_id % 100 == 0, positives=5, negatives=5, low=80, high=100, scale=256)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_url_filters, op2_ann, op3_pii, op4_language_id, op5_quality_rules, op6_mixing,
                            op7_token_records, op8_minhash, op9_packing, op10_suffix_dedup, op11_quality_classifier,
                            op12_whitening, op13_hard_negatives, pipeline)
}
