"""Ids, union, splits, multiplier, buckets, metrics, folds, save/load."""

import math

import pytest
from pyspark.sql import functions as F

from rentrisk.operators import split as S
from rentrisk.operators.features import age_buckets
from rentrisk.operators.ids import dense_random_id
from rentrisk.operators.metrics import regression_metrics
from rentrisk.operators.model import add_folds
from rentrisk.operators.setops import union_by_first


def test_dense_ids_are_permutation_and_partition_independent(spark):
    data = [(i % 13, f"v{i % 5}") for i in range(400)]   # many exact duplicates
    df = spark.createDataFrame(data, "a int, b string")
    a = dense_random_id(df.repartition(7), 5, chunk=4, num_buckets=8)
    b = dense_random_id(df.coalesce(1), 5, chunk=1000)
    ra = sorted((r.a, r.b, r.id) for r in a.collect())
    rb = sorted((r.a, r.b, r.id) for r in b.collect())
    assert sorted(r[2] for r in ra) == list(range(1, 401))
    assert ra == rb


def test_union_aligns_to_first(spark):
    left = spark.createDataFrame([(1, "x")], "id int, a string")
    right = spark.createDataFrame([("y", 2, True), ("x", 1, False)], "a string, id int, extra boolean")
    out = union_by_first(left, right, left)
    assert out.columns == ["id", "a"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "x"), (1, "x"), (1, "x"), (2, "y")]
    with pytest.raises(Exception):
        union_by_first(right, left).collect()


@pytest.mark.parametrize("maj,mino,expected", [(99, 1, 99), (3, 2, 2), (5, 0, None)])
def test_multiplier(spark, maj, mino, expected):
    rows = [(0,)] * maj + [(5,)] * mino
    df = spark.createDataFrame(rows, "default_amount int")
    assert S.size_multiplier(S.class_counts(df)).collect()[0]["multiplier"] == expected


def test_age_buckets(spark):
    df = spark.createDataFrame([(a,) for a in [-1, 0, 19, 20, 59, 60, 200]], "age int")
    got = [r.age_buckets for r in age_buckets().transform(df).collect()]
    assert got == [0.0, 1.0, 1.0, 2.0, 5.0, 6.0, 6.0]


def test_metrics_match_evaluator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    df = spark.createDataFrame([(float(i % 7), float((i * 3) % 11)) for i in range(100)], "label double, prediction double")
    m = regression_metrics(df).collect()[0]
    for name in ["r2", "mae", "mse", "rmse", "var"]:
        ev = RegressionEvaluator(metricName=name).evaluate(df)
        mine = m["explained_var"] if name == "var" else m[name]
        assert math.isclose(ev, mine, rel_tol=1e-9), name
    const = spark.createDataFrame([(1.0, 1.0)] * 3, "label double, prediction double")
    assert math.isnan(regression_metrics(const).collect()[0]["r2"])


def test_folds_disjoint_complete(spark):
    df = spark.range(1, 3001).withColumnRenamed("id", "id")
    f = add_folds(df).groupBy("fold").count().collect()
    assert sorted(r.fold for r in f) == [0, 1, 2]
    assert sum(r["count"] for r in f) == 3000
    assert min(r["count"] for r in f) > 900


def test_time_suffix_format(spark):
    from rentrisk.functions.dates import time_suffix
    r = spark.sql("select timestamp'2019-03-26 07:08:09' as ts").select(time_suffix("ts").alias("s")).first()
    assert r.s == "20190326_070809"


def test_model_save_load_same_predictions(spark):
    from rentrisk.operators import model as M
    rows = [(float((i * 37) % 200 if i % 9 == 0 else 0), f"n{i % 40}", 20 + i % 50, i % 12, 100 + i % 7,
             500 + (i * 13) % 900, i) for i in range(600)]
    df = spark.createDataFrame(rows, "label double, name string, age int, house_id int, house_zip int, "
                                     "rent_amount int, id long")
    cvm = M.fit(df)
    assert len(cvm.avgMetrics) == 2
    from rentrisk.session import scratch_path
    path = M.save(cvm, scratch_path(spark, "model"))
    a = M.score(cvm, df).select("id", "prediction").collect()
    b = M.score(M.load(path), df).select("id", "prediction").collect()
    assert sorted(tuple(r) for r in a) == sorted(tuple(r) for r in b)
    best = M.best_params(M.candidates(spark, cvm)).first()
    assert best.avg_metric == max(cvm.avgMetrics)


def test_hashed_encoding_cv(spark):
    from rentrisk.operators import model as M
    rows = [(float((i * 37) % 200 if i % 9 == 0 else 0), f"n{i % 40}", 20 + i % 50, i % 12, 100 + i % 7,
             500 + (i * 13) % 900, i) for i in range(600)]
    df = spark.createDataFrame(rows, "label double, name string, age int, house_id int, house_zip int, "
                                     "rent_amount int, id long")
    cvm = M.fit(df, M.cross_validator(encoding="hash", width=1 << 12))
    assert len(cvm.avgMetrics) == 2
    out = M.score(cvm, df)
    assert out.first().features.size == (1 << 12) + 2


def test_fan_out_in_chunks(spark):
    from rentrisk.operators.smote import fan_out
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id long, x string")
    out = fan_out(rows, "id", 10**6)
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 2 * 10**6 and len(sizes) > 1
    few = fan_out(rows, "id", 3, chunk=2)
    assert sorted((r.id, r["copy"]) for r in few.collect()) == [(i, c) for i in (1, 2) for c in (1, 2, 3)]


def test_permissive_clean_writes_rejects(spark):
    from rentrisk.plans import jobs
    from rentrisk.session import scratch_path
    from rentrisk.sources.fixtures import derived_raw
    from rentrisk.sources.tables import payment_table
    from tests.conftest import SF001
    raw = derived_raw(spark, SF001, with_key=False).limit(40)
    raw = raw.withColumn("payment_date", F.when(F.col("payment_date") == raw.first()["payment_date"], "bad").otherwise(
        F.col("payment_date"))).cache()
    bad = raw.where("payment_date = 'bad'").count()
    pay = payment_table(f"pay_{scratch_path(spark, 't').rsplit('-', 1)[1]}", scratch_path(spark, "pay")).create(spark)
    with pytest.raises(ValueError):
        jobs.clean_job(raw, pay, "20190101", mode="permissive")
    path = scratch_path(spark, "rejects")
    jobs.clean_job(raw, pay, "20190101", mode="permissive", rejects=path)
    got = spark.read.parquet(path)
    assert bad > 0 and got.count() == bad and pay.scan(spark, "20190101").count() == raw.count() - bad
    assert {r.reason for r in got.collect()} == {"payment_date"}
