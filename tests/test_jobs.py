"""The four jobs end to end through catalog tables (sf0.001)."""

import pytest
from pyspark.sql import functions as F

from rentrisk.plans import jobs
from rentrisk.plans import registry as Q
from rentrisk.session import scratch_path
from rentrisk.sources.fixtures import derived_raw
from rentrisk.sources.tables import payment_table, train_table
from tests.conftest import SF001


@pytest.mark.parametrize("mode", ["exact", "lsh"])
def test_jobs_end_to_end(spark, mode):
    uid = scratch_path(spark, "t").rsplit("-", 1)[1]
    pay = payment_table(f"payment_{uid}", scratch_path(spark, "payment")).create(spark)
    tr = train_table(f"train_{uid}", scratch_path(spark, "train")).create(spark)
    jobs.clean_job(derived_raw(spark, SF001, with_key=False), pay, Q.DS, seed=Q.SEED)
    p = pay.scan(spark, Q.DS)
    n = p.count()
    assert sorted(r.id for r in p.select("id").collect()) == list(range(1, n + 1))
    cut = Q.train_cut(n)
    jobs.sample_job(spark, pay, tr, Q.DS, cut, k=5, seed=Q.SEED, mode=mode)
    t = tr.scan(spark, Q.DS)
    orig = t.where(~F.col("is_syn")).count()
    syn = t.where(F.col("is_syn")).count()
    train = p.where(F.col("id") < cut)
    mino = train.where(F.col("default_amount") != 0).count()
    maj = train.count() - mino
    m = max(maj // mino, 2)
    assert orig == cut - 1 and syn == (m - 1) * mino
    assert sorted(r.id for r in t.select("id").collect()) == list(range(1, orig + syn + 1))
    cvm, path, report = jobs.train_job(spark, tr, Q.DS, scratch_path(spark, "model/m"),
                                       scratch_path(spark, "validation"), suffix="20190326_000000")
    assert path.endswith("_20190326_000000") and report.count() == 1
    out = jobs.test_job(spark, pay, Q.DS, cut, path, scratch_path(spark, "test")).collect()[0]
    assert out.model == path and out.rmse >= 0 and out.r2 <= 1
