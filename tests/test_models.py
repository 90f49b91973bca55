"""Lasso from fold statistics, coefficient tables, the category dictionary, SMOTE votes and folds by parent."""

from collections import Counter

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from rentrisk.operators import dictionary as DICT
from rentrisk.operators import features as FE
from rentrisk.operators import gram as G
from rentrisk.operators import model as M
from rentrisk.operators.knn import knn, row_neighbours
from rentrisk.operators.smote import SmoteSpec, synthetic_rows
from tests.test_knn import C, D, _rows


def _data(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)) * [1, 5, 0.2, 3] + [0, 10, -1, 2]
    x[:, 3] += 0.5 * x[:, 0]
    y = 3 * x[:, 0] - 0.5 * x[:, 1] + rng.normal(size=n)
    rows = [(i, *map(float, r), float(t), i % 3) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, label double, fold int")
    return df.withColumn("x", G.numeric_entries(["a", "b", "c", "d"])).repartition(5), x, y


def test_lasso_equals_the_iterative_estimator(spark):
    df, x, y = _data(spark)
    cv = G.cross_validate(df, [1.0, 0.1])
    dense = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df).persist()
    for reg, fold, model, r2 in cv.folds:
        lr = LinearRegression(elasticNetParam=1.0, regParam=reg, maxIter=2000, tol=1e-14).fit(dense.where(F.col("fold") != fold))
        assert np.abs(lr.coefficients.toArray() - model.coefficients).max() < 1e-5
        assert abs(lr.intercept - model.intercept) < 1e-4
        held = np.arange(len(y)) % 3 == fold
        p = x[held] @ model.coefficients + model.intercept
        assert abs(r2 - (1 - ((y[held] - p) ** 2).sum() / ((y[held] - y[held].mean()) ** 2).sum())) < 1e-9
    dense.unpersist()
    assert cv.best.reg_param == max(cv.averages(), key=lambda a: a[1])[0] == 0.1
    # optimality: the gradient is the penalty's where a coefficient is not 0, and within it where it is
    sd, residual = x.std(axis=0), y - x @ cv.best.coefficients - cv.best.intercept
    pull = (x - x.mean(axis=0)).T @ residual / len(y) / sd
    live = cv.best.coefficients != 0
    assert np.abs(pull[live] - 0.1 * np.sign(cv.best.coefficients[live])).max() < 1e-8 and (np.abs(pull[~live]) <= 0.1 + 1e-9).all()


def test_lasso_edges(spark):
    df, _, _ = _data(spark, 30)
    constant = df.withColumn("x", F.array(G.entry(0, F.col("a")), G.entry(1, F.lit(5.0))).cast(G.ENTRY))
    assert G.cross_validate(constant, [0.1]).best.coefficients[1] == 0
    nulls = df.unionByName(df.limit(3).withColumn("label", F.lit(None).cast("double")))
    assert np.allclose(G.cross_validate(nulls, [0.1]).best.coefficients, G.cross_validate(df, [0.1]).best.coefficients)
    with pytest.raises(ValueError, match="no labelled rows"):
        G.cross_validate(df.limit(0), [0.1])
    wide = df.withColumn("x", F.array(G.entry(F.lit(G.MAX_FEATURES), F.lit(1.0))).cast(G.ENTRY))
    with pytest.raises(ValueError, match="more than 1024 features"):
        G.cross_validate(wide, [0.1])


def test_one_pass_over_the_table(spark):
    """The plan of the sums reads the table once and adds up before the shuffle."""
    df, _, _ = _data(spark, 30)
    plan = G.pair_sums(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_sum") == 1 and plan.count("Exchange hashpartitioning(fold") == 1


def _tenants(spark, n, shift=0):
    rows = [(i, f"n{(i * i + shift) % 9}", 20 + i % 45, (i + shift) % 7, 100 + i % 4, 500 + 10 * (i % 13), float(i % 9 * 20)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, name string, age int, house_id int, house_zip int, rent_amount int, label double")


def test_coefficient_table_scores_as_the_pipeline(spark):
    train = _tenants(spark, 300)
    cvm = M.fit(train, M.cross_validator(reg_params=[0.1], num_folds=2))
    table = G.one_hot_table(cvm)
    assert {r.feature for r in table.collect()} <= {G.INTERCEPT, "age_buckets", "rent_amount", *FE.CATEGORICAL}
    # unseen names and houses, NULL is left to the pipeline's own rules
    test = _tenants(spark, 60, 3).withColumn("name", F.when(F.col("id") % 7 == 0, "nobody").otherwise(F.col("name"))).withColumn(
        "house_id", F.when(F.col("id") % 5 == 0, 999).otherwise(F.col("house_id")))
    want = {r.id: r.prediction for r in M.score(cvm, test).collect()}
    rows = FE.age_buckets().transform(test)
    got = {r.id: r.prediction for r in G.score(rows, table, ["age_buckets", "rent_amount"], FE.CATEGORICAL).collect()}
    assert got.keys() == want.keys() and max(abs(got[i] - want[i]) for i in want) < 1e-9
    none = rows.withColumn("name", F.lit(None).cast("string"))
    assert G.score(none, table, ["age_buckets", "rent_amount"], FE.CATEGORICAL).count() == 60


def test_dictionary(spark):
    # one value holds a third of the rows
    rows = [(i, "hot" if i % 3 == 0 else f"v{i % 40:02d}", i % 5 if i % 11 else None) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, name string, house int").repartition(7)
    got = DICT.build(df, ["name", "house"]).orderBy("slot").collect()
    assert [r.slot for r in got] == list(range(len(got)))
    for c in ("name", "house"):
        n = Counter(str(r[c]) for r in df.collect() if r[c] is not None)
        assert [(r.value, r.n) for r in got if r.column == c] == sorted(n.items(), key=lambda x: (-x[1], x[0]))
    d = DICT.build(df, ["name", "house"])
    slots = {(r.column, r.value): r.slot for r in got}
    coded = DICT.encode(df.union(spark.createDataFrame([(-1, "new", 77)], df.schema)), d, ["name", "house"])
    for r in coded.collect():
        assert (r.name_slot, r.house_slot) == (slots.get(("name", r["name"])), slots.get(("house", str(r.house))))
    assert coded.count() == 901
    entries = coded.select(F.size(DICT.one_hot_entries(["name", "house"])).alias("n"), "house", "id").collect()
    assert all(r.n == (0 if r.id == -1 else 1 + (r.house is not None)) for r in entries)


def test_lasso_on_dictionary_slots(spark):
    """The two together: a sparse model over observed values only, scored by its table."""
    train = _tenants(spark, 300)
    d = DICT.build(train, ["house_id", "house_zip"])
    names = [(r.column, r.value) for r in d.orderBy("slot").collect()] + [("rent_amount", None)]
    coded = M.add_folds(DICT.encode(train, d, ["house_id", "house_zip"]))
    x = F.concat(DICT.one_hot_entries(["house_id", "house_zip"]), F.array(G.entry(len(names) - 1, F.col("rent_amount"))).cast(G.ENTRY))
    cv = G.cross_validate(coded.withColumn("x", x), [1.0, 0.1], names=names)
    scored = G.score(train, G.coefficient_rows(spark, cv.best, names), ["rent_amount"], ["house_id", "house_zip"]).collect()
    place = {n: i for i, n in enumerate(names)}
    b = cv.best
    for r in scored:
        want = b.intercept + b.coefficients[place[("house_id", str(r.house_id))]] + b.coefficients[place[("house_zip", str(r.house_zip))]] \
            + b.coefficients[-1] * r.rent_amount
        assert abs(r.prediction - want) < 1e-9


def test_votes(spark):
    data = [(i, f"n{i % 3}", i % 2, None if i % 4 == 0 else 7, 20.0 + i, 500.0 + 3 * (i % 5), 50.0 * (i % 3)) for i in range(24)]
    data += [(100 + i, *data[0][1:]) for i in range(3)]
    df = _rows(spark, data)
    res = knn(df.select(*D, *C), D, C, 5)
    lists = {}
    for r in row_neighbours(df, "id", res, D, C).collect():
        lists.setdefault(r["id"], []).append(r)
    syn = synthetic_rows(df, SmoteSpec(D, C, 5, 3, 1, discrete_by="vote"), res).collect()
    assert len(syn) == 2 * len(data)
    for r in syn:
        for d in D:
            n = Counter(e[f"nb_{d}"] for e in lists[r.parent_id])
            assert r[d] == min(n, key=lambda v: (-n[v], v is not None, v))
    with pytest.raises(ValueError, match="discrete_by"):
        synthetic_rows(df, SmoteSpec(D, C, 5, 3, discrete_by="draw"))


def test_folds_by_parent_keep_relatives_together(spark):
    from rentrisk.plans.sample import TRAIN_COLUMNS, sample_train
    pay = _tenants(spark, 120).withColumn("default_amount", F.when(F.col("id") % 20 == 0, 50 + F.col("id")).otherwise(0).cast("int"))
    train = sample_train(pay, 100, k=3, seed=5, with_parent=True)
    assert train.columns == [*TRAIN_COLUMNS, "parent_id"]
    folds = M.add_folds(train, key="parent_id").persist()
    assert folds.where("is_syn").count() > 20
    assert folds.groupBy("parent_id").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    # drawn by the row's own id, relatives do come apart
    assert M.add_folds(train).groupBy("parent_id").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() > 0
    folds.unpersist()


def test_dictionary_encoding_gives_the_index_models(spark, monkeypatch, tmp_path):
    """Same metrics and predictions as index + one-hot, unseen and NULL names among them, and no column names its slots on the driver."""
    # some names are of one row, so that their fold's validation meets them unseen, and the slot of NULL names has a coefficient
    train = _tenants(spark, 300).withColumn("name", F.when(F.col("id") % 6 == 0, F.concat(F.lit("own"), "id")).when(F.col("id") % 9 != 0, F.col("name")))
    test = _tenants(spark, 60, 3).withColumn("name", F.when(F.col("id") % 7 == 0, "nobody").otherwise(F.col("name"))).withColumn(
        "house_id", F.when(F.col("id") % 5 == 0, 999).otherwise(F.col("house_id")))
    index = M.fit(train, M.cross_validator(num_folds=2))
    want = {r.id: r.prediction for r in M.score(index, test).collect()}
    fitted = []
    plain = M.spread
    monkeypatch.setattr(M, "spread", lambda df, n: fitted.append(plain(df, n)) or fitted[-1])
    cvm = M.fit(train, M.cross_validator(num_folds=2, encoding="dictionary"))
    assert np.abs(np.array(cvm.avgMetrics) - index.avgMetrics).max() < 1e-9
    assert not fitted[0].schema["features"].metadata and len(cvm.bestModel.stages) == 1
    held = M.load(M.save(cvm, str(tmp_path / "model")))
    got = {r.id: r.prediction for r in M.score(held, test).collect()}
    assert got.keys() == want.keys() and max(abs(got[i] - want[i]) for i in want) < 1e-9
    for c in ("house_id", "age"):
        with pytest.raises(Exception, match="null or negative"):
            M.score(cvm, test.withColumn(c, F.when(F.col("id") != 1, F.col(c)))).collect()


def test_train_flow_keeps_no_names_on_the_driver(spark, tmp_path):
    from pyspark.ml.feature import StringIndexerModel, VectorAssembler
    from rentrisk.plans.train import train_flow
    table = _tenants(spark, 200).withColumnRenamed("label", "default_amount")
    cvm, path, _ = train_flow(spark, table, str(tmp_path / "m"), num_folds=2)
    assert not [s for s in cvm.bestModel.stages if isinstance(s, (StringIndexerModel, VectorAssembler))]
    assert M.load(path).dictionary.where("column = 'name'").count() == table.select("name").distinct().count()


def test_payments_are_cleaned_once_for_the_train_table(spark, monkeypatch):
    from rentrisk.plans import registry as R
    from rentrisk.plans import sample
    from tests.conftest import SF001
    given, plain = [], sample.sample_train
    monkeypatch.setattr(sample, "sample_train", lambda pay, *a, **kw: given.append(pay) or plain(pay, *a, **kw))
    for name in ("smote_train_table", "fold_by_parent"):
        R.QUERIES[name](spark, SF001)
    assert len(given) == 2 and not any("Window" in p._jdf.queryExecution().optimizedPlan().toString() for p in given)


def test_rows_are_dealt_out_before_they_are_copied(spark):
    """A small shuffle is merged into one task; the copies are not all made there, whatever the ids."""
    from rentrisk.operators.smote import fan_out
    rows = spark.range(400).groupBy("id").count().withColumn("id", F.lit(None).cast("long"))
    out = fan_out(rows, "id", 50)
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 10_000
    assert out.groupBy("copy").count().where("count = 400").count() == 50


def _with_l_bfgs(**kw):
    cv = M.cross_validator(num_folds=2, encoding="dictionary", **kw)
    cv.getEstimator().getStages()[-1].setSolver("l-bfgs")
    return cv


def _many_names(spark, n):
    """Names of one row, names of many, NULL names; the label depends on all columns."""
    rows = [(i, None if i % 37 == 0 else f"own{i}" if i % 6 == 0 else f"n{i * i % 101}", 20 + i % 45, i * 7 % 11, 100 + i % 4, 500 + 10 * (i % 13),
             float(i % 9 * 20 + 60 * (i * i % 101 % 5) + i * 7919 % 61)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, name string, age int, house_id int, house_zip int, rent_amount int, label double")


@pytest.mark.parametrize("share", [1000, 20])
def test_wide_lasso_takes_the_estimators_steps(spark, monkeypatch, tmp_path, share):
    """Metrics and predictions of Spark's OWL-QN, with values that are broadcast and values that are joined; no vector over all slots."""
    from rentrisk.operators import wide
    train = _many_names(spark, 900)
    monkeypatch.setattr(wide, "takes", lambda *a: False)
    want = M.fit(train, _with_l_bfgs(reg_params=[500.0, 20.0, 0.1], max_iter=4))
    monkeypatch.undo()
    monkeypatch.setattr(wide.fit, "__defaults__", (share,))
    cvm = M.fit(train, _with_l_bfgs(reg_params=[500.0, 20.0, 0.1], max_iter=4))
    assert np.abs(np.array(cvm.avgMetrics) - want.avgMetrics).max() < 1e-9 and want.avgMetrics[0] < 0.1 < want.avgMetrics[2]
    assert np.abs(np.array(cvm.stdMetrics) - want.stdMetrics).max() < 1e-9
    assert M.best_index(cvm) == M.best_index(want)
    model = cvm.bestModel.stages[-1]
    assert isinstance(model, wide.LassoTable)
    assert str(model).endswith(str(want.bestModel.stages[-1]).partition("numFeatures")[2])
    test = train.withColumn("name", F.when(F.col("id") % 7 == 0, "nobody").otherwise(F.col("name"))).withColumn(
        "house_id", F.when(F.col("id") % 5 == 0, 999).otherwise(F.col("house_id")))
    held = M.load(M.save(cvm, str(tmp_path / "model")))
    assert held.avgMetrics == cvm.avgMetrics and [*held.getEstimatorParamMaps()[2].values()] == [0.1]
    old, new = ({r.id: r.prediction for r in M.score(m, test).collect()} for m in (want, held))
    assert old.keys() == new.keys() and max(abs(old[i] - new[i]) for i in old) < 1e-7
    report = M.validation_report(spark, held, "p").first()
    assert report.best_params == M.validation_report(spark, want, "p").first().best_params and "numFeatures" in report.result
    with pytest.raises(Exception, match="null or negative"):
        M.score(held, test.withColumn("age", F.when(F.col("id") != 1, F.col("age")))).collect()


def test_wide_lasso_edges(spark):
    from rentrisk.operators import wide
    rows = _many_names(spark, 60)
    constant = M.fit(rows.withColumn("label", F.lit(5.0)), _with_l_bfgs())
    assert {r.prediction for r in M.score(constant, rows).collect()} == {5.0}
    with pytest.raises(Exception, match="Labels MUST NOT be Null"):
        M.fit(rows.withColumn("label", F.when(F.col("id") != 3, F.col("label"))), _with_l_bfgs())
    with pytest.raises(ValueError, match="at fold"):
        M.fit(rows.limit(1), _with_l_bfgs())
    # as the estimator: the normal equations up to 4,096 slots; settings that are not kept to are left to it
    cv = M.cross_validator(encoding="dictionary")
    assert wide.takes(cv, 4097) and not wide.takes(cv, 4096)
    assert not wide.takes(M.cross_validator(encoding="dictionary", reg_params=[0.0]), 4097)


def test_a_failed_step_forgets_the_memory_once():
    from rentrisk.operators.wide import Fit, Moments
    f = Fit(1.0, 0, Moments(3, 0.0, 2.0), rounds=[1, 0])
    with pytest.raises(ArithmeticError):
        f.direction(lambda u, v: -1.0)
    f.fail()
    assert not f.done and f.rounds == [] and f.direction(None) == {("a", 0): -1.0}
    f.fail()
    assert f.done
