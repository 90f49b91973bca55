"""Lasso training with cross-validation, best parameters, save/load and scoring.

Folds come from a hash of the row id (``foldCol``), so they are reproducible and
independent of partitioning. Candidate models fit on executors; the driver only
holds the fitted coefficients, the parameter grid and the average metrics.

With ``encoding="dictionary"`` the category values are numbered by ``operators.dictionary`` and the rows' sparse vectors are written once,
for all folds and candidates. StringIndexer, OneHotEncoder and VectorAssembler would hold every name on the driver, once per stage and fit, and name
every slot in the metadata of their columns. A value that a training fold lacks is a constant feature there, whose coefficient is 0. A pipeline
fitted on the fold would give such a name the slot of unseen names, which is that of NULL names too: ``FoldValidator`` does so.
"""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, CrossValidatorModelWriter, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentrisk.functions.hashing import hash32
from rentrisk.operators import dictionary as DICT
from rentrisk.operators import wide
from rentrisk.operators.features import CATEGORICAL, HASHED_WIDTH, checked, lasso, pipeline
from rentrisk.session import materialize

# Fixed values of the reference's validator.
REG_PARAMS = [1.0, 0.1]
NUM_FOLDS = 3
FOLD_SEED = 11
PARALLELISM = 2


def add_folds(df: DataFrame, seed: int = FOLD_SEED, num_folds: int = NUM_FOLDS, key: str = "id") -> DataFrame:
    return df.withColumn("fold", (hash32(seed, F.col(key)) % num_folds).cast("int"))


def cross_validator(reg_params=REG_PARAMS, num_folds: int = NUM_FOLDS, parallelism: int = PARALLELISM,
                    max_iter: int = 3, seed: int = FOLD_SEED, encoding: str = "index",
                    width: int = HASHED_WIDTH) -> CrossValidator:
    """The reference's validator; ``encoding='hash'`` swaps index + one-hot for feature hashing, ``'dictionary'`` for the slots of
    ``operators.dictionary`` (the same models, without the values on the driver)."""
    est = lasso(max_iter=max_iter)
    grid = ParamGridBuilder().addGrid(est.regParam, list(reg_params)).build()
    kind = FoldValidator if encoding == "dictionary" else CrossValidator
    return kind(estimator=pipeline(est, encoding, width), estimatorParamMaps=grid,
                evaluator=RegressionEvaluator(metricName="r2"), numFolds=num_folds,
                parallelism=parallelism, seed=seed, foldCol="fold")


def takes_vectors(estimator) -> bool:
    """Whether a pipeline has no feature stages: its rows come from ``encoded``."""
    return len(estimator.getStages()) == 1


def is_table(cvm: CrossValidatorModel) -> bool:
    """Whether the model is a table of coefficients, which scores the rows as they are."""
    return isinstance(cvm.bestModel.stages[-1], wide.LassoTable)


class FoldValidator(CrossValidator):
    """Validates rows by ``held`` instead of ``features`` where there is one."""

    def _kFold(self, dataset: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
        held = F.coalesce("held", "features")
        return [(train, rows.withColumn("features", held)) for train, rows in super()._kFold(dataset)]


def names_of_one_fold(rows: DataFrame) -> DataFrame:
    """As dictionary rows. Where their fold is held out, no other row has the name."""
    folds = rows.groupBy(F.col("name").cast("string").alias("value")).agg(F.min("fold").alias("a"), F.max("fold").alias("b"))
    return folds.where("value is not null and a = b").select(F.lit("name").alias("column"), "value", F.lit(0).alias("slot"))


def coded(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``rows`` with ``age_buckets`` and the dictionary's slots."""
    rows = materialize(checked(rows), "model-rows")
    # written per column: the next one reads the rows several times
    for c in CATEGORICAL:
        rows = materialize(DICT.encode(rows, dictionary, [c]), "model-coded")
    return rows


def encoded(rows: DataFrame, dictionary: DataFrame, lone: DataFrame | None = None) -> DataFrame:
    """``rows`` with ``features``: the dictionary's slots, one for names that it does not hold (NULL among them), age bucket and rent.

    Other values that it does not hold have no entry. With ``lone``, names of one fold, ``held`` is the vector with their name as unseen, NULL for other rows. As with the index stages, a NULL number and a negative house or zip are errors.
    """
    columns = rows.columns
    rows = coded(rows, dictionary)
    if lone is not None:
        rows = materialize(DICT.encode(rows, lone, ["name"], "_lone"), "model-coded")
    p = dictionary.count()
    entry = lambda i, v: F.struct(i.cast("int").alias("i"), v.cast("double").alias("v"))

    def vector(name):
        # slots ascend with the columns
        found = F.array(entry(name, F.lit(1.0)), *[entry(F.col(f"{c}_slot"), F.lit(1.0)) for c in CATEGORICAL[1:]],
                        entry(F.when(name.isNull(), F.lit(p)), F.lit(1.0)),
                        entry(F.lit(p + 1), F.col("age_buckets")), entry(F.lit(p + 2), F.col("rent_amount")))
        found = F.filter(found, lambda e: e["i"].isNotNull() & (e["v"] != 0))
        return F.struct(F.lit(0).cast("byte").alias("type"), F.lit(p + 3).alias("size"), found["i"].alias("indices"), found["v"].alias("values"))

    vectors = {"features": vector(F.col("name_slot"))}
    if lone is not None:
        vectors["held"] = F.when(F.col("name_lone").isNotNull(), vector(F.lit(None).cast("int")))
    out = materialize(rows.select(*columns, *[v.alias(c) for c, v in vectors.items()]), "model-vectors")
    # a vector is stored as this struct: read back as one
    schema = T.StructType([f if f.name not in vectors else T.StructField(f.name, VectorUDT()) for f in out.schema])
    return out.sparkSession.read.schema(schema).parquet(*out.inputFiles())


def fit(train: DataFrame, cv: CrossValidator | None = None, seed: int = FOLD_SEED) -> CrossValidatorModel:
    cv = cv or cross_validator(seed=seed)
    data = add_folds(train, seed, cv.getNumFolds())
    # every CV pass scans this frame: give each core a partition if it has fewer
    cores = train.sparkSession.sparkContext.defaultParallelism
    if takes_vectors(cv.getEstimator()):
        dictionary = materialize(DICT.build(train, CATEGORICAL), "model-dictionary")
        if wide.takes(cv, dictionary.count() + 3):
            cvm = wide.fit(cv, coded(data, dictionary), dictionary)
            cvm.dictionary = dictionary
            return cvm
        rows = encoded(data, dictionary, materialize(names_of_one_fold(data), "model-lone"))
        cvm = cv.fit(spread(rows.select("features", "held", "label", "fold"), cores))
        cvm.dictionary = dictionary
        return cvm
    data = spread(data, cores).persist()
    try:
        return cv.fit(data)
    finally:
        data.unpersist()


def spread(data: DataFrame, cores: int) -> DataFrame:
    return data.repartition(cores) if data.rdd.getNumPartitions() < cores else data


def candidates(spark: SparkSession, cvm: CrossValidatorModel) -> DataFrame:
    """One row per candidate: its regParam and mean validation metric."""
    rows = []
    for pm, metric in zip(cvm.getEstimatorParamMaps(), cvm.avgMetrics):
        reg = [v for p, v in pm.items() if p.name == "regParam"][0]
        rows.append((float(reg), float(metric)))
    schema = T.StructType([T.StructField("reg_param", T.DoubleType()), T.StructField("avg_metric", T.DoubleType())])
    return spark.createDataFrame(rows, schema)


def best_index(cvm: CrossValidatorModel) -> int:
    """Place of the best candidate, by the direction of the model's own evaluator."""
    sign = 1 if cvm.getEvaluator().isLargerBetter() else -1
    return max(range(len(cvm.avgMetrics)), key=lambda j: sign * cvm.avgMetrics[j])


def best_params(cands: DataFrame, larger_is_better: bool = True) -> DataFrame:
    """F2 / M4: argmax (or argmin) of the metric over candidates."""
    pick = F.max_by if larger_is_better else F.min_by
    best = F.max("avg_metric") if larger_is_better else F.min("avg_metric")
    return cands.agg(pick("reg_param", "avg_metric").alias("reg_param"), best.alias("avg_metric"))


def validation_report(spark: SparkSession, cvm: CrossValidatorModel, model_path: str) -> DataFrame:
    """M5: (model, result, best_params) -- the ``validation`` table row."""
    metrics = list(cvm.avgMetrics)
    best = {p.name: v for p, v in cvm.getEstimatorParamMaps()[best_index(cvm)].items()}
    maps = [{p.name: v for p, v in pm.items()} for pm in cvm.getEstimatorParamMaps()]
    # The labels of the report's four parts.
    result = (f"explainParams={cvm.explainParams()}\ngetEstimatorParamMaps={maps}\n"
              f"avgMetrics={', '.join(str(m) for m in metrics)}\nbestModel={cvm.bestModel.stages[-1]}")
    schema = "model string, result string, best_params string"
    return spark.createDataFrame([(model_path, result, str(best))], schema)


def save(cvm: CrossValidatorModel, path: str) -> str:
    # the writer that a model of tables needs is not chosen by itself, as the estimator is Spark's own
    writer = CrossValidatorModelWriter(cvm) if is_table(cvm) else cvm.write()
    writer.overwrite().save(path)
    if takes_vectors(cvm.getEstimator()):
        cvm.dictionary.write.parquet(f"{path}/dictionary")
    return path


def load(path: str) -> CrossValidatorModel:
    cvm = CrossValidatorModel.load(path)
    if takes_vectors(cvm.getEstimator()):
        cvm.dictionary = SparkSession.active().read.parquet(f"{path}/dictionary")
    return cvm


def score(cvm: CrossValidatorModel, rows: DataFrame) -> DataFrame:
    """M6: predictions for rows with the pipeline's input columns."""
    return cvm.transform(encoded(rows, cvm.dictionary) if takes_vectors(cvm.getEstimator()) and not is_table(cvm) else rows)
