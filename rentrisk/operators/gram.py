"""Lasso and cross-validation from fold statistics (M1-M4, F2).

A row is a sparse vector of (slot, value), extended by a slot for the constant and one for the label. One aggregate over the table sums
the products of every pair of a row's entries, per fold: the Gram matrix, X'y, y'y, the sums and the counts. All that a lasso and its
validation need follows from these sums, so candidates and folds cost no further pass:

* training sums of a fold are the total less the fold's own;
* coefficients minimise 1/(2n) SSE + reg * sum_j sd_j |b_j| (features scaled by their population standard deviation, as the
  reference's estimator does), by coordinate descent to convergence on the covariance matrix;
* SSE and the total sum of squares of the held-out fold are quadratic forms of its sums, which gives r2.

A row with m entries gives m (m + 1) / 2 products, summed before the shuffle. The driver receives folds x (different pairs) numbers and raises
an error beyond ``MAX_FEATURES`` slots; for wider models there is the iterative path in ``operators.model``. Sums of integer valued
features are exact up to 2^53. Rows with a NULL label or fold are left out; entries of value 0 or NULL need not be listed.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rentrisk.operators.skew import join_split_hot
from rentrisk.session import materialize

MAX_FEATURES = 1024
ENTRY = "array<struct<slot:int,value:double>>"
#: Slots of the constant and of the label in the extended vector.
ONE, LABEL = -1, -2
INTERCEPT = "(intercept)"


def entry(slot: Column | int, value: Column) -> Column:
    slot = slot if isinstance(slot, Column) else F.lit(slot)
    return F.struct(slot.cast("int").alias("slot"), value.cast("double").alias("value"))


def numeric_entries(columns: list[str]) -> Column:
    """Slots 0.. for numeric columns; NULL counts as 0."""
    return F.array(*[entry(i, F.coalesce(F.col(c), F.lit(0))) for i, c in enumerate(columns)]).cast(ENTRY)


def pair_sums(rows: DataFrame, x: str = "x", label: str = "label", fold: str = "fold") -> DataFrame:
    """``fold, i, j, v``: per fold the sum over rows of the products of entries i <= j of the extended vectors."""
    extra = F.array(entry(ONE, F.lit(1.0)), entry(LABEL, F.col(label)))
    ok = F.col(label).isNotNull() & F.col(fold).isNotNull()
    full = rows.where(ok).select(F.col(fold).alias("fold"), F.filter(
        F.concat(F.col(x), extra.cast(ENTRY)), lambda e: e["value"] != 0).alias("e"))
    pairs = F.flatten(F.transform("e", lambda a: F.transform(F.filter("e", lambda b: b["slot"] >= a["slot"]), lambda b: F.struct(
        a["slot"].alias("i"), b["slot"].alias("j"), (a["value"] * b["value"]).alias("v")))))
    return full.select("fold", F.explode(pairs).alias("p")).groupBy("fold", "p.i", "p.j").agg(F.sum("p.v").alias("v"))


@dataclass
class Sums:
    """Gram matrix of the extended vectors: slots 0..p-1, then the constant, then the label."""
    g: np.ndarray

    @property
    def n(self) -> float:
        return float(self.g[-2, -2])

    def __sub__(self, other: Sums) -> Sums:
        return Sums(self.g - other.g)

    def moments(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, float]:
        """Means, covariances and covariances with the label (divisor n) of the features; mean of the label."""
        mean = self.g[:, -2] / self.n
        cov = self.g / self.n - np.outer(mean, mean)
        return mean[:-2], cov[:-2, :-2], cov[:-2, -1], np.sqrt(np.maximum(np.diag(cov)[:-2], 0)), float(mean[-1])

    def r2(self, model: Lasso) -> float:
        """Of predictions on these rows, from the sums; NaN where the label is constant and met exactly."""
        w = np.concatenate([-model.coefficients, [-model.intercept, 1.0]])
        sse = max(float(w @ self.g @ w), 0.0)
        sst = float(self.g[-1, -1] - self.g[-1, -2] ** 2 / self.n)
        return 1 - sse / sst if sst > 0 else (float("nan") if sse == 0 else float("-inf"))


@dataclass
class Lasso:
    reg_param: float
    coefficients: np.ndarray
    intercept: float


def collect_sums(pairs: DataFrame) -> dict[int, Sums]:
    """Sums by fold, on the driver."""
    slots = [r[0] for r in pairs.select("j").union(pairs.select("i")).distinct().limit(MAX_FEATURES + 3).collect()]
    p = max([s for s in slots if s >= 0], default=-1) + 1
    if p > MAX_FEATURES:
        raise ValueError(f"more than {MAX_FEATURES} features: use operators.model")
    place = lambda s: s if s >= 0 else p + (s == LABEL)
    out: dict[int, Sums] = {}
    for r in pairs.collect():
        s = out.setdefault(int(r["fold"]), Sums(np.zeros((p + 2, p + 2))))
        a, b = place(r["i"]), place(r["j"])
        s.g[a, b] = s.g[b, a] = r["v"]
    return out


def descend(sums: Sums, reg_param: float, start: np.ndarray | None = None, tol: float = 1e-12, most: int = 100_000) -> Lasso:
    """Coordinate descent on standardised covariances; a constant feature has coefficient 0."""
    mean, cov, with_label, sd, label = sums.moments()
    live = np.flatnonzero(sd > 1e-9 * (1 + np.abs(mean)))
    g = cov[np.ix_(live, live)] / np.outer(sd[live], sd[live])
    c = with_label[live] / sd[live]
    b = np.zeros(len(live)) if start is None else start[live] * sd[live]
    size = max(float(np.abs(c).max(initial=0.0)), 1e-300)
    for _ in range(most):
        moved = 0.0
        for j in range(len(live)):
            pull = c[j] - g[j] @ b + g[j, j] * b[j]
            new = np.sign(pull) * max(abs(pull) - reg_param, 0.0) / g[j, j]
            moved = max(moved, abs(new - b[j]))
            b[j] = new
        if moved <= tol * size:
            break
    out = np.zeros(len(mean))
    out[live] = b / sd[live]
    return Lasso(reg_param, out, label - float(out @ mean))


@dataclass
class CrossValidated:
    """``folds``: (reg_param, fold, coefficients and intercept of the others, r2 of the fold); ``best`` is fitted on all rows."""
    folds: list[tuple[float, int, Lasso, float]]
    best: Lasso
    names: list[tuple[str, str | None]] = field(default_factory=list)

    def averages(self) -> list[tuple[float, float]]:
        regs = list(dict.fromkeys(r for r, *_ in self.folds))
        return [(r, float(np.mean([v for x, _, _, v in self.folds if x == r]))) for r in regs]


def cross_validate(rows: DataFrame, reg_params: list[float], x: str = "x", label: str = "label", fold: str = "fold",
                   names: list[tuple[str, str | None]] | None = None) -> CrossValidated:
    """All candidates on all folds, and the one of the best mean r2 (the first of equals) on all rows: one pass over ``rows``."""
    # the sums are written, so that the table is read once
    by_fold = collect_sums(materialize(pair_sums(rows, x, label, fold), "gram"))
    if not by_fold:
        raise ValueError("no labelled rows")
    total = Sums(sum(s.g for s in by_fold.values()))
    found = []
    for reg in reg_params:
        for f in sorted(by_fold):
            train = total - by_fold[f]
            model = descend(train if train.n > 0 else total, reg)
            found.append((float(reg), f, model, by_fold[f].r2(model)))
    out = CrossValidated(found, None, names or [])
    reg = max(out.averages(), key=lambda a: (not np.isnan(a[1]), a[1] if not np.isnan(a[1]) else 0.0))[0]
    out.best = descend(total, reg)
    return out


def candidates(spark: SparkSession, cv: CrossValidated) -> DataFrame:
    """One row per candidate: its reg_param and mean validation metric."""
    return spark.createDataFrame(cv.averages(), "reg_param double, avg_metric double")


# ---- the model as a table, and scoring by it

def coefficient_rows(spark: SparkSession, model: Lasso, names: list[tuple[str, str | None]]) -> DataFrame:
    """``feature, value, coefficient``: a row per coefficient that is not 0, and the intercept. A numeric feature has no value."""
    rows = [(INTERCEPT, None, model.intercept)]
    rows += [(f, v, float(c)) for (f, v), c in zip(names, model.coefficients) if c != 0]
    return spark.createDataFrame(rows, "feature string, value string, coefficient double")


def score(rows: DataFrame, coefficients: DataFrame, numeric: list[str], categorical: list[str],
          prediction: str = "prediction") -> DataFrame:
    """Predictions by joining a row's values with their coefficients (M6): no vector over all names exists anywhere.

    Values without a coefficient, NULL among them, add 0. A value that many rows share is joined from a broadcast of fewer than a
    thousand such values, see ``operators.skew``.
    """
    known = {r["feature"]: r["coefficient"] for r in coefficients.where(
        F.col("feature").isin([INTERCEPT, *numeric]) & F.col("value").isNull()).collect()}
    columns = rows.columns
    total = rows.count() if categorical else 0
    out = rows.withColumn("_sum", F.lit(float(known.get(INTERCEPT, 0.0))))
    for c in numeric:
        out = out.withColumn("_sum", F.col("_sum") + F.lit(float(known.get(c, 0.0))) * F.coalesce(F.col(c).cast("double"), F.lit(0.0)))
    for c in categorical:
        own = coefficients.where((F.col("feature") == c) & F.col("value").isNotNull()).select("value", "coefficient")
        asked = rows.groupBy(F.col(c).cast("string").alias("_asked")).agg(F.count(F.lit(1)).alias("_count"))
        small = asked.join(own, F.col("_asked") == F.col("value"), "left").select(
            "_asked", "_count", F.coalesce("coefficient", F.lit(0.0)).alias("_coefficient"))
        big = out.withColumn("_key", F.col(c).cast("string"))
        out = join_split_hot(big, small, ["_key"], ["_asked"], "_count", total)
        out = out.withColumn("_sum", F.col("_sum") + F.col("_coefficient")).select(*columns, "_sum")
    return out.select(*columns, F.col("_sum").alias(prediction))


def one_hot_table(cvm) -> DataFrame:
    """The coefficient table of a fitted index + one-hot pipeline: what ``operators.model`` saves, as rows."""
    from rentrisk.operators import features as FE
    stages = cvm.bestModel.stages
    indexer, encoder, linear = stages[0], stages[1], stages[-1]
    names: list[tuple[str, str | None]] = []
    for column, size in zip(FE.CATEGORICAL, encoder.categorySizes):
        # the name's categories are its labels by index, and one for unseen names; the others' are their own numbers
        labels = list(indexer.labelsArray[0]) if column == "name" else [str(v) for v in range(size)]
        names += [(column, labels[i] if i < len(labels) else None) for i in range(size)]
    names += [("age_buckets", None), ("rent_amount", None)]
    coefficients = linear.coefficients.toArray()
    if len(coefficients) != len(names):
        raise ValueError(f"{len(coefficients)} coefficients for {len(names)} slots")
    seen = [(nm, c) for nm, c in zip(names, coefficients) if nm[1] is not None or nm[0] not in FE.CATEGORICAL]
    model = Lasso(0.0, np.array([c for _, c in seen]), float(linear.intercept))
    return coefficient_rows(SparkSession.active(), model, [nm for nm, _ in seen])
