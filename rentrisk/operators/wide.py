"""Lasso with cross-validation over any number of slots: the estimator's own optimiser, its vectors as tables.

Spark ML's ``LinearRegression`` keeps a dozen dense vectors per fit on the driver (coefficients, gradients, moments, the optimiser's memory) and
some in every task: one double per slot, so they grow with the names. Here a vector is a column of a table with a row per slot. The driver
receives sums over the table only: norms, inner products, the loss.

* All candidates on all folds, and on all rows, go in lock step: one pass over the rows gives the gradients of all of them. Rows are kept
  by the name's slot, so the coefficients come to the rows and not the rows to the coefficients.
* A slot of more than a thousandth of the rows is broadcast (there are fewer than a thousand per column), see ``operators.skew``.
* The steps are those of Breeze's OWL-QN as the estimator sets it up: features scaled by their sample standard deviation (a constant one
  is left out), label likewise, memory of 10, backtracking line search with strong Wolfe conditions. A direction of the two-loop recursion
  is a linear combination of the gradient and the memory, so its factors follow from inner products.

The estimator takes this way above ``MAX_NORMAL`` slots only; up to there it solves the normal equations, whose truncated path is another.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Model, PipelineModel
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentrisk.operators import dictionary as DICT
from rentrisk.operators.features import CATEGORICAL, checked
from rentrisk.operators.skew import DEFAULT_SHARE
from rentrisk.session import materialize

#: Slots up to which Spark's estimator solves the normal equations.
MAX_NORMAL = 4096
#: Slot of the constant.
ONE = -1
INTERCEPT, NUMERIC = "(intercept)", ["age_buckets", "rent_amount"]
# Fixed values of Breeze's optimiser and line search.
MEMORY, VALUES, ARMIJO, WOLFE, GROW, MOST_TRIALS, MIN_ALPHA, MAX_ALPHA = 10, 20, 1e-4, 0.9, 2.1, 20, 1e-10, 1e10
#: Sums asked for in one aggregate: more are not compiled.
AT_ONCE = 60
#: Rows kept in one partition.
PART_ROWS = 200_000


def num(v: float) -> str:
    """SQL literal of a double."""
    return f"{float(v)!r}D" if math.isfinite(v) else f"double('{float(v)!r}')"


@dataclass
class Moments:
    """Count, mean and summed squares around the mean, merged without loss for constants."""
    n: int = 0
    mean: float = 0.0
    m2: float = 0.0

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not self.n or not other.n:
            return self if self.n else other
        gap = other.mean - self.mean
        return Moments(n, self.mean + gap * other.n / n, self.m2 + other.m2 + gap * gap * self.n * other.n / n)

    @property
    def sd(self) -> float:
        return math.sqrt(max(self.m2 / (self.n - 1), 0.0)) if self.n > 1 else 0.0

    @property
    def inverse(self) -> float:
        return 1 / self.sd if self.sd else 0.0


@dataclass
class Fit:
    """One fit of the lock step: a penalty, and the fold that is left out (the number of folds: none is)."""
    reg: float
    held: int
    label: Moments
    iteration: int = 0
    done: bool = False
    failed: bool = False
    #: rounds whose step and change of gradient are remembered, the newest first
    rounds: list[int] = field(default_factory=list)
    value: float = 0.0
    first: float = 0.0
    #: plain losses of the states so far
    losses: list[float] = field(default_factory=list)
    alpha: float = 0.0
    trial: int = 0
    found: tuple = ()

    @property
    def scale(self) -> float:
        return self.label.sd or 1.0

    @property
    def l1(self) -> float:
        # a label that does not vary is predicted by its mean
        return self.reg / self.label.sd if self.label.sd else math.inf

    def direction(self, dot) -> dict:
        """Factors of the gradient ``a``, steps ``s`` and gradient changes ``y``; raises ArithmeticError as Breeze's NaNHistory."""
        d, factor = {("a", 0): 1.0}, {}
        if self.rounds:
            new = self.rounds[0]
            sy = dot(("s", new), ("y", new))
            if sy < 0 or math.isnan(sy):
                raise ArithmeticError
            diag = _ratio(sy, dot(("y", new), ("y", new)))
        for r in self.rounds:
            factor[r] = _ratio(sum(f * dot(("s", r), v) for v, f in d.items()), dot(("s", r), ("y", r)))
            if math.isnan(factor[r]):
                raise ArithmeticError
            d["y", r] = d.get(("y", r), 0.0) - factor[r]
        if self.rounds:
            d = {v: f * diag for v, f in d.items()}
        for r in reversed(self.rounds):
            beta = _ratio(sum(f * dot(("y", r), v) for v, f in d.items()), dot(("s", r), ("y", r)))
            d["s", r] = d.get(("s", r), 0.0) + factor[r] - beta
        return {v: -f for v, f in d.items()}

    def fail(self) -> None:
        """Once: the memory is forgotten and the step tried again. Twice in a row: the fit stays where it is."""
        self.done, self.failed, self.rounds, self.alpha = self.failed, True, [], 0.0


def _ratio(a: float, b: float) -> float:
    return a / b if b else (math.nan if not a or math.isnan(a) else math.copysign(math.inf, a))


class Table:
    """The rows by home slot, and the vectors of all fits by slot."""

    def __init__(self, rows: DataFrame, dictionary: DataFrame, folds: int, regs: list[float], share: int):
        self.folds, self.p = folds, dictionary.count()
        self.names = dictionary.where("column = 'name'").count()
        spark = rows.sparkSession
        slots = [F.coalesce("name_slot", F.lit(self.p)), *[F.col(f"{c}_slot") for c in CATEGORICAL[1:]]]
        y = F.col("label").cast("double")
        y = F.when(y.isNull() | F.isnan(y), F.raise_error(F.lit("Labels MUST NOT be Null or NaN")).cast("double")).otherwise(y)
        rows = rows.select("fold", y.alias("y"), *[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(NUMERIC)],
                           *[s.cast("long").alias(f"s{i}") for i, s in enumerate(slots)])
        stats = rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), *[x for c in ("y", "v0", "v1") for x in (
            F.avg(c).alias(c), F.var_pop(c).alias(f"{c}_var"))]).collect()
        by_fold = {r["fold"]: {c: Moments(r["n"], r[c], r[f"{c}_var"] * r["n"]) for c in ("y", "v0", "v1")} for r in stats}
        if set(by_fold) - set(range(folds)):
            raise ValueError(f"Fold number must be in range [0, {folds}), but got {set(by_fold) - set(range(folds))}")
        for f in range(folds):
            if f not in by_fold or len(by_fold) < 2:
                raise ValueError(f"The {'validation' if f not in by_fold else 'training'} data at fold {f} is empty.")
        self.by_fold = by_fold
        self.trained = [{c: sum((m[c] for f, m in sorted(by_fold.items()) if f != t), Moments()) for c in ("y", "v0", "v1")}
                        for t in range(folds + 1)]
        self.fits = [Fit(float(r), t, self.trained[t]["y"]) for r in regs for t in range(folds + 1)]
        total = self.trained[folds]["y"].n
        hot = max(1, total // share)

        # moments of the slots: a value's count in a training set gives both
        seen = rows.select("fold", F.explode(F.array("s0", "s1", "s2")).alias("slot")).groupBy("slot").agg(
            *[F.count_if((F.col("fold") != t) if t < folds else F.lit(True)).alias(f"n{t}") for t in range(folds + 1)])
        extra = spark.createDataFrame([(s, *[m["y"].n for m in self.trained]) for s in (self.p + 1, self.p + 2, ONE)], seen.schema)
        state = seen.withColumn("hot", F.expr(f"slot = {self.p} or n{folds} > {hot}")).unionByName(extra.withColumn("hot", F.lit(True)))
        for t, m in enumerate(self.trained):
            n = m["y"].n
            numeric = " ".join(f"when slot = {self.p + 1 + i} then {{{i}}}" for i in range(len(NUMERIC)))
            one = f"when slot >= 0 and n{t} > 0 and n{t} < {n} then"
            inverse = f"case {numeric} {one} 1D / sqrt(n{t} * double({n} - n{t}) / {n} / {max(n - 1, 1)}) else 0D end"
            mean = f"case {numeric} {one} double(n{t}) / {n} else 0D end"
            state = state.withColumn(f"inv{t}", F.expr(inverse.format(*[num(m[f"v{i}"].inverse) for i in range(len(NUMERIC))])))
            state = state.withColumn(f"mu{t}", F.col(f"inv{t}") * F.expr(mean.format(*[num(m[f"v{i}"].mean) for i in range(len(NUMERIC))])))
        self.fixed = ["slot", "hot", *[f"{c}{t}" for t in range(folds + 1) for c in ("n", "inv", "mu")]]
        self.state = materialize(state.select(*self.fixed), "wide-slots")

        cold = {r["i"]: r["n"] for r in dictionary.where(F.col("n") <= hot).groupBy(
            F.array_position(F.array(*[F.lit(c) for c in CATEGORICAL]), F.col("column")).alias("i")).agg(F.count(F.lit(1)).alias("n")).collect()}
        #: columns with values that are not broadcast, the one with the most first: rows are kept by it
        self.cold = sorted((i - 1 for i in cold), key=lambda i: -cold[i + 1])
        # where the value is broadcast the key is a number that no slot has, another for every row
        apart = -2 - F.monotonically_increasing_id()
        broadcast = F.broadcast(self.state.where("hot").select(F.col("slot").alias("_hot")))
        for i in self.cold:
            rows = rows.join(broadcast, F.col(f"s{i}") == F.col("_hot"), "left").withColumn(
                f"k{i}", F.when(F.col("_hot").isNull(), F.col(f"s{i}")).otherwise(apart)).drop("_hot")
        parts = max(spark.sparkContext.defaultParallelism, -(-total // PART_ROWS))
        home = [f"k{i}" for i in self.cold[:1]]
        rows = rows.repartition(parts, *home)
        self.rows = (rows.sortWithinPartitions(*home) if home else rows).persist(StorageLevel.DISK_ONLY)

    def residuals(self, offsets: list, coefficients: DataFrame | None) -> DataFrame:
        """The rows with ``d<m>``: prediction less label, in the label's standard deviations, of every fit.

        ``coefficients``: slot, hot and ``e<m>`` per fit, for features as they are. ``offsets``: constant and numeric factors per fit.
        """
        out, terms = self.rows, [[] for _ in self.fits]
        if coefficients is not None:
            used = " or ".join(f"e{m} <> 0" for m in range(len(self.fits)))
            for kind, i in [("k", i) for i in self.cold] + [("s", i) for i in range(len(CATEGORICAL))]:
                own = coefficients.where(F.col("hot") if kind == "s" else ~F.col("hot")).where(used).select(
                    F.col("slot").alias("_slot"), *[F.col(f"e{m}").alias(f"{kind}{i}_{m}") for m in range(len(self.fits))])
                own = F.broadcast(own) if kind == "s" else own
                out = out.join(own, F.col(f"{kind}{i}") == F.col("_slot"), "left").drop("_slot")
                for m, t in enumerate(terms):
                    t.append(f"coalesce({kind}{i}_{m}, 0D)")
        return out.select("fold", "y", "v0", "v1", "s0", "s1", "s2", *[F.expr(" + ".join(
            [num(c), *[f"{num(v)} * v{i}" for i, v in enumerate(vs)], *terms[m], f"-y / {num(self.fits[m].scale)}"])).alias(f"d{m}")
            for m, (c, vs) in enumerate(offsets)])

    def sums(self, offsets: list, coefficients: DataFrame | None) -> DataFrame:
        """``slot, q<m>, l<m>``: sums of residual times value per slot, and in the constant's row those of the squared residuals."""
        rows = self.residuals(offsets, coefficients)
        d = [f"if(fold = {f.held}, 0D, d{m})" for m, f in enumerate(self.fits)]
        pairs = [*[f"named_struct('slot', s{i}, 'v', 1D)" for i in range(len(CATEGORICAL))],
                 *[f"named_struct('slot', {self.p + 1 + i}L, 'v', v{i})" for i in range(len(NUMERIC))], f"named_struct('slot', {ONE}L, 'v', 1D)"]
        rows = rows.select(*[F.expr(x).alias(f"d{m}") for m, x in enumerate(d)], F.expr(f"inline(array({', '.join(pairs)}))"))
        return materialize(rows.groupBy("slot").agg(*[F.expr(x) for m in range(len(d)) for x in (
            f"sum(v * d{m}) as q{m}", f"sum(if(slot = {ONE}, d{m} * d{m}, 0D)) as l{m}")]), "wide-sums")

    def offsets(self, state: DataFrame, x: list[str], also: list[Column] = ()) -> tuple[list, list]:
        """Constants and numeric factors of the fits at the columns ``x`` of the state; and further sums over it."""
        ask = []
        for m, f in enumerate(self.fits):
            ask += [F.expr(f"sum({x[m]} * mu{f.held})"), *[F.expr(f"sum(if(slot = {self.p + 1 + i}, {x[m]} * inv{f.held}, 0D))")
                                                         for i in range(len(NUMERIC))]]
        got = [float(v or 0) for v in state.agg(*[c.alias(f"c{j}") for j, c in enumerate([*ask, *also])]).first()]
        out, w = [], 1 + len(NUMERIC)
        for m, f in enumerate(self.fits):
            out.append((f.label.mean / f.scale - got[m * w], got[m * w + 1:(m + 1) * w]))
        return out, got[len(ask):]


def descend(table: Table, max_iter: int, tol: float) -> list[str]:
    """OWL-QN on all fits; returns the columns of the state that hold the solutions, of scaled features."""
    fits = table.fits
    every = range(len(fits))

    def gradient(m):
        return F.expr(f"coalesce(q{m}, 0D) * inv{fits[m].held} / {fits[m].label.n}")

    def pulled(m, x, g):
        """The gradient with the penalty's, where that has one: the steepest descent's pseudo gradient."""
        l1 = num(fits[m].l1)
        return F.expr(f"case when {x} <> 0 then {g} + signum({x}) * {l1} when {g} - {l1} > 0 then {g} - {l1} when {g} + {l1} < 0 then {g} + {l1} else 0D end")

    state = table.state.withColumns({f"x0_{m}": F.lit(0.0) for m in every})
    offsets, _ = table.offsets(state, [f"x0_{m}" for m in every])
    sums = table.sums(offsets, None)
    state = state.join(sums, "slot", "left").withColumns({f"g0_{m}": gradient(m) for m in every})
    table.state = materialize(state.drop(*[f"{c}{m}" for c in "ql" for m in every]), "wide-state")
    loss = sums.where(F.col("slot") == ONE).first()
    for m, f in enumerate(fits):
        f.value = f.first = loss[f"l{m}"] / 2 / f.label.n
        f.losses, f.done = [f.first], max_iter <= 0
    r, kept = 0, [0]
    while True:
        x, g = [f"x{r}_{m}" for m in every], [f"g{r}_{m}" for m in every]
        if all(f.done for f in fits):
            return x
        state = table.state.withColumns({f"a{m}": pulled(m, x[m], g[m]) for m in every})
        # inner products of the gradients and the memory
        ask, place = [], {}
        for m, f in enumerate(fits):
            if f.done:
                continue
            vectors = {("a", 0): f"a{m}", **({} if f.iteration else {("g", 0): g[m]})}
            for q in f.rounds:
                vectors |= {(v, q): f"({c}{q + 1}_{m} - {c}{q}_{m})" for v, c in ("sx", "yg")}
            for u in vectors:
                for v in vectors:
                    # of the plain gradient its norm is asked for, of two steps nothing
                    if (m, v, u) not in place and (u == v or "g" not in (u[0], v[0])) and not u[0] == v[0] == "s":
                        place[m, u, v] = len(ask)
                        ask.append(f"sum({vectors[u]} * {vectors[v]})")
        products = [v for j in range(0, len(ask), AT_ONCE) for v in state.agg(*[F.expr(s).alias(f"c{i}") for i, s in enumerate(ask[j:j + AT_ONCE])]).first()]

        def dot(m):
            return lambda u, v: float(products[place[m, u, v] if (m, u, v) in place else place[m, v, u]])

        moved, direction = [], {m: F.lit(0.0) for m in every}
        for m, f in enumerate(fits):
            if f.done:
                continue
            # the checks of a state: values, gradient
            f.done = len(f.losses) > VALUES and abs(f.value - max(f.losses[-VALUES:])) <= tol * abs(f.first) \
                or math.sqrt(dot(m)(("a", 0), ("a", 0))) <= max(tol * abs(f.value), 1e-8)
            if f.done:
                continue
            try:
                factors = f.direction(dot(m))
            except ArithmeticError:
                f.fail()
                continue
            raw = " + ".join(f"{num(w)} * " + (f"a{m}" if v == "a" else "({0}{1}_{3} - {0}{2}_{3})".format("x" if v == "s" else "g", q + 1, q, m))
                             for (v, q), w in factors.items())
            direction[m] = F.expr(f"if(({raw}) * a{m} < 0, {raw}, 0D)")
            f.alpha = 0.5 / math.sqrt(dot(m)(("g", 0), ("g", 0))) if f.iteration < 1 else 1.0
            moved.append(m)
        if not moved:
            continue
        # written: every trial reads it
        state = materialize(state.withColumns({f"d{m}": direction[m] for m in every}), "wide-direction")
        start = dict(zip(moved, state.agg(*[F.expr(f"sum(a{m} * d{m})").alias(f"c{m}") for m in moved]).first()))

        # lock step of the line searches; a fit that has found its step waits with it
        searching = set(moved)

        def judge(m, value, slope):
            """Takes the step of fit ``m`` or sets the next one to try."""
            f, by = fits[m], 1.0
            if value > f.value + f.alpha * start[m] * ARMIJO or slope > -WOLFE * start[m]:
                by = 0.1 if f.iteration < 1 else 0.5
            elif slope < WOLFE * start[m]:
                by = GROW
            if by != 1.0 and not MIN_ALPHA <= f.alpha * by <= MAX_ALPHA:
                moved.remove(m)
                f.fail()
            elif by != 1.0 and f.trial < MOST_TRIALS - 1:
                f.alpha, f.trial = f.alpha * by, f.trial + 1
                return
            searching.discard(m)

        for m in list(moved):
            f = fits[m]
            f.trial = 0
            # the search takes the plain loss of the state for the value at its first trial: where that settles it, the trial need not be made
            if f.losses[-1] > f.value + f.alpha * start[m] * ARMIJO:
                judge(m, f.losses[-1], 0.0)
        while searching:
            at = state.withColumns({f"to{m}": F.expr(f"{x[m]} + {num(fits[m].alpha)} * d{m}" if m in moved else x[m]) for m in every})
            at = at.withColumns({f"to{m}": F.expr(f"if(signum(to{m}) = if({x[m]} <> 0, signum({x[m]}), signum(-a{m})), to{m}, 0D)") for m in moved})
            offsets, more = table.offsets(at, [f"to{m}" for m in every], [F.expr(f"sum(abs(to{m}))") for m in moved])
            size = dict(zip(moved, more))
            # written, as a filter on them would be planned with all that they are made of
            sums = table.sums(offsets, materialize(at.select(
                "slot", "hot", *[F.expr(f"to{m} * inv{f.held}").alias(f"e{m}") for m, f in enumerate(fits)]), "wide-coefficients"))
            at = at.join(sums, "slot", "left").withColumns({f"new{m}": gradient(m) if m in moved else F.col(g[m]) for m in every})
            slopes = at.withColumns({f"pull{m}": pulled(m, f"to{m}", f"new{m}") for m in moved}).agg(
                *[F.expr(f"sum(pull{m} * d{m})").alias(f"p{m}") for m in moved]).first()
            losses = sums.where(F.col("slot") == ONE).first()
            for m in sorted(searching):
                f = fits[m]
                loss = losses[f"l{m}"] / 2 / f.label.n
                f.found = (loss, loss + f.l1 * size[m])
                judge(m, f.found[1] if f.trial else f.losses[-1], slopes[f"p{m}"])
        if not moved:
            continue
        for m in moved:
            f = fits[m]
            f.losses = [*f.losses, f.found[0]]
            f.value, f.iteration, f.failed, f.rounds = f.found[1], f.iteration + 1, False, [r, *f.rounds][:MEMORY]
            f.done = f.iteration >= max_iter
        need = {k for f in fits if not f.done for q in f.rounds for k in (q, q + 1)}
        kept = [k for k in kept if k in need]
        table.state = materialize(at.select(
            *table.fixed, *[f"{v}{k}_{m}" for k in kept for v in "xg" for m in every],
            *[F.col(f"to{m}" if m in moved else x[m]).alias(f"x{r + 1}_{m}") for m in every],
            *([] if all(f.done for f in fits) else [F.col(f"new{m}" if m in moved else g[m]).alias(f"g{r + 1}_{m}") for m in every])), "wide-state")
        r += 1
        kept.append(r)


def fit(cv: CrossValidator, rows: DataFrame, dictionary: DataFrame, share: int = DEFAULT_SHARE) -> CrossValidatorModel:
    """``cv`` on rows with the dictionary's slots; its estimator is a pipeline of the lasso alone."""
    estimator, maps = cv.getEstimator().getStages()[-1], cv.getEstimatorParamMaps()
    regs = [v for pm in maps for p, v in pm.items() if p.name == "regParam"]
    table = Table(rows, dictionary, cv.getNumFolds(), regs, share)
    try:
        return _fit(cv, table, regs, dictionary, estimator)
    finally:
        table.rows.unpersist()


def takes(cv: CrossValidator, features: int) -> bool:
    """Whether the estimator would run OWL-QN, with the settings that are kept to here."""
    lr = cv.getEstimator().getStages()[-1]
    maps = cv.getEstimatorParamMaps()
    plain = (lr.getElasticNetParam() == 1.0 and lr.getFitIntercept() and lr.getStandardization() and lr.getLoss() == "squaredError"
             and not lr.isSet(lr.weightCol) and cv.getEvaluator().getMetricName() == "r2" and not cv.getCollectSubModels())
    grid = all([p.name for p in pm] == ["regParam"] and v > 0 for pm in maps for v in pm.values())
    return plain and grid and (lr.getSolver() == "l-bfgs" or lr.getSolver() == "auto" and features > MAX_NORMAL)


def _fit(cv: CrossValidator, table: Table, regs: list[float], dictionary: DataFrame, estimator) -> CrossValidatorModel:
    fits, folds = table.fits, table.folds
    x = descend(table, estimator.getMaxIter(), estimator.getTol())
    unseen = table.state.where(F.col("slot") == table.p).select(
        *[F.expr(f"{x[m]} * inv{f.held}") for m, f in enumerate(fits)]).first() or [0.0] * len(fits)
    offsets, _ = table.offsets(table.state, x)

    # a name that the training rows lack is validated as unseen
    coefficients = table.state.select("slot", "hot", *[F.expr(
        f"if(slot between 0 and {table.names - 1} and n{f.held} = 0, {num(unseen[m])}, {x[m]} * inv{f.held})").alias(f"e{m}")
        for m, f in enumerate(fits)])
    held = [m for m, f in enumerate(fits) if f.held < folds]
    errors = table.residuals(offsets, coefficients).agg(
        *[F.expr(f"sum(if(fold = {fits[m].held}, d{m} * d{m}, 0D))").alias(f"d{m}") for m in held]).first()
    metrics = [[0.0] * len(regs) for _ in range(folds)]
    for m in held:
        y = table.by_fold[fits[m].held]["y"]
        metrics[fits[m].held][m // (folds + 1)] = 1 - _ratio(errors[f"d{m}"] * fits[m].scale ** 2, y.m2)
    averages, spreads = CrossValidator._gen_avg_and_std_metrics(metrics)
    best = max(range(len(regs)), key=lambda j: (math.isnan(averages[j]), averages[j]))

    m = best * (folds + 1) + folds
    sd = fits[m].scale
    own = dictionary.join(table.state.select("slot", F.expr(f"{x[m]} * inv{folds} * {num(sd)}").alias("coefficient")), "slot")
    special = [(INTERCEPT, None, offsets[m][0] * sd), *[(c, None, v * sd) for c, v in zip(NUMERIC, offsets[m][1])], ("name", None, unseen[m] * sd)]
    own = own.select(F.col("column").alias("feature"), "value", "coefficient")
    model = LassoTable(materialize(own.unionByName(own.sparkSession.createDataFrame(special, own.schema)), "model-coefficients"), table.p + 3)
    return cv._copyValues(CrossValidatorModel(PipelineModel([model]), averages, None, spreads))


class LassoTable(Model, MLWritable, MLReadable):
    """A fitted lasso as rows ``feature, value, coefficient``; the row of ``name`` without a value is for names that are not in it."""

    def __init__(self, coefficients: DataFrame | None = None, features: int = 0):
        super().__init__()
        self.coefficients, self.features = coefficients, features

    def __repr__(self) -> str:
        return f"LinearRegressionModel: uid={self.uid}, numFeatures={self.features}"

    def _transform(self, rows: DataFrame) -> DataFrame:
        columns = rows.columns
        known = {r["feature"]: r["coefficient"] for r in self.coefficients.where("value is null").collect()}
        table = self.coefficients.where("value is not null").select(F.col("feature").alias("column"), "value", F.col("coefficient").alias("slot"))
        rows = materialize(checked(rows), "model-rows")
        # written per column: the next one reads the rows several times
        for c in CATEGORICAL:
            rows = materialize(DICT.encode(rows, table, [c], "_coefficient"), "model-coded")
        total = F.lit(known[INTERCEPT])
        for c in CATEGORICAL:
            total = total + F.coalesce(F.col(f"{c}_coefficient"), F.lit(known.get(c, 0.0)))
        for c in NUMERIC:
            total = total + F.lit(known[c]) * F.col(c)
        return rows.select(*columns, total.alias("prediction"))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: LassoTable):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, {"features": self.model.features})
        self.model.coefficients.write.parquet(f"{path}/coefficients")


class _Reader(MLReader):
    def load(self, path: str) -> LassoTable:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = LassoTable(self.sparkSession.read.parquet(f"{path}/coefficients"), metadata["features"])
        model._resetUid(metadata["uid"])
        return model
