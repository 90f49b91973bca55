"""SMOTE: synthetic minority rows over mixed attributes.

For every minority row and copy r = 1..m-1 (so original + synthetic = m x the
minority):

* a neighbour slot ``u = h(seed, id, r, 'u') mod k`` picks one of the row's k
  nearest neighbours (L4, ``rentrisk.operators.knn``);
* continuous attributes: ``x + gap * (y - x)`` with ``gap = h(seed, id, r, 'g')``
  uniform in [0, 1) (Chawla et al. 2002);
* discrete attributes: the parent's or the neighbour's value by a hash coin per
  attribute, so every synthetic value was observed (``discrete_by="coin"``); or, as the
  paper's SMOTE-NC does, the commonest value of the k neighbours, of equally common ones
  the smallest, NULL before all (``discrete_by="vote"``).

The draws are hashes of (seed, id, copy), not ``rand()``, so a recomputed task
produces the same rows. A row with no neighbour (a one-row minority) copies itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentrisk.functions.hashing import hash32, hash_unit
from rentrisk.operators.knn import KnnResult, attach_points, knn, neighbour_arrays


# Copies of one row made by one task at a time; results do not depend on it.
COPY_CHUNK = 4096
# From so many copies on, rows are dealt over the tasks before they are copied.
DEAL_FROM = 4


@dataclass
class SmoteSpec:
    discrete: list[str]
    continuous: list[str]
    k: int
    multiplier: int
    seed: int = 0
    id_col: str = "id"
    discrete_by: str = "coin"


def fan_out(rows: DataFrame, id_col: str, copies: int, chunk: int = COPY_CHUNK) -> DataFrame:
    """Rows times ``copy`` = 1..copies (L3). Rows are dealt out first, as the planner merges what is small before it grows into one
    task; many copies are dealt out in chunks, so a few rows with a large multiplier fill many tasks and no row makes an array
    longer than ``chunk``."""
    # a number is named, else the planner would merge these few rows into one task before they grow
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if copies > chunk:
        starts = F.explode(F.sequence(F.lit(1), F.lit(copies), F.lit(chunk))).alias("_from")
        rows = rows.select("*", starts).repartition(n, id_col, "_from")
    else:
        rows = (rows.repartition(n) if copies >= DEAL_FROM else rows).withColumn("_from", F.lit(1))
    last = F.least(F.col("_from") + (chunk - 1), F.lit(copies))
    return rows.select("*", F.explode(F.sequence(F.col("_from"), last)).alias("copy")).drop("_from")


def vote(neighbours: Column, name: str) -> Column:
    """The commonest value of an attribute in a neighbour list, copies counted; ties go to the smallest, NULL first."""
    seen = F.array_distinct(F.transform(neighbours, lambda e: e[name]))
    # a list has k + 1 entries at most
    votes = lambda v: F.aggregate(F.filter(neighbours, lambda e: e[name].eqNullSafe(v)), F.lit(0).cast("bigint"),
                                  lambda s, e: s + e["take"])
    return F.array_min(F.transform(seen, lambda v: F.struct((-votes(v)).alias("n"), v.alias("v"))))["v"]


def synthetic_rows(sample: DataFrame, spec: SmoteSpec, res: KnnResult | None = None) -> DataFrame:
    """Synthetic rows: (parent id, copy r, attributes...). ``sample`` holds id + attributes."""
    attrs = spec.discrete + spec.continuous
    if spec.discrete_by not in ("coin", "vote"):
        raise ValueError("discrete_by must be 'coin' or 'vote'")
    if spec.multiplier is None or spec.multiplier < 2:
        shape = sample.select(F.col(spec.id_col).alias("parent_id"), F.lit(0).alias("copy"), *attrs)
        return sample.sparkSession.createDataFrame([], shape.schema)
    if res is None:
        res = knn(sample.select(*attrs), spec.discrete, spec.continuous, spec.k)
    pts = res.points.select("_pid", *attrs, "_w")
    if res.k_eff > 0:
        # neighbour lists go to the points first (one to one), then one join to the rows
        pts = pts.join(neighbour_arrays(res, attrs), "_pid", "left")
        if spec.discrete_by == "vote":
            # once per point, before its rows are copied
            pts = pts.withColumns({f"_vote_{d}": vote(F.col("_nbs"), d) for d in spec.discrete})
    else:
        pts = pts.withColumn("_nbs", F.lit(None))
    rows = attach_points(sample.select(spec.id_col, *attrs), pts, attrs, res.n_rows)
    rid = F.col(spec.id_col)
    r = F.col("copy")
    gen = fan_out(rows, spec.id_col, spec.multiplier - 1)
    if res.k_eff > 0:
        u = hash32(spec.seed, rid, r, F.lit("u")) % F.lit(res.k_eff)
        gen = gen.withColumn("_u", u).withColumn(
            "_nb", F.filter("_nbs", lambda e: (e["slot"] <= F.col("_u")) & (F.col("_u") < e["slot"] + e["take"]))[0])
    else:
        gen = gen.withColumn("_nb", F.struct(*[F.col(a).alias(a) for a in attrs]))
    gap = hash_unit(spec.seed, rid, r, F.lit("g"))
    out = [rid.alias("parent_id"), r]
    for i, d in enumerate(spec.discrete):
        if spec.discrete_by == "vote":
            out.append((F.col(f"_vote_{d}") if res.k_eff > 0 else F.col(d)).alias(d))
            continue
        coin = hash32(spec.seed, rid, r, F.lit(f"c{i}")) % 2
        out.append(F.when(coin == 0, F.col(d)).otherwise(F.col("_nb")[d]).alias(d))
    for c in spec.continuous:
        x = F.col(c)
        out.append((x + gap * (F.col("_nb")[c] - x)).alias(c))
    return gen.select(*out)
