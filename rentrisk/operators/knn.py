"""Exact k nearest neighbours over mixed continuous / discrete attributes (L2, L4).

Distance (L2): continuous attributes are min-max scaled to [0, 1], discrete attributes count 1 per mismatch,

    d2(p, q) = sum_c ((p_c - q_c) / range_c)^2 + #mismatches(p, q)

NULL equals NULL in either kind, and differs from any value by 1 (a continuous NULL by the whole range; NaN counts
as NULL). Neighbours are ordered by (d2, the neighbour's attribute values); copies of the same attribute vector are
interchangeable. ``k`` is capped at ``n - 1``.

Search without a cross join, exact, with bounded blocks:

* identical rows collapse to one weighted point first (a map-side-combined aggregate), so a value repeated a billion
  times is one point of weight 1e9;
* every point is listed once per discrete subset S, in the group of its values on S (and of its pattern of continuous
  NULLs). A pair is examined only in the stratum S where it agrees exactly, and there its distance is (continuous
  part) + (number of mismatches);
* points of a group with identical continuous values (a clump) are cut to the first k + 1 in attribute order. That loses nothing:
  members of a clump of S agree on S with every point of the group, so before a member that is left out come k
  others at least as near (a window group limit, applied map-side);
* each group is cut into cells of some ``target`` points, at most twice as many, by quantiles of its widest attribute, level by level (a k-d partition with
  up to ``FAN`` children a node). Cells follow the density, so an outlier or a skewed amount does not make them coarse. A level is one
  aggregate of quantile sketches and one join; nodes that hold many rows are joined from a broadcast of fewer than a thousand;
* a point's own cells of all strata bound its k-th distance from above. With that radius it goes down the partition again, to every cell that
  the ball meets; a stratum whose mismatches alone exceed the bound is not entered. The border of a cell being farther than the radius is
  what proves that the cells beyond need no look. The k best of these cells are the answer, with no further round.

What the steps hand on is written to the shared checkpoint folder, so lineage stays short and survives executor loss.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentrisk.operators.skew import DEFAULT_SHARE, join_split_hot
from rentrisk.session import materialize

FAN = 16
#: Slack of the scaled coordinates: a ball is wider than its radius by this.
SLACK = 1e-9


@dataclass
class KnnResult:
    """``points``: _pid, attributes, _w (copies).  ``entries``: per point, the slots
    [_slot, _slot + _take) of its neighbour list filled by neighbour attributes ``nb_*``.
    ``work``: per searched point, how many rows its cells held (``candidates``)."""

    points: DataFrame
    entries: DataFrame
    k_eff: int
    n_rows: int
    rounds: int
    work: DataFrame | None = None


def without_nan(df: DataFrame, continuous: list[str]) -> DataFrame:
    """NaN as NULL."""
    for c in continuous:
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            df = df.withColumn(c, F.when(~F.isnan(c), F.col(c)))
    return df


def scale_stats(df: DataFrame, continuous: list[str]) -> dict:
    """Min, range and number of NULLs of each continuous attribute and the row count (one small row)."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in continuous:
        aggs += [F.min(c).alias(f"min_{c}"), (F.max(c) - F.min(c)).alias(f"rng_{c}"), F.count_if(F.col(c).isNull()).alias(f"nulls_{c}")]
    row = df.agg(*aggs).collect()[0].asDict()
    return row


def _t(p: Column, q: Column, rng: float) -> Column:
    d = (p - q) / F.lit(float(rng)) if rng else F.lit(0.0)
    return (F.when(p.isNull() & q.isNull(), F.lit(0.0)).when(p.isNull() | q.isNull(), F.lit(1.0)).otherwise(d * d))


def distance2(p: dict, q: dict, discrete: list[str], continuous: list[str], stats: dict) -> Column:
    """d2 with a fixed operation order (the SQL oracle uses the same order)."""
    cont = None
    for c in continuous:
        t = _t(p[c], q[c], stats[f"rng_{c}"])
        cont = t if cont is None else cont + t
    mism = None
    for d in discrete:
        m = F.when(p[d].eqNullSafe(q[d]), F.lit(0)).otherwise(F.lit(1))
        mism = m if mism is None else mism + m
    cont = cont if cont is not None else F.lit(0.0)
    return cont + (mism.cast("double") if mism is not None else F.lit(0.0))


def prepare_points(rows: DataFrame, discrete: list[str], continuous: list[str], k: int):
    """Weighted distinct points with stable ids and scaled coordinates ``_z``; stats; k capped at n-1."""
    attrs = discrete + continuous
    rows = without_nan(rows.select(*attrs), continuous)
    stats = scale_stats(rows, continuous)
    n = int(stats["_n"])
    k_eff = max(0, min(k, n - 1))
    pts = rows.groupBy(*attrs).agg(F.count(F.lit(1)).alias("_w"))
    z = []
    for c in continuous:
        rng = stats[f"rng_{c}"]
        zc = (F.col(c) - F.lit(float(stats[f"min_{c}"]))) / F.lit(float(rng)) if rng else F.lit(0.0)
        z.append(F.when(F.col(c).isNotNull(), zc))
    # unique, stable point ids: assigned once, then made durable by the checkpoint
    pts = materialize(pts.select(F.monotonically_increasing_id().alias("_pid"), *attrs, "_w",
                                 F.array(*z).cast("array<double>").alias("_z")), "knn-points")
    return pts, stats, n, k_eff


def self_entries(pts: DataFrame, attrs: list[str], k_eff: int) -> DataFrame:
    """The copies of a point are its nearest neighbours (distance 0)."""
    own = F.col("_w") - 1
    return pts.where(own > 0).select(
        "_pid", F.lit(0).cast("bigint").alias("_slot"), F.least(own, F.lit(k_eff)).cast("bigint").alias("_take"),
        *[F.col(a).alias(f"nb_{a}") for a in attrs], F.lit(0.0).alias("_d2"))


def knn(rows: DataFrame, discrete: list[str], continuous: list[str], k: int,
        target: float | None = None, clump_limit: int | None = None) -> KnnResult:
    """Exact neighbours. ``target``: points of a cell, at most doubled; ``clump_limit``: keep more of a clump than needed."""
    attrs = discrete + continuous
    pts, stats, n, k_eff = prepare_points(rows, discrete, continuous, k)
    if k_eff == 0:
        return KnnResult(pts, _no_entries(pts, attrs), 0, n, 0)
    pending = pts.where(F.col("_w") - 1 < k_eff)
    found, rounds, work = exact_search(pts, pending, discrete, continuous, stats, k_eff, target, clump_limit)
    return KnnResult(pts, self_entries(pts, attrs, k_eff).unionByName(found), k_eff, n, rounds, work)


def _no_entries(pts: DataFrame, attrs: list[str]) -> DataFrame:
    """An empty entries frame with the right schema."""
    shape = pts.select("_pid", F.lit(0).cast("bigint").alias("_slot"), F.lit(0).cast("bigint").alias("_take"),
                       *[F.col(a).alias(f"nb_{a}") for a in attrs], F.lit(0.0).alias("_d2"))
    return pts.sparkSession.createDataFrame([], shape.schema)


# ---- strata and groups

def null_bits(z: Column, n: int) -> Column:
    """Which coordinates are NULL, as bits."""
    bits = [F.when(F.get(z, F.lit(i)).isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i in range(n)]
    return reduce(lambda a, b: a + b, bits, F.lit(0))


def strata(pts: DataFrame, discrete: list[str]) -> DataFrame:
    """Every point once per discrete subset S (bit mask), with its S-key ``_k*`` (NULL outside S)."""
    x = pts.select("*", F.explode(F.array(*[F.lit(m) for m in range(1 << len(discrete))])).alias("_mask"))
    keys = [F.when(F.col("_mask").bitwiseAND(F.lit(1 << i)) != 0, F.col(d)).alias(f"_k{i}")
            for i, d in enumerate(discrete)]
    return x.select("*", *keys)


def group_id(discrete: list[str], pattern: Column) -> Column:
    """A hash names a group of (mask, S-key, NULL pattern); two groups of one hash would share cells, not results."""
    return F.xxhash64("_mask", pattern, *[f"_k{i}" for i in range(len(discrete))])


def strata_rows(pts: DataFrame, discrete: list[str], continuous: list[str], limit: int) -> DataFrame:
    """The searched side: every point in every stratum, clumps cut to their first ``limit`` in attribute order."""
    x = strata(pts, discrete).withColumn("_np", null_bits(F.col("_z"), len(continuous)))
    clump = Window.partitionBy("_mask", *[f"_k{i}" for i in range(len(discrete))], *continuous)
    x = x.withColumn("_rn", F.row_number().over(clump.orderBy(*discrete, "_pid"))).where(F.col("_rn") <= limit)
    return x.select(group_id(discrete, F.col("_np")).alias("_gid"), "_mask", "_pid", "_z", "_w", *discrete, *continuous)


# ---- k-d partition

def _at(array: Column, i: Column | int) -> Column:
    return F.get(array, i if isinstance(i, Column) else F.lit(i))


def node_table(rows: DataFrame, dims: int, target: float) -> DataFrame:
    """Per (group, node): rows, the attribute to cut and where (no cuts: a cell)."""
    quantiles = [i / FAN for i in range(1, FAN)]
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i in range(dims):
        z = _at(F.col("_z"), i)
        aggs += [F.min(z).alias(f"_lo{i}"), F.max(z).alias(f"_hi{i}"), F.percentile_approx(z, quantiles, 512).alias(f"_p{i}")]
    s = rows.groupBy("_gid", "_node").agg(*aggs)
    none = F.array().cast("array<double>")
    if not dims:
        return s.select("_gid", "_node", "_n", F.lit(0).alias("_dim"), none.alias("_cuts"))
    widest = F.array_max(F.array(*[F.struct(F.coalesce(F.col(f"_hi{i}") - F.col(f"_lo{i}"), F.lit(0.0)).alias("s"),
                                            F.lit(i).alias("i")) for i in range(dims)]))
    s = s.withColumn("_wide", widest)
    pick = lambda name: _at(F.array(*[F.col(f"_{name}{i}") for i in range(dims)]), F.col("_wide")["i"])
    s = s.select("_gid", "_node", "_n", F.col("_wide")["i"].alias("_dim"), F.col("_wide")["s"].alias("_spread"),
                 pick("lo").alias("_lo"), pick("hi").alias("_hi"), pick("p").alias("_p"))
    # as many children as needed, a power of two; every so many of the quantiles are cuts
    children = F.least(F.lit(FAN), F.pow(F.lit(2.0), F.ceil(F.log2(F.col("_n") / F.lit(float(target)))))).cast("int")
    some = F.filter("_p", lambda x, i: (i + 1) % (F.lit(FAN) / children).cast("int") == 0)
    # a cut just below the median parts a value that most rows share from the smaller ones
    cuts = F.concat(some, F.array(_at(F.col("_p"), FAN // 2 - 1) - F.lit(1e-12)))
    # a child holds what is over its lower cut and at most its upper one: no cut parts anything below the least or at the greatest
    cuts = F.array_sort(F.array_distinct(F.filter(cuts, lambda c: (c >= F.col("_lo")) & (c < F.col("_hi")))))
    cuts = F.when(F.size(cuts) > 0, cuts).otherwise(F.array("_lo"))
    cuts = F.when((F.col("_n") > F.lit(2.0 * target)) & (F.col("_spread") > 0), cuts).otherwise(none)
    return s.select("_gid", "_node", "_n", "_dim", cuts.alias("_cuts"))


def below(cuts: Column, x: Column) -> Column:
    """The child that holds ``x``."""
    return F.size(F.filter(cuts, lambda c: c < x))


def child_id(node: Column, child: Column) -> Column:
    """A hash of the path; nodes of one hash would share cells, not results."""
    return F.xxhash64(node, child)


@dataclass
class Partition:
    """``levels``: per level the nodes that are cut, those with many rows and the others; ``cells``: one row per cell with its
    rows as an array."""
    levels: list[tuple[DataFrame, DataFrame]]
    cells: DataFrame


def _level(nodes: DataFrame, total: int) -> tuple[DataFrame, DataFrame]:
    cut = nodes.where(F.size("_cuts") > 0)
    named = lambda df, p: df.select(*[F.col(f"_{c}").alias(f"_{p}_{c}") for c in ("gid", "node", "dim", "cuts")])
    many = F.col("_n") > total / DEFAULT_SHARE
    return named(cut.where(many), "h"), named(cut.where(~many), "c")


def build(rows: DataFrame, dims: int, target: float, payload: list[str]) -> Partition:
    """Cut the groups of ``rows`` (``_gid``, ``_z``, payload) into cells of at most 2 ``target`` rows."""
    levels, done = [], []
    active = rows.withColumn("_node", F.lit(1).cast("bigint"))
    while True:
        nodes = materialize(node_table(active, dims, target), "knn-nodes")
        total = nodes.agg(F.sum("_n"), F.count_if(F.size("_cuts") > 0)).first()
        if not total[1]:
            done.append(active)
            break
        named = nodes.withColumnsRenamed({"_gid": "_ng", "_node": "_nn"})
        j = join_split_hot(active, named, ["_gid", "_node"], ["_ng", "_nn"], "_n", total[0])
        child = child_id(F.col("_node"), below(F.col("_cuts"), _at(F.col("_z"), F.col("_dim"))))
        j = j.withColumn("_node", F.when(F.size("_cuts") > 0, child).otherwise(F.col("_node")))
        j = materialize(j.select("_gid", "_node", "_z", *payload, (F.size("_cuts") > 0).alias("_on")), "knn-level")
        levels.append(_level(nodes, total[0]))
        done.append(j.where(~F.col("_on")).drop("_on"))
        active = j.where("_on").drop("_on")
    out = reduce(lambda a, b: a.unionByName(b), [d.select("_gid", "_node", *payload) for d in done])
    cells = out.groupBy("_gid", "_node").agg(F.collect_list(F.struct(*payload)).alias("_rows"))
    return Partition(levels, materialize(cells, "knn-cells"))


def descend(q: DataFrame, levels: list[tuple[DataFrame, DataFrame]], dims: int, ball: bool) -> DataFrame:
    """Take query rows (``_gid``, ``_z``, and ``_r2`` for a ball) down to the cells: ``_node`` is added.

    A ball takes every child that it meets, rows multiply. A NULL coordinate meets all children.
    """
    keep = q.columns
    q = q.withColumn("_node", F.lit(1).cast("bigint"))
    if ball:
        q = q.withColumn("_a", F.array_repeat(F.lit(0.0), dims)).withColumn("_r", F.sqrt("_r2") * (1 + SLACK) + SLACK)
    for hot, cold in levels:
        columns = q.columns
        q = q.join(F.broadcast(hot), (F.col("_gid") == F.col("_h_gid")) & (F.col("_node") == F.col("_h_node")), "left")
        # rows of hot nodes are spread over the shuffle and match nothing
        key = F.when(F.col("_h_gid").isNull(), F.col("_gid")).otherwise(F.xxhash64("_pid", "_node"))
        q = q.withColumn("_jg", key)
        q = q.join(cold, (F.col("_jg") == F.col("_c_gid")) & (F.col("_node") == F.col("_c_node")) & F.col("_h_gid").isNull(), "left")
        q = q.select(*columns, F.coalesce("_h_dim", "_c_dim").alias("_dim"), F.coalesce("_h_cuts", "_c_cuts").alias("_cuts"))
        z, cuts = _at(F.col("_z"), F.col("_dim")), F.col("_cuts")
        here = F.col("_node")
        if not ball:
            q = q.withColumn("_node", F.when(cuts.isNotNull(), child_id(here, below(cuts, z))).otherwise(here)).select(*columns)
            continue
        least = F.when(z.isNull(), F.lit(0)).otherwise(below(cuts, z - F.col("_r")))
        most = F.when(z.isNull(), F.size(cuts)).otherwise(below(cuts, z + F.col("_r")))
        to = F.when(cuts.isNotNull(), F.sequence(least, most)).otherwise(F.array(F.lit(-1)))
        q = q.select("*", F.explode(to).alias("_c"))
        i = F.col("_c")
        off = F.greatest(F.lit(0.0), F.when(i > 0, _at(cuts, F.greatest(i - 1, F.lit(0))) - z),
                         F.when(i < F.size(cuts), z - _at(cuts, i)))
        q = q.withColumn("_a", F.when((i < 0) | z.isNull(), F.col("_a")).otherwise(
            F.transform("_a", lambda a, d: F.when(d == F.col("_dim"), F.greatest(a, off * off)).otherwise(a))))
        q = q.where(F.aggregate("_a", F.lit(0.0), lambda s, a: s + a) <= F.col("_r") * F.col("_r"))
        q = q.withColumn("_node", F.when(i < 0, here).otherwise(child_id(here, i))).select(*columns)
    return q.select(*keep, "_node")


# ---- search

def pairs(probes: DataFrame, cells: DataFrame, discrete: list[str], continuous: list[str], stats: dict) -> DataFrame:
    """Query rows (``_pid``, ``_mask``, attributes) with the rows of their cells that agree exactly on the mask's attributes.

    A cell is one row with a short array. Where very many points ask one cell (a big clump), the adaptive planner splits
    that key's queries over tasks.
    """
    attrs = discrete + continuous
    j = probes.join(cells, ["_gid", "_node"]).select(*probes.columns, F.explode("_rows").alias("_q"))
    q = F.col("_q")
    agree = reduce(lambda a, b: a + b, [F.when(F.col(d).eqNullSafe(q[d]), F.lit(1 << i)).otherwise(F.lit(0))
                                        for i, d in enumerate(discrete)], F.lit(0))
    j = j.where((F.col("_pid") != q["_pid"]) & (q["_mask"] == F.col("_mask")) & (agree == F.col("_mask")))
    d2 = distance2({a: F.col(a) for a in attrs}, {a: q[a] for a in attrs}, discrete, continuous, stats)
    extra = [c for c in ("_ub",) if c in probes.columns]
    return j.select(F.col("_pid").alias("p_pid"), F.col("_w").alias("p_w"), q["_pid"].alias("q_pid"), q["_w"].alias("q_w"),
                    *[q[a].alias(f"q_{a}") for a in attrs], d2.alias("_d2"), *extra)


def exact_search(pts: DataFrame, pending: DataFrame, discrete: list[str], continuous: list[str], stats: dict,
                 k_eff: int, target: float | None = None, clump_limit: int | None = None):
    """Neighbour entries (excluding own copies) of the ``pending`` points, the number of passes and the work done."""
    attrs = discrete + continuous
    dims, n_masks = len(continuous), 1 << len(discrete)
    if pending.isEmpty():
        return _no_entries(pts, attrs), 0, None
    target = max(float(target or 0) or 32.0, 2.0 * (k_eff + 1))
    payload = ["_pid", "_mask", "_w", *attrs]
    rows = materialize(strata_rows(pts, discrete, continuous, max(k_eff + 1, clump_limit or 0)), "knn-strata")
    part = build(rows, dims, target, payload)
    lean = ["_gid", "_mask", "_pid", "_w", "_z", *attrs]

    # a bound from the point's own cells
    own = strata(pending, discrete).withColumn("_gid", group_id(discrete, null_bits(F.col("_z"), dims))).select(*lean)
    own = descend(own, part.levels, dims, ball=False)
    near = pairs(own, part.cells, discrete, continuous, stats)
    w = Window.partitionBy("p_pid").orderBy("_d2")
    need = F.lit(k_eff) - (F.col("p_w") - 1)
    near = near.select("p_pid", "p_w", "_d2").withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k_eff)
    bound = near.where(F.col("_rn") == need).select(F.col("p_pid").alias("_pid"), F.col("_d2").alias("_ub"))
    bound = materialize(pending.join(bound, "_pid", "left"), "knn-bounds")
    # too few in the own cells: any k + 1 points bound the distance too
    some = pts.orderBy("_pid").limit(k_eff + 1).select(F.col("_pid").alias("q_pid"), *[F.col(a).alias(f"q_{a}") for a in attrs])
    far = bound.where("_ub is null").drop("_ub").join(F.broadcast(some), F.col("_pid") != F.col("q_pid"))
    far = far.groupBy("_pid").agg(F.max(distance2({a: F.col(a) for a in attrs}, {a: F.col(f"q_{a}") for a in attrs}, discrete,
                                                  continuous, stats)).alias("_ub"))
    far = bound.where("_ub is null").drop("_ub").join(far, "_pid")
    bounds = bound.where("_ub is not null").unionByName(far)

    # every cell that the ball meets
    patterns = [0]
    if any(stats[f"nulls_{c}"] for c in continuous):
        patterns = [r[0] for r in pts.select(null_bits(F.col("_z"), dims).alias("n")).distinct().collect()]
    q = strata(bounds, discrete).select("*", F.explode(F.array(*[F.lit(p) for p in sorted(patterns)])).alias("_np"))
    apart = F.bit_count(null_bits(F.col("_z"), dims).bitwiseXOR(F.col("_np")))
    rest = F.col("_ub") - (F.lit(len(discrete)) - F.bit_count("_mask")) - apart
    q = q.withColumn("_r2", rest).where(F.col("_r2") >= -SLACK).withColumn("_r2", F.greatest("_r2", F.lit(0.0)))
    q = q.withColumn("_gid", group_id(discrete, F.col("_np"))).select(*lean, "_ub", "_r2")
    probes = descend(q, part.levels, dims, ball=True)
    cand = pairs(probes, part.cells, discrete, continuous, stats).where(F.col("_d2") <= F.col("_ub")).drop("_ub")
    sizes = part.cells.select("_gid", "_node", F.size("_rows").alias("_n"))
    work = probes.select("_pid", "_gid", "_node").unionByName(own.select("_pid", "_gid", "_node")).join(
        sizes, ["_gid", "_node"]).groupBy("_pid").agg(F.sum("_n").alias("candidates"))
    return materialize(top_k(cand, attrs, k_eff), "knn-entries"), 2 + len(part.levels), work


def top_k(cand: DataFrame, attrs: list[str], k_eff: int, keep: list[str] | None = None) -> DataFrame:
    """Per point: the first k slots of its candidates ordered by (d2, attributes), weights expanded.

    ``cand`` has p_pid, p_w, q_w, q_<attr> and _d2, each neighbour once.
    """
    order = ["_d2", *[f"q_{a}" for a in attrs]]
    w = Window.partitionBy("p_pid").orderBy(*order)
    # every neighbour fills a slot at least: more than k rows are never needed, and the limit works map-side
    r = cand.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k_eff)
    before = F.coalesce(F.sum("q_w").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    r = r.withColumn("_before", F.col("p_w") - 1 + before).where(F.col("_before") < k_eff)
    return r.select(
        F.col("p_pid").alias("_pid"), F.col("_before").cast("bigint").alias("_slot"),
        F.least(F.col("q_w"), F.lit(k_eff) - F.col("_before")).cast("bigint").alias("_take"),
        *[F.col(f"q_{a}").alias(f"nb_{a}") for a in attrs], "_d2", *(keep or []))


def row_neighbours(rows: DataFrame, id_col: str, res: KnnResult, discrete: list[str],
                   continuous: list[str]) -> DataFrame:
    """Per input row: (id, slot 0..k-1, neighbour attributes, d2)."""
    attrs = discrete + continuous
    rp = attach_points(rows.select(id_col, *attrs), res.points.select("_pid", *attrs, "_w"), attrs, res.n_rows)
    j = rp.join(res.entries, "_pid")
    return j.select(id_col, F.explode(F.sequence(F.col("_slot"), F.col("_slot") + F.col("_take") - 1)).alias("slot"),
                    *[F.col(f"nb_{a}") for a in attrs], F.col("_d2").alias("d2"))


def attach_points(rows: DataFrame, points: DataFrame, attrs: list[str], n_rows: int) -> DataFrame:
    """Join rows to their point (one row per attribute vector, weight ``_w``) on the attributes.

    A point with very many copies is a hot key: see ``operators.skew``.
    """
    pt = points.select(*[F.col(a).alias(f"_pt_{a}") for a in attrs], *[c for c in points.columns if c not in attrs])
    return join_split_hot(rows, pt, attrs, [f"_pt_{a}" for a in attrs], "_w", n_rows)


def neighbour_arrays(res: KnnResult, attrs: list[str]) -> DataFrame:
    """One row per point: its neighbour list as an array of (slot, take, attributes), at most k+1 long."""
    e = res.entries
    s = F.struct(F.col("_slot").alias("slot"), F.col("_take").alias("take"),
                 *[F.col(f"nb_{a}").alias(a) for a in attrs])
    return e.groupBy("_pid").agg(F.array_sort(F.collect_list(s)).alias("_nbs"))
