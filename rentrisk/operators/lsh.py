"""Approximate kNN by composite locality-sensitive hashes (L4, scale mode).

A bucket holds points that agree on some of the discrete attributes (every subset of them has its own buckets, as in the exact
search) and whose scaled continuous attributes share a composite hash. The hash of a table is a list of random projections
cut into pieces, and it is as long as a bucket needs: a bucket of more than ``bucket_size`` points is split by one more projection,
cut into 2 to 8 pieces of the bucket's own spread at a random offset. So the number of projections grows with the logarithm of the points,
and a dense spot or a far outlier gets more of them. A group that fits into one bucket needs no table; others have ``num_tables``, with
projections of their own, so that neighbours parted by a border in one table meet in another. Directions and offsets are md5 numbers of (seed,
table, place in the list): the same everywhere, also in SQL.

Points with identical continuous values, which no projection parts, are cut to the first k + 1 of them, which loses nothing (see
``rentrisk.operators.knn``), so a bucket that cannot be split is small. Candidates are ranked by their true distance. A point with fewer than
k candidates is answered by the exact search; nothing else is. Identical rows are collapsed to weighted points first.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentrisk.operators.knn import (KnnResult, _no_entries, exact_search, group_id, pairs, prepare_points, self_entries,
                                    strata, top_k)
from rentrisk.operators.skew import join_split_hot
from rentrisk.session import materialize

#: A NULL coordinate is projected from the middle.
MIDDLE = 0.5


def unit(seed: int, *parts) -> float:
    """Uniform number in [0, 1) from 32 bits of an md5."""
    return int(hashlib.md5(":".join(map(str, (seed, *parts))).encode()).hexdigest()[:8], 16) / 4294967296.0


def direction(seed: int, table: int, level: int, dims: int) -> tuple[list[float], float]:
    """A projection's weights, each in [-1, 1), and the offset of its pieces."""
    return [2 * unit(seed, table, level, c) - 1 for c in range(dims)], unit(seed, table, level, "offset")


def size_of(k_eff: int, bucket_size: int | None) -> int:
    return bucket_size or max(64, 6 * k_eff)


def fan_out(n: Column, size: int) -> Column:
    return F.when(n > 4 * size, 8).when(n > 2 * size, 4).otherwise(2)


def _by_table(tables: int, value) -> Column:
    """``value(table)`` of the row's table."""
    return reduce(lambda rest, t: F.when(F.col("_t") == t, value(t)).otherwise(rest), range(1, tables), value(0))


def projected(seed: int, tables: int, level: int, dims: int) -> Column:
    def dot(t: int) -> Column:
        terms = [F.lit(a) * F.get(F.col("_z"), F.lit(i)) for i, a in enumerate(direction(seed, t, level, dims)[0])]
        return reduce(lambda x, y: x + y, terms) if terms else F.lit(0.0)
    return _by_table(tables, dot)


def buckets(rows: DataFrame, dims: int, size: int, tables: int, seed: int, bucket_length: float | None) -> DataFrame:
    """``_node`` of every row in every table: rows of one (``_gid``, ``_node``) share a bucket.

    ``rows`` has ``_gid``, ``_z`` and ``_data``; only rows with ``_data`` count for a bucket's size and spread.
    """
    keep = rows.columns
    done = []
    sizes = rows.groupBy(F.col("_gid").alias("_g")).agg(F.count_if("_data").alias("_n"), F.count(F.lit(1)).alias("_all"))
    sizes = materialize(sizes, "lsh-groups")
    total = sizes.agg(F.sum("_all")).first()[0] or 0
    j = join_split_hot(rows, sizes, ["_gid"], ["_g"], "_all", total)
    table = F.when(F.col("_n") > size, F.sequence(F.lit(0), F.lit(tables - 1))).otherwise(F.array(F.lit(0)))
    j = j.select(*keep, (F.col("_n") > size).alias("_over"), F.explode(table).alias("_t"))
    node = F.col("_t").cast("bigint")
    if bucket_length:
        # a first hash of a width that the caller chose
        x, offset = projected(seed, tables, -1, dims), _by_table(tables, lambda t: F.lit(direction(seed, t, -1, dims)[1]))
        piece = F.floor(x / F.lit(float(bucket_length)) + offset)
        node = F.when(F.col("_over"), F.xxhash64("_t", piece)).otherwise(node)
    j = materialize(j.withColumn("_node", node), "lsh-tables")
    level = 0
    while True:
        done.append(j.where(~F.col("_over")).select(*keep, "_node"))
        active = j.where("_over").withColumn("_x", projected(seed, tables, level, dims))
        held = F.when(F.col("_data"), F.col("_x"))
        stats = active.groupBy(F.col("_gid").alias("_g"), F.col("_node").alias("_b")).agg(
            F.count_if("_data").alias("_n"), F.min(held).alias("_lo"), F.max(held).alias("_hi"), F.count(F.lit(1)).alias("_all"))
        stats = materialize(stats, "lsh-buckets")
        total, cut = stats.agg(F.sum("_all"), F.count_if((F.col("_n") > size) & (F.col("_hi") > F.col("_lo")))).first()
        if not cut:
            done.append(active.select(*keep, "_node"))
            return reduce(lambda a, b: a.unionByName(b), done)
        j = join_split_hot(active.drop("_over"), stats, ["_gid", "_node"], ["_g", "_b"], "_all", total)
        offset = _by_table(tables, lambda t: F.lit(direction(seed, t, level, dims)[1]))
        # a query alone in a bucket without data has no spread to be cut by
        piece = F.floor(fan_out(F.col("_n"), size) * (F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) + offset)
        over = F.col("_n") > size
        j = j.withColumn("_node", F.when(over & (F.col("_hi") > F.col("_lo")), F.xxhash64("_node", piece)).otherwise(F.col("_node")))
        j = materialize(j.select(*keep, "_t", "_node", over.alias("_over")), "lsh-level")
        level += 1


def knn_lsh(rows: DataFrame, discrete: list[str], continuous: list[str], k: int,
            bucket_length: float | None = None, num_tables: int = 2, seed: int = 0,
            bucket_size: int | None = None) -> KnnResult:
    """Approximate neighbours. ``bucket_length``: width, in scaled units, of a first hash of every table (none by default);
    ``bucket_size``: most points of a bucket (6 k and at least 64 by default)."""
    attrs = discrete + continuous
    pts, stats, n, k_eff = prepare_points(rows, discrete, continuous, k)
    if k_eff == 0:
        return KnnResult(pts, _no_entries(pts, attrs), 0, n, 0)
    pending = pts.where(F.col("_w") - 1 < k_eff)
    x = strata(pts, discrete).withColumn("_z", F.transform("_z", lambda v: F.coalesce(v, F.lit(MIDDLE))))
    x = x.withColumn("_gid", group_id(discrete, F.lit(0)))
    clump = Window.partitionBy("_mask", *[f"_k{i}" for i in range(len(discrete))], *continuous).orderBy(*discrete, "_pid")
    lean = ["_gid", "_mask", "_pid", "_w", "_z", *attrs]
    data = x.withColumn("_rn", F.row_number().over(clump)).where(F.col("_rn") <= k_eff + 1)
    asked = x.where(F.col("_w") - 1 < k_eff)
    both = data.select(*lean, F.lit(True).alias("_data")).unionByName(asked.select(*lean, F.lit(False).alias("_data")))
    placed = buckets(both, len(continuous), size_of(k_eff, bucket_size), num_tables, seed, bucket_length)
    payload = F.struct("_pid", "_mask", "_w", *attrs)
    cells = placed.where("_data").groupBy("_gid", "_node").agg(F.collect_list(payload).alias("_rows"))
    probes = materialize(placed.where(~F.col("_data")).select("_gid", "_node", "_mask", "_pid", "_w", *attrs), "lsh-probes")
    cand = pairs(probes, materialize(cells, "lsh-cells"), discrete, continuous, stats)
    # a pair may meet in several tables: equal rows follow each other in the order of the result
    w = Window.partitionBy("p_pid").orderBy("_d2", *[f"q_{a}" for a in attrs])
    cand = (cand.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k_eff * num_tables)
            .withColumn("_prev", F.lag("q_pid").over(w)).where(F.col("_prev").isNull() | (F.col("_prev") != F.col("q_pid"))))
    entries = materialize(top_k(cand.drop("_rn", "_prev"), attrs, k_eff), "lsh-entries")
    full = entries.groupBy("_pid").agg(F.max(F.col("_slot") + F.col("_take")).alias("_filled")).where(F.col("_filled") >= k_eff)
    rest = materialize(pending.join(full.select("_pid"), "_pid", "left_anti"), "lsh-rest")
    if rest.isEmpty():
        return KnnResult(pts, self_entries(pts, attrs, k_eff).unionByName(entries), k_eff, n, 1)
    exact, rounds, work = exact_search(pts, rest, discrete, continuous, stats, k_eff)
    found = entries.join(rest.select("_pid"), "_pid", "left_anti").unionByName(exact)
    return KnnResult(pts, self_entries(pts, attrs, k_eff).unionByName(found), k_eff, n, 1 + rounds, work)
