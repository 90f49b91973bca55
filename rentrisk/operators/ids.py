"""Random dense ids 1..n without a single-partition window.

``ROW_NUMBER() OVER (ORDER BY rand())`` moves every row into one task. Here the
random order is a 60-bit hash of (seed, key columns), which is uniform, so the
hash's top bits split the rows into equally sized, ordered buckets without any
sampling:

1. identical rows are collapsed to (row, multiplicity) with a map-side-combined
   aggregate, so a row repeated a billion times costs one row from here on;
2. bucket sizes (at most ``num_buckets`` rows) are prefix-summed into offsets and
   broadcast -- a table whose size is fixed by the parameter, not by the data;
3. inside each bucket a window ranks the distinct rows by (hash, columns) and a
   running sum of multiplicities gives each row its first id;
4. multiplicities expand back to rows; rows repeated more than ``chunk`` times are
   split into chunks that are re-partitioned first, so no task expands a hot row alone.

Everything is a pure function of the data, so a lost executor recomputes the
same ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rentrisk.functions.hashing import hash60

HASH_BITS = 60


def _pow2_at_least(n: int) -> int:
    p = 1
    while p < n:
        p *= 2
    return p


def default_buckets(df: DataFrame) -> int:
    sp = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return min(_pow2_at_least(max(64, 4 * sp)), 1 << 20)


def dense_random_id(df: DataFrame, seed, key_cols: list[str] | None = None, id_col: str = "id",
                    distinct_keys: bool = False, num_buckets: int | None = None,
                    chunk: int = 1_000_000) -> DataFrame:
    """Append ``id_col`` = 1..n in the order of ``hash60(seed, keys)``, ties by the columns.

    ``distinct_keys=True`` asserts the key columns identify rows, which skips the
    duplicate-collapsing aggregate (one shuffle fewer).
    """
    cols = list(df.columns)
    keys = list(key_cols or cols)
    nb = _pow2_at_least(num_buckets or default_buckets(df))
    shift = HASH_BITS - (nb.bit_length() - 1)
    t = df.withColumn("_h", hash60(seed, *keys)).withColumn("_b", F.shiftright("_h", shift))
    order_cols = ["_h"] + (keys if distinct_keys else cols)

    if distinct_keys:
        g = t.withColumn("_c", F.lit(1).cast("bigint"))
    else:
        g = t.groupBy("_b", "_h", *cols).agg(F.count(F.lit(1)).alias("_c"))

    sizes = g.groupBy("_b").agg(F.sum("_c").alias("_n"))
    # <= num_buckets rows: a single ordered pass over them is cheap and bounded.
    offsets = sizes.select(
        "_b",
        F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    w = Window.partitionBy("_b").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    ranked = g.withColumn("_before", F.coalesce(F.sum("_c").over(w), F.lit(0)))
    # Left join: an inner join would push an extra null filter into one branch only,
    # and the two branches below could no longer share the shuffle output.
    ranked = (ranked.join(F.broadcast(offsets), "_b", "left")
              .withColumn("_start", F.coalesce("_off", F.lit(0)) + F.col("_before")))

    if distinct_keys:
        return ranked.select(*cols, (F.col("_start") + 1).alias(id_col))

    normal = (ranked.where(F.col("_c") <= chunk)
              .select(*cols, F.explode(F.sequence(F.col("_start") + 1, F.col("_start") + F.col("_c"))).alias(id_col)))
    hot = (ranked.where(F.col("_c") > chunk)
           .withColumn("_k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_c") - 1) / chunk))))
           .repartition("_h", "_k")
           .select(*cols, F.explode(F.sequence(
               F.col("_start") + F.col("_k") * chunk + 1,
               F.col("_start") + F.least((F.col("_k") + 1) * chunk, F.col("_c")))).alias(id_col)))
    return normal.unionByName(hot)
