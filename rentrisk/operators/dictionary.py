"""A distributed dictionary of category values (K1, K2 without a driver vocabulary).

``StringIndexer`` keeps every value on the driver, and one-hot widths follow the greatest number, not the values there are. Here the
observed values of all columns are counted in one aggregate, ordered (column, count descending, value) by a range partitioning, and numbered
1 + the rows before: inside a partition by a window, between partitions by the partitions' sizes, of which there is one row each. So
a slot is a number of its own for every (column, value), without gaps and without collisions, and the slots of one
column follow each other in the reference's order of frequency, ties by value.

NULL is no value: it gets no slot, as an unseen value. Values are kept as text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rentrisk.operators.skew import join_split_hot
from rentrisk.session import materialize


def build(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, value, n, slot``: one row per observed value, slots 0..number of values - 1."""
    pairs = F.array(*[F.struct(F.lit(i).alias("place"), F.col(c).cast("string").alias("value")) for i, c in enumerate(columns)])
    counts = (df.select(F.explode(pairs).alias("p")).select("p.place", "p.value").where("value is not null")
              .groupBy("place", "value").agg(F.count(F.lit(1)).alias("n")))
    order = ["place", F.desc("n"), "value"]
    # the partition's number is written with the row: sampling twice could cut elsewhere
    ranged = materialize(counts.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "dictionary")
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("_part").alias("_of"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_off"))
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    # one row per partition of the range partitioning: a broadcast that grows with the partitions, not with the values
    numbered = ranged.withColumn("_rank", rank).join(F.broadcast(offsets), F.col("_part") == F.col("_of"))
    names = F.array(*[F.lit(c) for c in columns])
    return numbered.select(F.get(names, F.col("place")).alias("column"), "value", "n", (F.col("_off") + F.col("_rank") - 1).alias("slot"))


def encode(df: DataFrame, dictionary: DataFrame, columns: list[str], suffix: str = "_slot") -> DataFrame:
    """``df`` with a slot per column; NULL for values that the dictionary does not hold.

    A value that many rows of ``df`` share is joined from a broadcast of fewer than a thousand such values.
    """
    total, names = df.count(), df.columns
    for c in columns:
        own = dictionary.where(F.col("column") == c).select("value", "slot")
        asked = df.groupBy(F.col(c).cast("string").alias("_asked")).agg(F.count(F.lit(1)).alias("_count"))
        known = asked.join(own, F.col("_asked") == F.col("value"), "left").select(
            "_asked", "_count", F.col("slot").alias(f"{c}{suffix}"))
        df = join_split_hot(df.withColumn("_key", F.col(c).cast("string")), known, ["_key"], ["_asked"], "_count", total)
        names = [*names, f"{c}{suffix}"]
        df = df.select(*names)
    return df


def one_hot_entries(columns: list[str], suffix: str = "_slot", first: int = 0):
    """Array of (slot, 1) of the encoded columns, moved up by ``first``; unseen values have none. For ``operators.gram``."""
    from rentrisk.operators.gram import ENTRY, entry
    slots = F.array(*[F.col(f"{c}{suffix}") for c in columns])
    return F.transform(F.filter(slots, lambda s: s.isNotNull()), lambda s: entry(s + first, F.lit(1.0))).cast(ENTRY)
