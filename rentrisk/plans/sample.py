"""Flow 2: payment rows below the id cut -> ``train`` rows with SMOTE rows added.

The only driver round trips are two small aggregates: the class counts (for the
size multiplier) and the min/range of the SMOTE attributes (for scaling).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentrisk.operators import rows as R
from rentrisk.operators import split as S
from rentrisk.operators.ids import dense_random_id
from rentrisk.operators.setops import union_by_first
from rentrisk.operators.smote import SmoteSpec, synthetic_rows
from rentrisk.session import materialize

DISCRETE = ["name", "house_id", "house_zip"]
CONTINUOUS = ["age", "rent_amount", "default_amount"]
TRAIN_COLUMNS = ["id", "name", "age", "house_id", "house_zip", "rent_amount", "default_amount", "is_syn"]


class NoMinorityError(ValueError):
    pass


def multiplier_of(train: DataFrame, strict: bool = False) -> int | None:
    row = S.size_multiplier(S.class_counts(train)).collect()[0]
    if row["multiplier"] is None and strict:
        raise NoMinorityError("no minority rows: the size multiplier is undefined")
    return row["multiplier"]


def smote_sample(train: DataFrame) -> DataFrame:
    return R.widen(S.minority(train).select("id", *DISCRETE, *CONTINUOUS), ["house_id", "house_zip"], CONTINUOUS)


def synthetic_train_rows(train: DataFrame, k: int, seed: int, mode: str = "exact",
                         multiplier: int | None = None, **lsh) -> DataFrame:
    """Synthetic rows in train-table shape, keyed by (parent id, copy)."""
    m = multiplier if multiplier is not None else multiplier_of(train)
    spec = SmoteSpec(DISCRETE, CONTINUOUS, k, m or 0, seed)
    # about one row in a hundred: written once, read by every pass of the neighbour search
    sample = materialize(smote_sample(train), "minority")
    res = None
    if mode == "lsh":
        from rentrisk.operators.lsh import knn_lsh
        res = knn_lsh(sample.select(*DISCRETE, *CONTINUOUS), DISCRETE, CONTINUOUS, k, seed=seed, **lsh)
    elif mode != "exact":
        raise ValueError("mode must be 'exact' or 'lsh'")
    syn = synthetic_rows(sample, spec, res)
    return syn.select(
        F.col("parent_id").alias("_src"), F.col("copy").cast("int").alias("_copy"), "name",
        R.truncate_to_int("age").alias("age"), R.truncate_to_int("house_id").alias("house_id"),
        R.truncate_to_int("house_zip").alias("house_zip"), R.truncate_to_int("rent_amount").alias("rent_amount"),
        R.truncate_to_int("default_amount").alias("default_amount"), F.lit(True).alias("is_syn"))


def sample_train(payment: DataFrame, cut: int, *, k: int = 10, seed: int = 0, mode: str = "exact",
                 id_seed: int | None = None, with_parent: bool = False, **lsh) -> DataFrame:
    """Original train rows plus synthetic minority rows, renumbered 1..n in random order.

    ``with_parent`` adds ``parent_id``, the payment id of the row itself or of the row that a synthetic one was made from:
    folds by it (``model.add_folds(key="parent_id")``) keep a row and its synthetic relatives together (T9).
    """
    train = S.train_rows(payment, cut)
    orig = train.select(F.col("id").alias("_src"), F.lit(0).alias("_copy"), *TRAIN_COLUMNS[1:])
    syn = synthetic_train_rows(train, k, seed, mode, **lsh)
    # written once: the numbering reads its rows twice, for the sizes of its buckets and for the ranks in them
    both = materialize(union_by_first(orig, syn), "train-rows")
    ided = dense_random_id(both, seed if id_seed is None else id_seed, ["_src", "_copy"], distinct_keys=True)
    return ided.select(*TRAIN_COLUMNS, *[F.col("_src").alias("parent_id")] * with_parent)
