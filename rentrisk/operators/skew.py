"""Joins on a key that may be hot (one key holding a large share of the rows).

The small side has one row per key and knows each key's row count. Keys holding
more than ``total / share`` rows are fewer than ``share`` (the counts sum to
``total``), so they are broadcast and joined map-side; their rows are removed from
the shuffled join of the other keys by a broadcast anti-join before the exchange.
No join task then receives more than ``total / share`` rows of one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_SHARE = 1000


def join_split_hot(big: DataFrame, small: DataFrame, big_keys: list[str], small_keys: list[str],
                   count_col: str, total: int, share: int = DEFAULT_SHARE) -> DataFrame:
    """Inner join of ``big`` with ``small`` (one row per key; null-safe key equality).

    ``small[count_col]`` is the number of ``big`` rows of that key and ``total``
    their sum. Output: big's columns, then small's non-key columns.
    """
    hot_min = max(1, total // share)
    hot = small.where(F.col(count_col) > hot_min)
    cold = small.where(F.col(count_col) <= hot_min)

    def cond(s: DataFrame) -> list[Column]:
        return [big[b].eqNullSafe(s[k]) for b, k in zip(big_keys, small_keys)]

    extra = [c for c in small.columns if c not in small_keys and c not in big.columns]
    out = big.columns + extra
    hot_b = F.broadcast(hot)
    rest = big.join(F.broadcast(hot.select(*small_keys)), cond(hot.select(*small_keys)), "left_anti")
    a = big.join(hot_b, cond(hot_b)).select(*out)
    b = rest.join(cold, cond(cold)).select(*out)
    return a.unionByName(b)
