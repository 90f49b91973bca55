"""Reproducible pseudo-random numbers from row content.

``rand()`` changes on every run and on every task retry; a hash of a seed and a row
key does not, so ids, folds, SMOTE gaps and neighbour choices are stable under
recomputation after executor loss and can be re-derived in plain SQL
(``md5`` + hex conversion exist in both Spark and DuckDB).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TOKEN = "\\N"
TWO_POW_32 = 4294967296.0


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_string(seed, *cols) -> Column:
    """``seed:v1:v2..`` with NULL rendered as ``\\N`` (concat_ws would skip it)."""
    parts = [F.lit(str(seed))] + [F.coalesce(_c(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.concat_ws(":", *parts)


def hash60(seed, *cols) -> Column:
    """Uniform 60-bit non-negative BIGINT from the first 15 hex digits of md5."""
    return F.conv(F.substring(F.md5(key_string(seed, *cols)), 1, 15), 16, 10).cast("bigint")


def hash32(seed, *cols) -> Column:
    """Uniform 32-bit non-negative BIGINT from the first 8 hex digits of md5."""
    return F.conv(F.substring(F.md5(key_string(seed, *cols)), 1, 8), 16, 10).cast("bigint")


def hash_unit(seed, *cols) -> Column:
    """Uniform double in [0, 1) from 32 hash bits."""
    return hash32(seed, *cols) / F.lit(TWO_POW_32)
