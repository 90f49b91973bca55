"""Set operations (G1)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_by_first(head: DataFrame, *tail: DataFrame) -> DataFrame:
    """UNION ALL aligned by name to the first frame's columns.

    Extra columns of later frames are dropped, a missing column raises, duplicates
    are kept, and operands are combined in order. (``unionByName`` alone rejects
    extra columns.)
    """
    cols = head.columns
    return reduce(lambda a, b: a.unionByName(b.select(*cols)), tail, head)
