"""Payment amount repair."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def payment_amount(paid, rent) -> Column:
    """NULL payment -> 0, otherwise ``min(abs(payment), rent)``.

    The NULL branch is explicit: ``least`` skips NULLs, so
    ``coalesce(least(abs(p), rent), 0)`` would turn an unpaid row into a paid one.
    """
    paid = F.col(paid) if isinstance(paid, str) else paid
    rent = F.col(rent) if isinstance(rent, str) else rent
    return F.when(paid.isNull(), F.lit(0)).otherwise(F.least(F.abs(paid), rent))


def default_amount(rent, paid) -> Column:
    rent = F.col(rent) if isinstance(rent, str) else rent
    paid = F.col(paid) if isinstance(paid, str) else paid
    return rent - paid
