"""Flow 1: raw delimited rows -> typed ``payment`` rows.

The reference maps each row through a JVM lambda; here every field is a column
expression, so the whole transform is one code-generated stage and the scan keeps
column pruning.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentrisk.functions.amounts import default_amount, payment_amount
from rentrisk.functions.dates import age_years, clean_dob, date_parts, parse_local_date, require_date
from rentrisk.operators.ids import dense_random_id
from rentrisk.sources.fixtures import RAW_COLUMNS

PAYMENT_COLUMNS = [
    "id", "name", "age", "house_id", "house_zip", "payment_date",
    "payment_date_year", "payment_date_month", "payment_date_day_of_week", "payment_date_day_of_month",
    "payment_amount", "rent_amount", "default_amount",
]

# Fixed defaults of the reference's submit script.
DEFAULT_DOB = "19800101"
DEFAULT_AS_OF = _dt.date(2019, 3, 26)


def trim_raw(raw: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Trim spaces of name, dob and payment_date; keep the rest as typed."""
    return raw.select(
        F.trim("name").alias("name"), F.trim("dob").alias("dob"), "house_id", "house_zip",
        F.trim("payment_date").alias("payment_date"), "payment_amount", "rent_amount", *(extra or []))


def _typed(t: DataFrame, default_dob: str, as_of: _dt.date, failfast: bool, extra: list[str]) -> DataFrame:
    dob = clean_dob("dob", default_dob, as_of, failfast=failfast)
    pay = parse_local_date("payment_date")
    if failfast:
        pay = require_date(pay, "payment_date", "payment_date")
    # Primitive int reads of NULL in the reference yield 0.
    rent = F.coalesce(F.col("rent_amount"), F.lit(0))
    paid = payment_amount("payment_amount", rent)
    s = t.select(
        "name", dob.alias("_dob"), F.coalesce("house_id", F.lit(0)).alias("house_id"),
        F.coalesce("house_zip", F.lit(0)).alias("house_zip"), pay.alias("payment_date"),
        paid.alias("payment_amount"), rent.alias("rent_amount"), *extra)
    return s.select(
        "name", age_years("_dob", as_of).alias("age"), "house_id", "house_zip", "payment_date",
        *date_parts("payment_date", "payment_date"),
        "payment_amount", "rent_amount",
        default_amount("rent_amount", "payment_amount").alias("default_amount"), *extra)


def clean_payments(raw: DataFrame, *, as_of: _dt.date = DEFAULT_AS_OF, default_dob: str = DEFAULT_DOB,
                   seed: int = 0, key_cols: list[str] | None = None, distinct_keys: bool = False,
                   mode: str = "failfast", keep_key: bool = False) -> DataFrame:
    """Typed payment rows with a reproducible random dense id.

    ``mode='failfast'`` raises on an unparseable date (reference behaviour);
    ``mode='permissive'`` drops such rows (see :func:`rejected_rows`).
    ``key_cols`` are hashed for the id order (default: every output column).
    """
    if mode not in ("failfast", "permissive"):
        raise ValueError("mode must be 'failfast' or 'permissive'")
    extra = [c for c in (key_cols or []) if c not in RAW_COLUMNS]
    t = trim_raw(raw, extra)
    if mode == "permissive":
        t = t.where(_dates_ok(default_dob))
    typed = _typed(t, default_dob, as_of, mode == "failfast", extra)
    # The id order is a hash of the given key, or of every typed column.
    with_id = dense_random_id(typed, seed, key_cols, distinct_keys=distinct_keys)
    out = PAYMENT_COLUMNS + (extra if keep_key else [])
    return with_id.select(*out)


def _dates_ok(default_dob: str) -> Column:
    return (parse_local_date("dob").isNotNull() & parse_local_date("payment_date").isNotNull()
            & parse_local_date(F.lit(default_dob)).isNotNull())


def rejected_rows(raw: DataFrame, default_dob: str = DEFAULT_DOB) -> DataFrame:
    """Rows the permissive mode drops, with the reason."""
    t = trim_raw(raw, [c for c in raw.columns if c not in RAW_COLUMNS])
    bad_dob = parse_local_date("dob").isNull()
    bad_pay = parse_local_date("payment_date").isNull()
    return (t.where(~_dates_ok(default_dob))
            .withColumn("reason", F.when(bad_dob & bad_pay, "dob,payment_date")
                        .when(bad_dob, "dob").when(bad_pay, "payment_date").otherwise("default_dob")))
