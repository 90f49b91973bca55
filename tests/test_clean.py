"""Hand fixtures for the cleaning step (one per semantic trap)."""

import datetime as dt

import pytest

from rentrisk.plans.clean import PAYMENT_COLUMNS, clean_payments, rejected_rows
from rentrisk.sources.delimited import RAW_SCHEMA

AS_OF = dt.date(2019, 3, 26)


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)


def one(spark, dob, pay_date, paid=700, rent=700, as_of=AS_OF, default_dob="19800101"):
    df = clean_payments(raw(spark, [("  Ann ", dob, 1, 2, pay_date, paid, rent)]), as_of=as_of,
                        default_dob=default_dob, seed=3)
    return df.collect()[0]


def test_slash_and_compact_formats(spark):
    r = one(spark, "12/31/1990", "20101231")
    assert (r.age, r.payment_date, r.default_amount, r.name) == (28, dt.date(2010, 12, 31), 0, "Ann")


def test_placeholder_and_future_dob(spark):
    for dob in ["01/01/1900", "20190326", "20990101"]:
        assert one(spark, dob, "20100101").age == 39


def test_amounts(spark):
    assert (one(spark, "19900101", "20100101", -500).payment_amount, ) == (500, )
    assert one(spark, "19900101", "20100101", -500).default_amount == 200
    assert one(spark, "19900101", "20100101", 900).payment_amount == 700
    r = one(spark, "19900101", "20100101", None)
    assert (r.payment_amount, r.default_amount) == (0, 700)


def test_day_overflow_clamps(spark):
    r = one(spark, "02/30/1990", "04/31/2011")
    assert r.payment_date == dt.date(2011, 4, 30)
    # dob 1990-02-28 -> age at 2019-03-26 is 29
    assert r.age == 29


def test_leap_birthday(spark):
    assert one(spark, "02/29/2000", "20010101", as_of=dt.date(2001, 2, 28)).age == 0


def test_iso_weekday(spark):
    assert one(spark, "19900101", "20240101").payment_date_day_of_week == 1
    assert one(spark, "19900101", "20240107").payment_date_day_of_week == 7


@pytest.mark.parametrize("bad", ["13/01/2011", "1/2/2010", "", "201012311", "2010-12-31", None])
def test_bad_dates(spark, bad):
    with pytest.raises(Exception):
        one(spark, "19900101", bad)
    rows = [("a", "19900101", 1, 2, bad, 700, 700), ("b", "19900101", 1, 2, "20100101", 700, 700)]
    df = clean_payments(raw(spark, rows), as_of=AS_OF, mode="permissive", seed=1)
    assert [r.name for r in df.collect()] == ["b"]
    rej = rejected_rows(raw(spark, rows)).collect()
    assert [(r.name, r.reason) for r in rej] == [("a", "payment_date")]


def test_null_ints_read_as_zero(spark):
    df = clean_payments(raw(spark, [("a", "19900101", None, None, "20100101", 100, None)]), as_of=AS_OF, seed=1)
    r = df.collect()[0]
    assert (r.house_id, r.house_zip, r.rent_amount, r.payment_amount, r.default_amount) == (0, 0, 0, 0, 0)


def test_schema_and_dense_ids(spark):
    rows = [(f"n{i % 7}", "19900101", i % 3, 5, "20100101", 700, 700) for i in range(50)]
    df = clean_payments(raw(spark, rows), as_of=AS_OF, seed=9)
    assert df.columns == PAYMENT_COLUMNS
    ids = sorted(r.id for r in df.collect())
    assert ids == list(range(1, 51))
