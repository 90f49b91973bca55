"""Delimited text scan edge cases (Hive-style text)."""

from rentrisk.session import scratch_path
from rentrisk.sources.delimited import read_delimited


def test_delimited_permissive(spark):
    path = scratch_path(spark, "rawtext")
    lines = [
        " Ann ,19900101,1,2,20100101,700,700",       # padding kept for trim later
        "Bob,19900101,x,2,20100101,\\N,700",          # bad int -> NULL, \\N -> NULL
        "Cid,19900101,1",                             # short row -> NULLs
        "Dee,19900101,1,2,20100101,700,700,extra",    # extra field dropped
    ]
    spark.createDataFrame([(s,) for s in lines], "value string").coalesce(1).write.text(path)
    rows = {r.name: r for r in read_delimited(spark, path).collect()}
    assert rows[" Ann "].rent_amount == 700
    assert rows["Bob"].house_id is None and rows["Bob"].payment_amount is None and rows["Bob"].house_zip == 2
    assert rows["Cid"].house_id == 1 and rows["Cid"].payment_date is None and rows["Cid"].rent_amount is None
    assert rows["Dee"].rent_amount == 700
