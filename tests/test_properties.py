"""Property tests (hypothesis): date parsing against a Python model, ids are 1..n."""

import calendar
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rentrisk.functions.dates import parse_local_date
from rentrisk.operators.ids import dense_random_id


def model_parse(s):
    """Strict widths; month 1-12, day 1-31, year >= 1; impossible days clamp to month end."""
    if s is None:
        return None
    if "/" in s:
        if len(s) != 10 or s[2] != "/" or s[5] != "/" or not (s[:2] + s[3:5] + s[6:]).isdigit() \
                or not (s[:2] + s[3:5] + s[6:]).isascii():
            return None
        m, d, y = int(s[:2]), int(s[3:5]), int(s[6:])
    else:
        if len(s) != 8 or not s.isdigit() or not s.isascii():
            return None
        y, m, d = int(s[:4]), int(s[4:6]), int(s[6:])
    if y < 1 or not 1 <= m <= 12 or not 1 <= d <= 31:
        return None
    return dt.date(y, m, min(d, calendar.monthrange(y, m)[1]))


digits = st.text(alphabet="0123456789", min_size=1, max_size=3)
slashy = st.builds(lambda a, b, c: f"{a}/{b}/{c}", st.text("0123456789", min_size=1, max_size=3),
                   st.text("0123456789", min_size=1, max_size=3), st.text("0123456789", min_size=3, max_size=5))
compact = st.text(alphabet="0123456789", min_size=6, max_size=10)
near = st.builds(lambda y, m, d: f"{y:04d}{m:02d}{d:02d}", st.integers(0, 9999), st.integers(0, 14), st.integers(0, 33))
near_slash = st.builds(lambda y, m, d: f"{m:02d}/{d:02d}/{y:04d}", st.integers(0, 9999), st.integers(0, 14),
                       st.integers(0, 33))
junk = st.text(alphabet="0123456789/- a", max_size=12)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(slashy, compact, near, near_slash, junk), min_size=50, max_size=200))
def test_parse_matches_model(spark, strings):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(strings)], "i int, s string")
    got = {r.i: r.d for r in df.select("i", parse_local_date("s").alias("d")).collect()}
    for i, s in enumerate(strings):
        assert got[i] == model_parse(s), s


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["a", "b", None])), min_size=1, max_size=120),
       st.integers(0, 1000), st.integers(1, 5))
def test_ids_are_dense(spark, rows, seed, chunk):
    df = spark.createDataFrame(rows, "x int, y string")
    ids = sorted(r.id for r in dense_random_id(df, seed, chunk=chunk, num_buckets=4).collect())
    assert ids == list(range(1, len(rows) + 1))
