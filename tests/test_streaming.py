"""The row-wise cleaning on a stream equals the batch cleaning without ids."""

from rentrisk.plans import registry as Q
from rentrisk.session import scratch_path
from rentrisk.sources.delimited import write_delimited
from rentrisk.sources.fixtures import derived_raw
from rentrisk.streaming.clean_stream import start
from tests.conftest import SF001


def test_stream_matches_batch(spark):
    raw_dir = scratch_path(spark, "stream-raw")
    write_delimited(derived_raw(spark, SF001, with_key=False), raw_dir)
    out, ck = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ck")
    q = start(spark, raw_dir, out, ck)
    q.processAllAvailable()
    q.stop()
    got = spark.read.parquet(out)
    batch = Q.payments(spark, SF001, keep_key=False).drop("id")
    assert got.count() == batch.count()
    assert got.exceptAll(batch.select(*got.columns)).count() == 0
