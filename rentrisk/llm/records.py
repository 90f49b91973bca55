"""Token-id records: a framed binary file per shard, and an offset index for shuffled reads.

A record is, all numbers little-endian:

    4 bytes   length n of the body
    4 bytes   masked CRC-32 of those 4 bytes
    n bytes   body: 8 bytes document key, 1 byte flags, then the ids in 2 or 4 bytes each
    4 bytes   masked CRC-32 of the body
    1 byte    a line feed, which Spark's text writer puts after each row

A mask turns the checksum by 15 bits and adds a constant, so that a checksum of data that holds
checksums is no fixed point. Flag 1: the key is null. Flag 2: 4-byte ids.

Documents are sorted by key over all shards (range partitioning), a shard is one task's output in
one file, and Spark writes it, to any store that Spark can write to. The index (Parquet) has a row per
record: shard, place, offset, length, key, number of ids. Readers get files as binary rows and
check every frame; ``read_records`` takes whole shards, ``fetch`` single records through the index.
Shards hold about ``SHARD_BYTES`` of text.

Null text is an empty document: only the end id. Null keys come first; rows of equal keys are ordered by
text, and rows alike in both are alike in their records. A very long text is one record, up to 2 GB. An empty
table gives no files, and reading gives an empty frame. Columns other than key and text are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rentrisk.llm.common import small_batches
from rentrisk.llm.tokens import END, FILE, encode_batches
from rentrisk.session import materialize

SHARD_BYTES = 32 << 20
NULL_KEY, WIDE = 1, 2
HEAD, TAIL, FRAME = 8, 5, 13
BODY_HEAD = 9


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(body: bytes) -> bytes:
    """Without the line feed."""
    head = struct.pack("<I", len(body))
    return head + struct.pack("<I", masked(head)) + body + struct.pack("<I", masked(body))


def unframe(data: bytes | memoryview, at: int) -> tuple[memoryview, int]:
    """(body, offset of the next record); ValueError where a frame is damaged."""
    view = memoryview(data)
    head = bytes(view[at:at + 4])
    if len(head) < 4 or struct.unpack("<I", view[at + 4:at + HEAD])[0] != masked(head):
        raise ValueError(f"damaged record length at byte {at}")
    n = struct.unpack("<I", head)[0]
    body = view[at + HEAD:at + HEAD + n]
    end = at + HEAD + n
    if len(body) < n or struct.unpack("<I", view[end:end + 4])[0] != masked(bytes(body)) or view[end + 4:end + 5] != b"\n":
        raise ValueError(f"damaged record body at byte {at}")
    return body, end + TAIL


def pack_ids(key: int | None, ids: bytes) -> bytes:
    """Body of a record from 32-bit ids."""
    wide = np.frombuffer(ids, "<u4")
    flags = NULL_KEY if key is None else 0
    if len(wide) and wide.max() > 0xFFFF:
        return struct.pack("<qB", key or 0, flags | WIDE) + ids
    return struct.pack("<qB", key or 0, flags) + wide.astype("<u2").tobytes()


def unpack_ids(body: memoryview) -> tuple[int | None, np.ndarray]:
    key, flags = struct.unpack("<qB", body[:BODY_HEAD])
    kind = "<u4" if flags & WIDE else "<u2"
    return None if flags & NULL_KEY else key, np.frombuffer(body[BODY_HEAD:], kind).astype("<u4")


def write_records(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", tokenizer: str = FILE,
                  end: int | None = END, shard_bytes: int = SHARD_BYTES) -> None:
    """Encode, frame and write all rows below ``path``: ``records/shard=N`` and ``index``."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // shard_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = 0
        for b in batches:
            keys = b.column(1).to_pylist()
            out = [frame(pack_ids(k, ids)) for k, ids in zip(keys, encode_batches(b.column(2), tokenizer, end))]
            places = pa.array(range(place, place + b.num_rows), pa.int64())
            place += b.num_rows
            yield pa.RecordBatch.from_arrays([b.column(0), places, pa.array(out, pa.binary())], ["shard", "place", "record"])

    framed = (rows.repartitionByRange(shards, F.col("key").asc_nulls_first())
              .sortWithinPartitions(F.col("key").asc_nulls_first(), "text")
              .select(F.spark_partition_id().alias("shard"), "key", "text")
              .mapInArrow(run, "shard int, place long, record binary")
              # mapInArrow has no order to Spark, and the sort by shard alone that the write would add mixes rows when it spills
              .sortWithinPartitions("shard", "place"))
    # the text writer puts out the bytes of a string as they are
    framed.select("shard", F.col("record").cast("string").alias("value")).write.partitionBy("shard").text(f"{path}/records")
    # the index is what the files hold, read back
    with file_by_file(spark):
        parsed(spark, path).write.parquet(f"{path}/index")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", "part-*")
            .option("recursiveFileLookup", "true").load(f"{path}/records")
            .select(F.regexp_extract("path", r"shard=(\d+)", 1).cast("int").alias("shard"), "content"))


def parsed(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``shard, place, offset, length, key, n_ids, ids_crc32`` (and ``ids``, 32-bit) of every record of every file."""
    schema = "shard int, place long, offset long, length long, key long, n_ids long, ids_crc32 long"
    schema += ", ids binary" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                shard, data = b.column(0)[i].as_py(), b.column(1)[i].as_buffer()
                out, at, place = [], 0, 0
                while at < len(data):
                    body, after = unframe(data, at)
                    key, ids = unpack_ids(body)
                    raw = ids.tobytes()
                    out.append((shard, place, at, after - at, key, len(ids), zlib.crc32(raw)) + (raw,) * with_ids)
                    at, place = after, place + 1
                if out:
                    names = [x.split()[0] for x in schema.split(", ")]
                    types = [pa.int32()] + [pa.int64()] * 6 + [pa.binary()] * with_ids
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return _files(spark, path).mapInArrow(run, schema)


@contextmanager
def file_by_file(spark: SparkSession):
    """Rows that hold whole files go to Python one by one while the block runs what reads them."""
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "1")
    try:
        yield
    finally:
        spark.conf.set(conf, before)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``key, ids`` of all records, parsed into a table in the shared folder."""
    with file_by_file(spark):
        return materialize(parsed(spark, path, True).select("key", "ids"), "records-read")


def fetch(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The records of ``wanted`` (rows ``shard, place``), through the index: only their shards are read."""
    index = spark.read.parquet(f"{path}/index").join(wanted.select("shard", "place").distinct(), ["shard", "place"])
    spots = index.groupBy("shard").agg(F.sort_array(F.collect_list("offset")).alias("offsets"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                data = b.column(1)[i].as_buffer()
                got = [(at, *unpack_ids(unframe(data, at)[0])) for at in b.column(2)[i].as_py()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.column(0)[i].as_py()] * len(got), pa.int32()), pa.array([g[0] for g in got], pa.int64()),
                     pa.array([g[1] for g in got], pa.int64()), pa.array([g[2].tobytes() for g in got], pa.binary())],
                    ["shard", "offset", "key", "ids"])

    files = _files(spark, path).join(spots, "shard").select("shard", "content", "offsets")
    with file_by_file(spark):
        return materialize(files.mapInArrow(run, "shard int, offset long, key long, ids binary"), "records-fetched")


def starts(spark: SparkSession, path: str) -> DataFrame:
    """``key, start, n_ids, ids_crc32`` of all records as the index read them back; ``start`` counts the ids before, in file order."""
    index = spark.read.parquet(f"{path}/index")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # one row per shard
    base = index.groupBy("shard").agg(F.sum("n_ids").alias("_n")).select(
        "shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inner = Window.partitionBy("shard").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (index.withColumn("_in", F.coalesce(F.sum("n_ids").over(inner), F.lit(0))).join(base, "shard")
            .select("key", (F.col("_base") + F.col("_in")).alias("start"), "n_ids", "ids_crc32"))
