"""Helpers shared by the operators: table access, byte views of Arrow text, 64-bit mixing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: White space of the contracts, as a character class body and as a trim set.
SPACE_CLASS = r"\x20\x09-\x0D"
SPACES = " \t\n\x0b\x0c\r"

#: Text handled by numpy at a time; a temporary array takes eight times as much.
CHUNK_BYTES = 1 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches by rows and bytes: texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def unused(df: DataFrame, prefix: str = "_own_") -> str:
    """A prefix that no column of ``df`` has, for columns of ours beside the user's."""
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def words(text: Column) -> Column:
    """Array of the maximal runs of non-white-space characters; empty for null or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACE_CLASS}]+"))


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def let(value: Column, use) -> Column:
    """Bind ``value`` to a lambda variable: it is computed once however often ``use`` reads it."""
    return F.transform(F.array(value), use)[0]


def scan_array(items: Column, step, kind: str, run: int = 256) -> Column:
    """Array of the values that ``step(at, x)`` gives along ``items``; ``at`` starts at 0.

    ``step`` returns (next at, value); the values are of the SQL type ``kind``. They are gathered in runs,
    so n items cost about n times ``run`` and not n squared.
    """
    def inner(state, x):
        return let(F.struct(*step(state["at"], x)), lambda r: F.struct(
            r["col1"].alias("at"), F.concat(state["out"], F.array(r["col2"].cast(kind))).alias("out")))

    def outer(state, c):
        chunk = F.slice(items, c * run + 1, F.lit(run))
        done = F.aggregate(chunk, F.struct(state["at"].alias("at"), F.array().cast(f"array<{kind}>").alias("out")), inner)
        return let(done, lambda r: F.struct(r["at"].alias("at"), F.concat(state["runs"], F.array(r["out"])).alias("runs")))

    chunks = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / run).cast("int"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{kind}>>").alias("runs"))
    return F.when(F.size(items) > 0, F.flatten(F.aggregate(chunks, start, outer)["runs"])).otherwise(
        F.array().cast(f"array<{kind}>"))


# ---- distributed running numbers

def running_sum(df: DataFrame, group: list[str], key: list[Column], value: Column, name: str,
                buckets: int = 4096, ties: tuple[str, ...] = ()) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the same group that come before.

    The order is (hash bucket of ``key``, ``key``), so that a group with a third of all rows is
    spread over ``buckets`` tasks; only the sums per (group, bucket) are added up in one task per
    group, and those are at most ``buckets`` rows. Rows of one key follow each other, ordered by ``ties``.
    """
    b = df.withColumn("_b", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")).withColumn("_v", value)
    sums = b.groupBy(*group, "_b").agg(F.sum("_v").alias("_s"))
    before = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_b").alias("_bb"),
                       F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy(*group, "_b").orderBy(*key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    inner = b.withColumn("_in", F.coalesce(F.sum("_v").over(within), F.lit(0)))
    on = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)] + [F.col("_b") == F.col("_bb")]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    drop = [f"_g{i}" for i in range(len(group))] + ["_b", "_bb", "_base", "_in", "_v"]
    return inner.join(base, cond).withColumn(name, F.col("_base") + F.col("_in")).drop(*drop)


# ---- numpy over text

def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; null counts as empty."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(col.buffers()[1], "<i8")[col.offset:col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; a longer row stands alone."""
    row, n = 0, len(offsets) - 1
    while row < n:
        to = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        to = min(n, max(to, row + 1))
        yield row, to
        row = to


_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of every word of the texts laid end to end; no word crosses the end of a text."""
    ink = ~_BLANK[data]
    cut = offsets[offsets < len(data)]
    start, end = ink.copy(), np.zeros(len(data) + 1, bool)
    start[1:] &= ~ink[:-1]
    start[cut] = ink[cut]
    end[1:] = ink
    end[1:-1] &= ~ink[1:]
    inner = cut[cut > 0]
    end[inner] = ink[inner - 1]
    return np.flatnonzero(start), np.flatnonzero(end)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (xor-shift and multiply rounds)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def random64(n: int, seed: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 7919 + 1))


HASH_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the hash base and of its inverse, modulo 2^64."""
    if not _powers or len(_powers[0]) <= n:
        size = 1 << max(16, int(n + 1).bit_length())
        up, down = np.full(size, HASH_BASE), np.full(size, _INVERSE)
        up[0] = down[0] = 1
        _powers[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _powers[0][:n + 1], _powers[1][:n + 1]


# ---- numpy over vectors

def vectors(col: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Rows x dim doubles of a column of arrays without nulls; shorter arrays are filled with zeros."""
    arrays = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    lengths = pc.list_value_length(arrays).to_numpy(zero_copy_only=False)
    flat = arrays.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) == len(lengths) * dim and (lengths == dim).all():
        return flat.reshape(len(lengths), dim)
    out = np.zeros((len(lengths), dim))
    out[np.arange(dim) < lengths[:, None]] = flat
    return out


def sum_batches(df: DataFrame, size: int, f) -> np.ndarray:
    """The sum over all Arrow batches of ``f(batch)``, an array of ``size`` doubles: added up per task, then by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            total += f(b)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["at", "v"])

    out = np.zeros(size)
    for r in df.mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():
        out[r["at"]] = r["v"]
    return out
