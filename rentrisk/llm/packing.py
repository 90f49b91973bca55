"""Packing token sequences by minimum bin slack.

Documents become pieces of at most ``capacity`` tokens; only longer documents are cut, and then the
first piece is the shorter one. How pieces fill sequences depends on their lengths only, so the
lengths are counted (at most ``capacity`` rows) and bins are made from the counts: the longest length left
starts a bin, and a subset-sum dynamic program over bitsets finds, among the lengths still available, the
combination that fills the bin best; it is removed, as often as the counts allow in one step, since
the next search would find it again. Every piece is in the search: the counts
are those of the whole table, not of a part.

A combination's bins take the pieces of each length in order of the pieces' running number within their
length, which ``running_sum`` gives without putting a frequent length into one task. The table of
(length, number range, bin, offset) is bounded by the combinations, at most about ``capacity``
squared rows however many documents there are.

Null text is an empty document: one piece with the end token. Repeated rows are packed each. Other columns are
not read. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentrisk.llm.common import running_sum, small_batches
from rentrisk.llm.tokens import FILE, encode_batches
from rentrisk.session import materialize

CAPACITY = 1024


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = FILE,
           capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``key, piece, start, length, ids_crc32`` (and ``ids``, 32-bit little-endian): the pieces of every document."""
    small_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, raw in enumerate(encode_batches(b.column(1), tokenizer)):
                n = len(raw) // 4
                cut = n % capacity or capacity
                for j, s in enumerate([0, *range(cut, n, capacity)]):
                    e = cut if j == 0 else s + capacity
                    part = raw[4 * s:4 * e]
                    at.append(i)
                    piece.append(j)
                    start.append(s)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
            columns = [b.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["key", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns, names = [*columns, pa.array(ids, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col(key).alias("key"), F.col(text)).mapInArrow(run, schema)


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """The lengths, repeats counted, with the greatest sum of at most ``room``; longer lengths first where equal."""
    items = []
    for length in sorted(counts, reverse=True):
        n = min(counts[length], room // length) if length <= room else 0
        step = 1
        while n > 0:
            take = min(step, n)
            items.append((length, take))
            n -= take
            step *= 2
    mask, reach = (1 << (room + 1)) - 1, [1]
    for length, take in items:
        if reach[-1] >> room & 1:
            break
        reach.append(reach[-1] | reach[-1] << length * take & mask)
    total, out = reach[-1].bit_length() - 1, []
    for i in range(len(reach) - 1, 0, -1):
        if not reach[i - 1] >> total & 1:
            length, take = items[i - 1]
            out += [length] * take
            total -= length * take
    return sorted(out, reverse=True)


def bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """(lengths of a bin, number of such bins), until no length is left."""
    left, out = dict(counts), []
    while left:
        top = max(left)
        left[top] -= 1
        rest = fullest({k: v for k, v in left.items() if v}, capacity - top)
        left[top] += 1
        full = [top, *rest]
        uses = {k: full.count(k) for k in set(full)}
        times = min(left[k] // n for k, n in uses.items())
        out.append((full, times))
        for k, n in uses.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return out


def places(packed: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first number, number after the last, pieces a bin, first bin, offset) of every combination."""
    used: dict[int, int] = {}
    out, first = [], 0
    for lengths, times in packed:
        offset = 0
        for k in sorted(set(lengths), reverse=True):
            n = lengths.count(k)
            begin = used.get(k, 0)
            out.append((k, begin, begin + n * times, n, first, offset))
            used[k] = begin + n * times
            offset += n * k
        first += times
    return out


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (rows with ``key, piece, length``) with ``sequence_id`` and ``offset``."""
    spark = cut.sparkSession
    cut = materialize(cut, "pieces")
    counts = {int(r["length"]): int(r["n"]) for r in
              cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = spark.createDataFrame(places(bins(counts, capacity)),
                                  "length long, begin long, end long, each long, first long, base long")
    table = table.groupBy("length").agg(F.sort_array(F.collect_list(F.struct(
        "begin", "end", "each", "first", "base"))).alias("ranges"))
    numbered = running_sum(cut, ["length"], [F.col("key"), F.col("piece"), F.col("ids_crc32")],
                           F.lit(1).cast("long"), "_i")
    # ranges of one length follow each other; each piece looks its own up
    own = F.element_at(F.filter("ranges", lambda r: (r["begin"] <= F.col("_i")) & (F.col("_i") < r["end"])), 1)
    return (numbered.join(F.broadcast(table), "length").withColumn("_r", own)
            .withColumn("_k", F.col("_i") - F.col("_r.begin"))
            .withColumn("sequence_id", F.col("_r.first") + F.floor(F.col("_k") / F.col("_r.each")))
            .withColumn("offset", F.col("_r.base") + F.col("_k") % F.col("_r.each") * F.col("length"))
            .drop("_i", "_r", "_k", "ranges"))


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = FILE,
                   capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``key, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``) of every piece."""
    return pack(pieces(docs, key, text, tokenizer, capacity, with_ids), capacity)
