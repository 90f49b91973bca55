"""Removal of repeated byte strings over a sample of positions that every repeat must hit.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts earlier: in a smaller document, or
earlier in the same one. This is minimizer sampling with full-window hashes, not prefix doubling by Spark sorts, which would
sort a (position, rank, next rank) row for every byte in every round:

1. *Names by doubling*: the name of 2k bytes is the pair of the names of k bytes at i and i + k, to 32 bytes;
   equal strings have equal 64-bit names. Every window of ``LENGTH`` bytes picks the smallest name in it as its
   anchor. Equal windows pick the same place, so a string repeats only if its anchor's name does. Windows next to
   each other share their anchor; such a run is a row (name, name of all bytes that the run covers, document, start,
   end), about one for 35 bytes.
2. *First sort*, by name: rows whose name is unique are done. Rows of the same name and bytes as an earlier
   row lie in earlier text as a whole: their bytes go. The first row of each kind stays for the next round
   if its name has others with different bytes around it. Names that very many rows have are dealt by name and bytes.
3. *Second sort*, past the threshold: those rows' windows are named in full (``LENGTH`` bytes), and of each name all
   windows but the first go.

Names are told apart by 128 bits in the end. Before each sort, a task already settles rows alike among its own
``CHUNK_BYTES`` of text, so a passage in a third of all documents reaches its sort about once a chunk.
Each row carries its document's order: (key, hash of the text).

Null text counts as empty: nothing goes. A null key comes before all keys. Rows of one key with different texts
are different documents, in the order of their hashes; rows alike in key and text are one document, and each of
them gets its result. Very long texts are worked on in pieces that overlap by a window. Other columns
are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rentrisk.llm.common import CHUNK_BYTES, HASH_BASE, mix64, powers, random64, row_chunks, small_batches, utf8
from rentrisk.session import materialize

LENGTH = 100
GRAM = 32
PLACE_BITS = 21
_NAME = random64(256, 21)
_BYTE = random64(256, 22)
CANDIDATE, GONE, OPEN = 0, 1, 2
#: A name is hot from one row in ``SHARE`` on, as one document in ``PART`` shows.
SHARE, PART = 1000, 64
ROW = "kind int, name long, whole long, d long, fp long, s long, e long"


def names(data: np.ndarray) -> np.ndarray:
    """Names of the ``GRAM`` bytes from each place on."""
    out, k = _NAME[data], 1
    while k < GRAM:
        out = mix64(out[:-k] * HASH_BASE + out[k:]) if len(out) > k else out[:0]
        k *= 2
    return out


def smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest key of the ``width`` from each place on."""
    out, k = keys, 1
    while 2 * k <= width:
        out = np.minimum(out[:-k], out[k:])
        k *= 2
    return np.minimum(out[:len(out) - (width - k)], out[width - k:]) if width > k else out


def pieces(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(first row, row after the last, first byte, byte after the last): whole rows, or a part of a long one."""
    for lo, hi in row_chunks(offsets):
        a, b = int(offsets[lo]), int(offsets[hi])
        if b - a <= 2 * CHUNK_BYTES - length:
            yield lo, hi, a, b
        else:
            for s in range(a, b, CHUNK_BYTES):
                yield lo, hi, s, min(b, s + CHUNK_BYTES + length - 1)


def range_names(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Names of the byte ranges s to e."""
    up, down = powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:-1], out=total[1:])
    return mix64((total[e] - total[s]) * down[s] + mix64((e - s).astype(np.uint64)))


def repeats(name: np.ndarray, whole: np.ndarray, rank: np.ndarray, s: np.ndarray) -> np.ndarray:
    """True where an earlier row, by (rank, s), has the same names."""
    both = mix64(name * HASH_BASE ^ whole)
    o = np.lexsort((s, rank, both))
    n, w, r, p = name[o], whole[o], rank[o], s[o]
    new = np.ones(len(o), bool)
    new[1:] = (n[1:] != n[:-1]) | (w[1:] != w[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(o)), 0))
    out = np.zeros(len(o), bool)
    out[o] = (r != r[first]) | (p != p[first])
    return out


def merged(doc: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of the ranges of each document, touching ranges joined."""
    if not len(s):
        return doc, s, e
    o = np.lexsort((e, s, doc))
    doc, s, e = doc[o], s[o], e[o]
    # ends that a later document cannot reach: lift each document above the one before
    lift = doc.astype(np.int64) * (int(e.max()) + 2)
    far = np.maximum.accumulate(e + lift)
    new = np.ones(len(s), bool)
    new[1:] = (s + lift)[1:] > far[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(s)) - 1
    return doc[at], s[at], far[last] - lift[at]


def order_of(d: np.ndarray, fp: np.ndarray) -> np.ndarray:
    """Rank of each row by (d, fp), equal rows alike."""
    o = np.lexsort((fp, d))
    step = np.ones(len(o), np.int64)
    step[1:] = (d[o][1:] != d[o][:-1]) | (fp[o][1:] != fp[o][:-1])
    rank = np.zeros(len(o), np.int64)
    rank[o] = np.cumsum(step)
    return rank


def batch_of(name, whole, doc, s, e, d, fp, gone) -> pa.RecordBatch:
    """Candidates as they are; what has gone as merged ranges, under a name of its own to spread it."""
    gd, gs, ge = merged(doc[gone], s[gone], e[gone])
    own = mix64(fp[gd].view(np.uint64) + gs.astype(np.uint64)).view(np.int64)
    stay = ~gone
    kind = np.concatenate([np.full(stay.sum(), CANDIDATE), np.full(len(gd), GONE)]).astype(np.int32)
    columns = [kind, np.concatenate([name[stay].view(np.int64), own]), np.concatenate([whole[stay].view(np.int64), own]),
               np.concatenate([d[doc[stay]], d[gd]]), np.concatenate([fp[doc[stay]], fp[gd]]),
               np.concatenate([s[stay], gs]), np.concatenate([e[stay], ge])]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["kind", "name", "whole", "d", "fp", "s", "e"])


def sample_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d, fp = b.column(0).to_numpy(), b.column(1).to_numpy()
            rank = order_of(d, fp)
            data, offsets = utf8(b.column(2))
            for lo, hi, a, z in pieces(offsets, length):
                got = anchored(data[a:z], np.clip(offsets[lo:hi + 1], a, z) - a, length)
                if got is None:
                    continue
                name, whole, doc, s, e = got
                doc = doc + lo
                gone = repeats(name, whole, rank[doc], s + a)
                yield batch_of(name, whole, doc, s + a - offsets[doc], e + a - offsets[doc], d, fp, gone)
    return run


def anchored(data: np.ndarray, own: np.ndarray, length: int):
    """(name, whole, doc, s, e) of the runs of windows with one anchor; bytes s to e are what the run covers."""
    if len(data) < length:
        return None
    n = names(data)
    mask = np.uint64((1 << PLACE_BITS) - 1)
    keys = (n & ~mask) | np.arange(len(n), dtype=np.uint64)
    at = (smallest(keys, length - GRAM + 1) & mask).astype(np.int64)
    size = np.diff(own)
    long_ = np.flatnonzero(size >= length)
    if not len(long_):
        return None
    edge = np.zeros(len(at) + 1, np.int8)
    edge[own[long_]] += 1
    # a document that ends where the next one starts its windows: both marks may meet
    np.add.at(edge, own[long_ + 1] - length + 1, -1)
    inside = np.cumsum(edge[:-1], dtype=np.int8) > 0
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1]
    new[own[long_]] = True
    s = np.flatnonzero(new & inside)
    doc = np.searchsorted(own, s, "right") - 1
    last = np.minimum(np.append(s[1:], len(at)) - 1, own[doc + 1] - length)
    e = last + length
    anchor = at[s]
    whole = mix64(range_names(data, s, e) + (anchor - s).astype(np.uint64))
    return n[anchor], whole, doc, s, e


def window_rows(length: int):
    """(d, fp, key, text, open rows) to a row per window of the open rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d, fp = b.column(0).to_numpy(), b.column(1).to_numpy()
            rank = order_of(d, fp)
            data, offsets = utf8(b.column(3))
            runs = b.column(4)
            for lo, hi in row_chunks(offsets):
                part = data[offsets[lo]:offsets[hi]]
                flat = runs.slice(lo, hi - lo).flatten()
                count = np.array([len(r) for r in runs.slice(lo, hi - lo)], np.int64)
                name, s, e = (flat.field(i).to_numpy() for i in range(3))
                doc = np.repeat(np.arange(lo, hi), count)
                n = e - length + 1 - s
                inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start = np.repeat(s + offsets[doc] - offsets[lo], n) + inner
                wdoc = np.repeat(doc, n)
                whole = range_names(part, start, start + length)
                wname = np.repeat(name.view(np.uint64), n)
                gone = repeats(wname, whole, rank[wdoc], start)
                ws = start + offsets[lo] - offsets[wdoc]
                yield batch_of(wname, whole, wdoc, ws, ws + length, d, fp, gone)
    return run


def final_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, text, ranges) to (key, n_bytes, n_removed, n_spans, kept_sha256, kept)."""
    for b in batches:
        data, offsets = utf8(b.column(1))
        out = []
        for i in range(b.num_rows):
            raw = data[offsets[i]:offsets[i + 1]]
            ranges = b.column(2)[i]
            removed = spans = at = 0
            keep = []
            if ranges.is_valid and len(ranges):
                flat = ranges.values
                s, e = flat.field(0).to_numpy(), flat.field(1).to_numpy()
                _, s, e = merged(np.zeros(len(s), np.int64), s, e)
                removed, spans = int((e - s).sum()), len(s)
                for x, y in zip(s.tolist(), e.tolist()):
                    keep.append(raw[at:x].tobytes())
                    at = y
            keep.append(raw[at:].tobytes())
            kept = b"".join(keep)
            out.append((len(raw), removed, spans, hashlib.sha256(kept).hexdigest(), kept))
        columns = list(zip(*out))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string()),
             pa.array(columns[4], pa.binary())], ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def often(rows: DataFrame, length: int) -> list[int]:
    """Names that more than about one row in ``SHARE`` has, from one document in ``PART``: fewer than ``SHARE`` numbers.

    They only decide how rows are dealt over tasks; the result does not depend on them.
    """
    some = rows.filter(F.pmod("fp", F.lit(PART)) == 0).mapInArrow(sample_rows(length), ROW).filter(F.col("kind") == CANDIDATE)
    counts = materialize(some.groupBy("name").count().filter(F.col("count") > 8), "often")
    total = counts.agg(F.sum("count")).first()[0] or 0
    return [r["name"] for r in counts.filter(F.col("count") > total / SHARE).collect()]


def first_only(rows: DataFrame, hot: list[int]) -> DataFrame:
    """``rows`` with those of one name in one task, of a hot name with those of the same ``whole`` only; ``rank`` among those
    of the same names, ties of one place alike.

    Rows next to each other share their name, so dealing by the name alone keeps them together, which shuffles smaller.
    """
    is_hot = F.col("name").isin(hot) if hot else F.lit(False)
    deal = F.when(is_hot, F.xxhash64("name", "whole")).otherwise(F.col("name"))
    # columns of the names are added behind the exchange, which need not carry them
    rows = rows.repartition(deal).withColumn("deal", deal).withColumn("hot", is_hot)
    w = Window.partitionBy("deal", "name", "kind", "whole").orderBy("d", "fp", "s")
    return rows.withColumn("rank", F.rank().over(w))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept_sha256, kept`` (the remaining bytes): one row per row."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM} bytes")
    small_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("d"),
                       F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("fp"), F.col(key).alias("key"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))

    hot = often(rows.select("d", "fp", "text"), length)
    ranked = first_only(rows.select("d", "fp", "text").mapInArrow(sample_rows(length), ROW), hot)
    first = (F.col("kind") == CANDIDATE) & (F.col("rank") == 1)
    # names with different bytes around them; those of hot names are looked at without asking
    own = Window.partitionBy("deal", "name")
    whole = F.when(first, F.col("whole"))
    ranked = ranked.withColumn("several", F.col("hot") | (F.min(whole).over(own) < F.max(whole).over(own)))
    settled = (F.col("kind") == GONE) | (F.col("rank") > 1)
    hits = ranked.filter(settled | F.col("several")).select(
        F.when(settled, F.lit(GONE)).otherwise(F.lit(OPEN)).alias("kind"), "name", "d", "fp", "s", "e")
    hits = materialize(hits, "repeats")

    todo = (hits.filter(F.col("kind") == OPEN).groupBy("d", "fp")
            .agg(F.collect_set(F.struct("name", "s", "e")).alias("runs")))
    windows = rows.join(todo, ["d", "fp"]).select("d", "fp", "key", "text", "runs").mapInArrow(window_rows(length), ROW)
    if not hot:
        # few documents show no frequent name in the sample: the runs are counted
        runs = hits.filter(F.col("kind") == OPEN).groupBy("name").count()
        total = runs.agg(F.sum("count")).first()[0] or 0
        hot = [r["name"] for r in runs.filter(F.col("count") > F.greatest(F.lit(8), F.lit(total / SHARE))).collect()]
    later = first_only(windows, hot).filter((F.col("kind") == GONE) | (F.col("rank") > 1))
    gone = (hits.filter(F.col("kind") == GONE).select("d", "fp", "s", "e").unionByName(later.select("d", "fp", "s", "e"))
            .groupBy("d", "fp").agg(F.collect_list(F.struct("s", "e")).alias("ranges")))
    out = rows.join(gone, ["d", "fp"], "left").select("key", "text", "ranges")
    return out.mapInArrow(final_rows, f"key {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string,"
                          " kept binary").withColumnRenamed("key", key)
