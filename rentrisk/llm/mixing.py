"""Mixing sources to target weights.

The words of a source, document after document, are one stream that is cut into blocks of
``BLOCK`` words (the last block may be shorter). An output shard has a number of slots and draws
its count of slots per source from a multinomial distribution over what the sources still owe, so that
all shards together give every source its target; the last shards settle what is left. The slots of a
source are numbered through all shards, and number i takes block ``permutation(i mod blocks)``,
a pseudorandom permutation of the source's block indices (a Feistel network that walks the
cycle back into range), with another permutation for each round through the source. Blocks are joined to
slots by index. The last slot of a source takes just the words still missing, so a source's words are its
target rounded down, and no block or document is used more often than the target's rounds: at most
``MOST`` times.

Targets: weights 5, 2, 1, repeating along the sources in code point order (null last), share the sum of all
sizes; a target stops at ``MOST`` times its source's size and the excess is shared again by weight.
All targets are 0 where there are no words.

What reaches the driver is one row per source, and a table of at most ``SHARDS`` rows times the
sources. Documents are numbered along their source by ``running_sum``, which splits a large source.
Draws depend on the seed, the sources and their sizes, and a document's place on its key and text, so reruns
agree, however the table's files are cut.

Null text has size 0 and is taken 0 times. Null source is a source of its own. Repeated rows are documents
each; rows alike in every column used share their outcomes in any order. Other columns are not read by
``mix``. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from rentrisk.llm.common import row_chunks, running_sum, small_batches, unused, utf8, word_bounds
from rentrisk.session import materialize

BLOCK = 256
SHARDS = 1024
SLOTS = 4096
MOST = 3
WEIGHTS = (5, 2, 1)
ROUNDS = 4


def targets(sizes: list[int], weights: list[float], most: float = MOST) -> list[float]:
    """Shares of the sum of sizes by weight; none above ``most`` times its size."""
    total = float(sum(sizes))
    out, open_ = [0.0] * len(sizes), list(range(len(sizes)))
    left = total
    while open_:
        share = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * share > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = weights[i] * share
            break
        for i in full:
            out[i] = float(most * sizes[i])
            left -= out[i]
        open_ = [i for i in open_ if i not in set(full)]
    return out


class Permutation:
    """Permutations of range(n), by source, round and seed."""

    def __init__(self, n: int, source: int, turn: int, seed: int):
        self.n = n
        self.half = max(1, math.ceil(max(1, (n - 1).bit_length()) / 2))
        d = hashlib.sha256(f"{seed}:{source}:{turn}".encode()).digest()
        self.keys = np.frombuffer(d[:8 * ROUNDS], "<u8")

    def _f(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (x ^ key) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return (x >> np.uint64(32)) & np.uint64((1 << self.half) - 1)

    def _pass(self, x: np.ndarray, back: bool) -> np.ndarray:
        h = np.uint64(self.half)
        a, b = x >> h, x & np.uint64((1 << self.half) - 1)
        for key in self.keys[::-1] if back else self.keys:
            a, b = (b ^ self._f(a, key), a) if back else (b, a ^ self._f(b, key))
        return (a << h) | b

    def _walk(self, x: np.ndarray, back: bool) -> np.ndarray:
        x = self._pass(np.asarray(x, np.uint64), back)
        out = np.flatnonzero(x >= self.n)
        while len(out):
            x[out] = self._pass(x[out], back)
            out = out[x[out] >= self.n]
        return x.astype(np.int64)

    def __call__(self, i) -> np.ndarray:
        return self._walk(np.atleast_1d(i), False)

    def place_of(self, block: int) -> int:
        return int(self._walk(np.atleast_1d(block), True)[0])


def slots_for(words: int, size: int, block: int, source: int, seed: int) -> tuple[int, int]:
    """(slots, words in the last slot) that give ``words`` words of a source of ``size`` words."""
    if words <= 0 or size <= 0:
        return 0, 0
    n = -(-size // block)
    turns, rest = divmod(words, size)
    if rest == 0:
        turns, rest = turns - 1, size
    last = size - (n - 1) * block
    short = Permutation(n, source, turns, seed).place_of(n - 1)
    if rest <= short * block:
        k = -(-rest // block)
        return turns * n + k, rest - (k - 1) * block
    if rest <= short * block + last:
        return turns * n + short + 1, rest - short * block
    more = rest - short * block - last
    k = -(-more // block)
    return turns * n + short + 1 + k, more - (k - 1) * block


def draw_shards(slots: list[int], shard_slots: int, seed: int) -> list[tuple[int, int, int, int]]:
    """(shard, source, first slot number of the source, slots): multinomial draws over what is owed."""
    rng = np.random.default_rng(seed)
    owed, first, shard, out = np.array(slots, np.int64), np.zeros(len(slots), np.int64), 0, []
    while owed.sum() > 0:
        room = min(shard_slots, int(owed.sum()))
        counts = np.minimum(rng.multinomial(room, owed / owed.sum()), owed)
        while (short := room - int(counts.sum())) > 0:
            left = owed - counts
            counts = np.minimum(counts + rng.multinomial(short, left / left.sum()), owed)
        out += [(shard, s, int(first[s]), int(c)) for s, c in enumerate(counts) if c]
        first, owed, shard = first + counts, owed - counts, shard + 1
    return out


class Mix:
    """A drawn mix: ``sources`` (rows on the driver), ``docs``, ``slots`` and ``taken`` (frames)."""

    def __init__(self, docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                 block: int = BLOCK, seed: int = 17):
        spark = docs.sparkSession
        kind = docs.schema[key].dataType.simpleString()
        small_batches(spark)
        sized = materialize(
            docs.select(F.col(key).alias("key"), F.col(source).cast("string").alias("source"), _print(text).alias("fp"),
                        F.col(text).alias("text")).mapInArrow(_sizes, f"key {kind}, source string, fp long, size long")
            .withColumn("row", F.monotonically_increasing_id()), "sizes")
        rows = sized.groupBy("source").agg(F.sum("size").alias("n")).collect()
        rows.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-8", "surrogatepass")))
        names, sizes = [r["source"] for r in rows], [int(r["n"]) for r in rows]
        goal = targets(sizes, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(rows))])
        self.sources = list(zip(names, sizes, goal))
        need = [slots_for(math.floor(t + 1e-6), n, block, i, seed) for i, (t, n) in enumerate(zip(goal, sizes))]
        shard_slots = max(SLOTS, -(-sum(k for k, _ in need) // SHARDS))
        drawn = draw_shards([k for k, _ in need], shard_slots, seed)

        table = [(i, a, b, c, k, last) for i, ((a, b, c), (k, last)) in enumerate(zip(self.sources, need))]
        by_source = spark.createDataFrame(table, "sid int, name string, source_size long, target double, n_slots long,"
                                                 " last_words long")
        ranges = spark.createDataFrame(drawn, "shard int, sid int, first long, n long")
        self.slots = _slots(ranges, by_source, block, seed)
        by_source = F.broadcast(by_source.select("sid", "name", "source_size", "target"))  # one row per source
        self.docs = running_sum(sized.join(by_source, F.col("source").eqNullSafe(F.col("name")), "left").drop("name"),
                                ["sid"], [F.col("key"), F.col("fp"), F.col("size")], F.col("size"), "at", ties=("row",))
        self.block = block

    def segments(self) -> DataFrame:
        """``row, key, source, fp, size, source_size, target, parts``: a row per document.

        ``parts`` holds (from, to, uses): word ranges of the document and how often the mix takes them.
        """
        uses = self.slots.groupBy("sid", "block").agg(
            F.sum(F.when(F.col("words") == self.block, 1).otherwise(0)).alias("whole"),
            F.max(F.when(F.col("words") < self.block, F.col("words"))).alias("short"))
        # a document is cut where the blocks are; one without words keeps one empty part
        last = F.col("at") + F.greatest(F.col("size"), F.lit(1)) - 1
        cut = self.docs.withColumn("block", F.explode(F.sequence(
            F.floor(F.col("at") / self.block), F.floor(last / self.block))))
        shift = F.col("block") * self.block - F.col("at")
        begin, end = F.greatest(-shift, F.lit(0)), F.least(F.col("size") - shift, F.lit(self.block))
        whole, short = F.coalesce("whole", F.lit(0)), F.coalesce("short", F.lit(0))
        # the one slot of a source that takes only the first words of its block cuts the range in two
        middle = F.least(F.greatest(short, begin), end)
        part = lambda f, t, n: F.struct((f + shift).cast("long").alias("from"), (t + shift).cast("long").alias("to"),
                                        n.cast("long").alias("uses"))
        both = F.filter(F.array(part(begin, middle, whole + 1), part(middle, end, whole)), lambda x: x["from"] < x["to"])
        return (cut.join(uses, ["sid", "block"], "left").withColumn("_p", both)
                .groupBy("row", "key", "source", "fp", "size", "source_size", "target")
                .agg(F.sort_array(F.flatten(F.collect_list("_p"))).alias("parts")))

    def taken(self) -> DataFrame:
        """``key, size, source_size, target, taken``: one row per document."""
        n = F.aggregate("parts", F.lit(0).cast("long"), lambda s, x: s + (x["to"] - x["from"]) * x["uses"])
        return self.segments().select("key", "size", "source_size", "target", n.alias("taken"))


def _print(text: str):
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offsets = utf8(b.column(3))
        sizes = np.zeros(b.num_rows, np.int64)
        for lo, hi in row_chunks(offsets):
            own = offsets[lo:hi + 1] - offsets[lo]
            starts, _ = word_bounds(data[offsets[lo]:offsets[hi]], own)
            sizes[lo:hi] = np.diff(np.searchsorted(starts, own))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(sizes)],
                                         ["key", "source", "fp", "size"])


def _slots(ranges: DataFrame, by_source: DataFrame, block: int, seed: int) -> DataFrame:
    """``shard, sid, slot, block, words``: a row per slot, with the block that it takes and the words of it."""
    def pick(batches):
        for pdf in batches:
            for (sid, turn, n), g in pdf.groupby(["sid", "turn", "n"], sort=False):
                blocks = Permutation(int(n), int(sid), int(turn), seed)(g["place"].to_numpy())
                yield pd.DataFrame({"shard": g["shard"], "sid": g["sid"], "slot": g["slot"], "block": blocks,
                                    "words": np.where(g["slot"] == g["n_slots"] - 1, g["last_words"],
                                                      block)})

    n_blocks = F.ceil(F.col("source_size") / block)
    parts = int(ranges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (ranges.repartition(parts).join(F.broadcast(by_source.drop("name", "target")), "sid")
            .select("*", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("slot"))
            .select("shard", "sid", "slot", "n_slots", "last_words", n_blocks.alias("n"),
                    F.floor(F.col("slot") / n_blocks).alias("turn"), (F.col("slot") % n_blocks).alias("place")))
    return rows.mapInPandas(pick, "shard int, sid int, slot long, block long, words long")


def _copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(texts, parts, other columns) to the other columns and the text of every copy that the mix takes."""
    for b in batches:
        data, offsets = utf8(b.column(0))
        parts, rows, texts = b.column(1), [], []
        for i in range(b.num_rows):
            raw = data[offsets[i]:offsets[i + 1]]
            ranges = parts[i].as_py() or []
            starts = ends = None
            for copy in range(max([r["uses"] for r in ranges], default=0)):
                keep = [(r["from"], r["to"]) for r in ranges if r["uses"] > copy]
                rows.append(i)
                if len(keep) == len(ranges):
                    texts.append(raw.tobytes())
                    continue
                if starts is None:
                    starts, ends = word_bounds(raw, offsets[i:i + 2] - offsets[i])
                joined: list[list[int]] = []
                for f, t in keep:
                    if joined and joined[-1][1] == f:
                        joined[-1][1] = t
                    else:
                        joined.append([f, t])
                texts.append(b"\n".join(raw[starts[f]:ends[t - 1]].tobytes() for f, t in joined))
        at = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(texts, pa.binary()).cast(pa.string()), *(c.take(at) for c in b.columns[2:])],
            b.schema.names[:1] + b.schema.names[2:])


def apply(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK,
          seed: int = 17) -> DataFrame:
    """The mix as rows of ``docs``: a row per copy taken, all other columns as they were.

    A copy that is taken in part has the words of its blocks only, cut out of the text; copies without
    a word taken are left out, and so are documents without words.
    """
    parts = Mix(docs, key, text, source, block, seed).segments()
    p = unused(docs)
    on = [f"{p}{c}" for c in ("k", "s", "f")]
    number, taken, other = f"{p}n", f"{p}parts", f"{p}r_"
    same = Window.partitionBy(*on)
    left = docs.select("*", F.col(key).alias(on[0]), F.col(source).cast("string").alias(on[1]), _print(text).alias(on[2]))
    left = left.withColumn(number, F.row_number().over(same.orderBy(on[2])))
    right = parts.select(F.col("key").alias(on[0]), F.col("source").alias(on[1]), F.col("fp").alias(on[2]), "row",
                         F.col("parts").alias(taken))
    right = right.withColumn(number, F.row_number().over(same.orderBy("row"))).drop("row")
    right = right.select(*[F.col(c).alias(other + c) for c in (*on, number)], taken)
    cond = F.col(number) == F.col(other + number)
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col(other + c))
    rest = [f for f in docs.schema.fields if f.name != text]
    schema = StructType([docs.schema[text], *rest])
    rows = left.join(right, cond).select(F.col(text), taken, *[F.col(f"`{f.name}`") for f in rest])
    return rows.mapInArrow(_copies, schema).select(*[F.col(f"`{c}`") for c in docs.columns])
