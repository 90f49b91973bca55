"""Near-duplicate documents by b-bit MinHash, and connected components of the links.

1. A text's set holds its distinct shingles of ``width`` words (64-bit hashes of the words' bytes, A-Z
   lower-cased). Texts of the same set are one class; its representative is the class's smallest row.
2. A class has ``BANDS * ROWS`` minima. Of each minimum ``BITS`` low bits are kept, packed into
   long words; each band of ``ROWS`` whole minima gives a bucket key.
3. In each bucket the members are compared with one centre (rounds of *stars*, each with another centre;
   only members that are not yet in the centre's component). So a bucket of thousands of copies costs about
   its size. Members of buckets that still hold several components then go through an exact search:
   sets of similarity t share one of their rarest (1 - t) n + 1 shingles, in any common order, so texts
   whose rare shingles are all their own are certified without a pair, and the others meet on those shingles.
   No pair of candidates is left out unless a chain of links joins it already.
4. A candidate pair is tested against the collision-corrected estimate (equal bit groups, less those equal by
   chance), with a margin of ``MARGIN`` (six standard deviations), and the exact bound that
   set sizes give; what remains is confirmed on the full sets of both texts.
5. Links become components by label propagation with pointer jumping, over tables written between rounds.

A pair of similarity 0.8 shares no band with probability (1 - 0.8^4)^24 = 3e-6, a closer one less.

Null or blank text has the empty set: linked with nothing, a component of its own. Rows with a null key are
linked with nothing, have no component and are kept. Rows of the same key are one node: linked through any of
its texts. Repeated rows get their rows each. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rentrisk.llm.common import HASH_BASE, mix64, powers, random64, row_chunks, small_batches, unused, utf8, word_bounds
from rentrisk.session import materialize

BANDS, ROWS, BITS = 24, 4, 4
MARGIN = 0.3
STARS = 3
HASHES = BANDS * ROWS
PER_LONG = 64 // BITS
LONGS = HASHES // PER_LONG

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = random64(256, 3)
_BASE = HASH_BASE
_MUL, _ADD = random64(HASHES, 1) | np.uint64(1), random64(HASHES, 2)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word: a polynomial over its bytes, independent of its place, then mixed."""
    up, down = powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[data]] * up[:-1], out=total[1:])
    return mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text; texts of fewer words have their whole sequence as one."""
    sets: list[np.ndarray] = []
    for lo, hi in row_chunks(offsets):
        own = offsets[lo:hi + 1] - offsets[lo]
        part = data[offsets[lo]:offsets[hi]]
        starts, ends = word_bounds(part, own)
        words = word_hashes(part, starts, ends)
        first = np.searchsorted(starts, own)
        # after step j this holds the sequence of j + 1 words from each word on
        chain, short = np.full(len(words), np.uint64(width)), {}
        for j in range(width):
            n = max(0, len(words) - j)
            chain[:n] = mix64((chain[:n] ^ words[j:]) * _BASE + np.uint64(j))
            for at in first[:-1][np.diff(first) == j + 1].tolist():
                short[at] = chain[at] + np.uint64(j + 1 < width)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= width:
                sets.append(np.unique(chain[a:b - width + 1]))
            else:
                sets.append(np.array([short[a]], np.uint64) if b > a else np.zeros(0, np.uint64))
    return sets


def signature(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed low bits, band keys) of a non-empty set."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), 2048):
        h = s[i:i + 2048, None] * _MUL
        h += _ADD
        np.minimum(low, h.min(axis=0), out=low)
    low = mix64(low)
    bits = (low & np.uint64((1 << BITS) - 1)).reshape(LONGS, PER_LONG)
    packed = np.bitwise_or.reduce(bits << (np.arange(PER_LONG, dtype=np.uint64) * np.uint64(BITS)), axis=1)
    keys = np.arange(BANDS, dtype=np.uint64)
    for j in range(ROWS):
        keys = mix64(keys * _BASE + low.reshape(BANDS, ROWS)[:, j])
    return packed.view(np.int64), keys.view(np.int64)


def sign(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``key, fp, n, k1, k2, sig, bands``: a row per row; (k1, k2) names the set, fp the text."""
    small_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = shingle_sets(*utf8(b.column(2)), width)
            n = np.array([len(s) for s in sets], np.int64)
            # two sums over the set, of two different mixes of its members
            k1 = np.array([mix64(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            k2 = np.array([mix64(s ^ _BASE).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            signed = [signature(s) if len(s) else (None, None) for s in sets]
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n), pa.array(k1), pa.array(k2),
                 pa.array([x for x, _ in signed], lists), pa.array([x for _, x in signed], lists)],
                ["key", "fp", "n", "k1", "k2", "sig", "bands"])

    rows = docs.select(F.col(key).alias("key"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("fp"),
                       F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {kind}, fp long, n long, k1 long, k2 long, sig array<long>, bands array<long>")


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two packed signatures, corrected for bit groups that are equal by chance."""
    ones = int("0" * (BITS - 1) + "1", 2)
    spread = sum(ones << (BITS * i) for i in range(PER_LONG))
    spread = spread - (1 << 64) if spread >= 1 << 63 else spread
    equal = F.lit(0)
    for i in range(LONGS):
        x = a[i].bitwiseXOR(b[i])
        any_bit = reduce(lambda p, q: p.bitwiseOR(q), [F.shiftrightunsigned(x, j) for j in range(BITS)])
        equal = equal + (PER_LONG - F.bit_count(any_bit.bitwiseAND(F.lit(spread).cast("long"))))
    chance = 2.0 ** -BITS
    return (equal / float(HASHES) - chance) / (1 - chance)


def may_match(na: Column, nb: Column, a: Column, b: Column, percent: int) -> Column:
    """True unless the sizes rule the pair out, or the estimate does so beyond its error."""
    sizes = F.least(na, nb) * 100 >= F.greatest(na, nb) * percent
    return sizes & (estimate(a, b) >= percent / 100 - MARGIN)


def texts_of(docs: DataFrame, classes: DataFrame, nodes: DataFrame, key: str, text: str) -> DataFrame:
    """``v, text`` of the representatives in ``nodes``, written once."""
    need = classes.join(nodes, "v", "left_semi").select("v", "fp")
    texts = (docs.select(F.col(key).alias("v"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("fp"),
                         F.col(text).alias("text"))
             .join(need, ["v", "fp"], "left_semi").groupBy("v", "fp").agg(F.min("text").alias("text")))
    return materialize(texts.drop("fp"), "texts")


def prefix_pairs(texts: DataFrame, labels: DataFrame, width: int, percent: int) -> DataFrame:
    """All pairs (a, b) of different labels that may reach the similarity, and few others.

    Of a set of n shingles, rarest first, one of the first n - ceil(t n) + 1 is in every set as similar as t.
    Shingles of one text only need not be looked up: they take their share of those places. A shingle so late in
    either order that the sets could no longer be similar enough, were it the first they share, joins nothing.
    """
    kind = texts.schema["v"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = shingle_sets(*utf8(b.column(1)), width)
            n = np.array([len(x) for x in sets], np.int64)
            at = pa.array(np.repeat(np.arange(b.num_rows), n))
            token = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), pa.array(np.repeat(n, n)), pa.array(token)], ["v", "n", "token"])

    tokens = texts.select("v", "text").mapInArrow(run, f"v {kind}, n long, token long")
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    own = Window.partitionBy("v")
    places = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - (F.col("n") - F.col("m"))
    rare = (tokens.join(shared, "token").withColumn("m", F.count(F.lit(1)).over(own))
            .withColumn("r", F.row_number().over(own.orderBy("c", "token"))).filter(F.col("r") <= places)
            .join(labels, "v").select("token", "v", "label", "n", (F.col("m") - F.col("r")).alias("after")))
    rare = materialize(rare, "rare")
    x = rare.select("token", *[F.col(c).alias(f"{c}x") for c in ("v", "label", "n", "after")])
    y = rare.select("token", *[F.col(c).alias(f"{c}y") for c in ("v", "label", "n", "after")])
    # at their first common shingle two sets share at most one more than what either holds after it
    enough = (F.least("afterx", "aftery") + 1) * (100 + percent) >= (F.col("nx") + F.col("ny")) * percent
    met = x.join(y, (x["token"] == y["token"]) & (F.col("labelx") < F.col("labely")) & enough)
    return met.select(F.least("vx", "vy").alias("a"), F.greatest("vx", "vy").alias("b")).distinct()


def confirm(docs: DataFrame, classes: DataFrame, pairs: DataFrame, key: str, text: str, width: int,
            percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    nodes = pairs.select(F.col("a").alias("v")).union(pairs.select("b")).distinct()
    texts = texts_of(docs, classes, nodes, key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # many pairs share a centre: each text of the batch is cut up once
            both = pa.concat_arrays([b.column(2), b.column(3)]).dictionary_encode()
            sets = shingle_sets(*utf8(both.dictionary), width)
            index = both.indices.to_numpy()
            good = []
            for x, y in zip(index[:b.num_rows], index[b.num_rows:]):
                common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                good.append(100 * common >= percent * (len(sets[x]) + len(sets[y]) - common))
            keep = np.flatnonzero(good)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep)), b.column(1).take(pa.array(keep))], ["a", "b"])

    kind = docs.schema[key].dataType.simpleString()
    second = pairs.join(texts.select(F.col("v").alias("b"), F.col("text").alias("tb")), "b")
    first = second.join(texts.select(F.col("v").alias("a"), F.col("text").alias("ta")), "a")
    return first.select("a", "b", "ta", "tb").mapInArrow(run, f"a {kind}, b {kind}").distinct()


def components(links: DataFrame) -> DataFrame:
    """``v, label`` of every node in ``links`` (a, b): the smallest node that it reaches."""
    edges = materialize(links.select(F.col("a").alias("s"), F.col("b").alias("t"))
                        .union(links.select("b", "a")).distinct(), "edges")
    labels = materialize(edges.groupBy(F.col("s").alias("v")).agg(F.min("t").alias("m"))
                         .select("v", F.least("v", "m").alias("label")), "labels")
    while True:
        near = (edges.join(labels, F.col("t") == F.col("v")).groupBy("s").agg(F.min("label").alias("m")))
        step = labels.join(near, F.col("v") == F.col("s"), "left").select(
            "v", F.col("label").alias("was"), F.least("label", "m").alias("new"))
        # a label is a node itself, and its own label is at most it
        jump = labels.select(F.col("v").alias("j"), F.col("label").alias("far"))
        after = materialize(step.join(jump, F.col("new") == F.col("j"), "left").select(
            "v", "was", F.least("new", "far").alias("label")), "labels")
        if not after.filter("was <> label").head(1):
            return after.select("v", "label")
        labels = after.select("v", "label")


def link(docs: DataFrame, classes: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """``v, label`` of all representatives with links."""
    spark = docs.sparkSession
    kind = classes.schema["v"].dataType.simpleString()
    member = classes.select("v", F.explode("bands").alias("bucket"))
    full = member.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("bucket")
    member = materialize(member.join(full, "bucket"), "members")
    facts = materialize(classes.select("v", "n", "sig"), "facts")
    links = spark.createDataFrame([], f"a {kind}, b {kind}")
    tested, labels = links, spark.createDataFrame([], f"v {kind}, label {kind}")

    def open_members() -> DataFrame:
        """Members of the buckets that hold more than one component."""
        m = member.join(labels, "v", "left").select("bucket", "v", F.coalesce("label", "v").alias("label"))
        mixed = m.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi")
        return materialize(m.join(mixed.select("bucket"), "bucket"), "open")

    def ordered(x: Column, y: Column, *more: Column) -> list[Column]:
        return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b"), *more]

    def likely(pairs: DataFrame) -> DataFrame:
        fa = facts.select(F.col("v").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"))
        fb = facts.select(F.col("v").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"))
        good = may_match(F.col("na"), F.col("nb"), F.col("sa"), F.col("sb"), percent)
        return pairs.join(fa, "a").join(fb, "b").filter(good).select("a", "b").distinct()

    for turn in range(STARS + 1):
        left = open_members()
        if not left.head(1):
            break
        if turn < STARS:
            # the first centre is the smallest member, then members drawn by hash
            rank = F.struct(F.lit(0).alias("r"), F.col("v").alias("c"), F.col("label").alias("cl")) if turn == 0 else \
                F.struct(F.xxhash64("v", "bucket", F.lit(turn)).alias("r"), F.col("v").alias("c"), F.col("label").alias("cl"))
            centre = left.groupBy("bucket").agg(F.min(rank).alias("k")).select("bucket", "k.c", "k.cl")
            pairs = left.join(centre, "bucket").filter("label <> cl").select(*ordered(F.col("v"), F.col("c"))).distinct()
            pairs = likely(pairs.join(tested, ["a", "b"], "left_anti"))
        else:
            members = materialize(left.select("v", "label").distinct(), "open")
            pairs = prefix_pairs(texts_of(docs, classes, members, key, text), members, width, percent)
            pairs = likely(pairs.join(tested, ["a", "b"], "left_anti"))
        pairs = materialize(pairs, "pairs")
        if not pairs.head(1):
            continue
        new = materialize(confirm(docs, classes, pairs, key, text, width, percent), "links")
        tested = tested.unionByName(pairs)
        if new.head(1):
            links = links.unionByName(new)
            labels = components(links)
    return labels


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5,
                    percent: int = 80) -> DataFrame:
    """``key, n_shingles, component_id, kept``: one row per row of ``docs``."""
    signed = materialize(sign(docs, key, text, width), "signed")
    named = signed.filter("n > 0 and key is not null")
    classes = materialize(
        named.groupBy("k1", "k2").agg(F.min(F.struct("key", "fp", "n", "sig", "bands")).alias("r"))
        .select("k1", "k2", F.col("r.key").alias("v"), "r.fp", "r.n", "r.sig", "r.bands"), "classes")
    labels = link(docs, classes, key, text, width, percent)
    own = classes.join(labels, "v", "left").select("k1", "k2", F.coalesce("label", "v").alias("label"))
    blank = F.col("n") == 0
    out = signed.select("key", "n", "k1", "k2").join(
        own.select(F.col("k1").alias("o1"), F.col("k2").alias("o2"), "label"),
        (F.col("k1") == F.col("o1")) & (F.col("k2") == F.col("o2")) & ~blank, "left")
    component = F.when(blank, F.col("key")).when(F.col("key").isNotNull(), F.col("label"))
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the rows whose near-duplicate component has a smaller key; all columns as they were."""
    name = unused(docs)
    gone = near_duplicates(docs, key, text, width, percent).filter(~F.col("kept")).select(F.col(key).alias(name)).distinct()
    return docs.join(gone, F.col(key) == F.col(name), "left_anti")
