"""Hard negatives by exact integer scores: Strassen products of tiles, then mergeable heaps.

Components become integers, ``floor(scale * x)``, and a row's score is its integer inner product with the
anchor. Anchors and rows are dealt into blocks of a bounded number of bytes; a (row block, anchor block) pair is
one Spark group. Within it tiles of anchors are multiplied with tiles of rows by Strassen's seven products,
zero-padded to even sides at each level. All additions are of int64, which is a ring modulo 2^64, so a score that
fits into a long is right however the sums in between wrap. A leaf runs in float64 only where the bound
max|a| * max|b| * length < 2^53 proves that exact, else in int64.

The tiles are gone through twice. First every anchor keeps a heap of its best rows of its own label
(the positives) in each group, and Spark merges the heaps. Then every positive opens a window of scores,
from ``low`` to ``high`` percent of its own, keeps a heap of the best rows of another label in it, and those
heaps are merged likewise. A heap holds at most as many rows as are returned, so what is shuffled between
tiles and results is anchors x groups x that number, whatever the rows of a label.

Rows with a null id, label or vector or with a null or non-finite component take no part. A shorter vector counts as
followed by zeros, an empty one has score 0 with all. A row is not its own positive; other rows of the same id are
rows like any other, repeated rows count each, and an anchor row that occurs twice answers twice. Ties go to the smaller id. An
anchor without a positive, or whose windows hold nothing, has no row. An empty table or no anchor gives an
empty result. Only the named columns are read, so further columns and their names do not matter. Scores beyond a
long end the job with an ``OverflowError``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rentrisk.llm.common import vectors
from rentrisk.session import materialize

#: Bytes of a block of rows, as int64; an anchor block has a quarter.
BLOCK_BYTES = 16 << 20
TILE_ANCHORS, TILE_ROWS = 512, 8192
LEAF = 32


def leaf(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of int64 matrices modulo 2^64; in float64 where that is proved to be exact."""
    top = lambda x: max(-int(x.min()), int(x.max())) if x.size else 0
    if top(a) * top(b) * max(1, a.shape[1]) < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def strassen(a: np.ndarray, b: np.ndarray, least: int = LEAF) -> np.ndarray:
    """The product of int64 matrices modulo 2^64 by seven products of halves; odd sides get a row of zeros."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= least:
        return leaf(a, b)
    a = np.pad(a, ((0, m % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, n % 2)))
    r, s, t = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:r, :s], a[:r, s:], a[r:, :s], a[r:, s:]
    b11, b12, b21, b22 = b[:s, :t], b[:s, t:], b[s:, :t], b[s:, t:]
    p1 = strassen(a11 + a22, b11 + b22, least)
    p2 = strassen(a21 + a22, b11, least)
    p3 = strassen(a11, b12 - b22, least)
    p4 = strassen(a22, b21 - b11, least)
    p5 = strassen(a11 + a12, b22, least)
    p6 = strassen(a21 - a11, b11 + b12, least)
    p7 = strassen(a12 - a22, b21 + b22, least)
    out = np.empty((2 * r, 2 * t), np.int64)
    out[:r, :t] = p1 + p4 - p5 + p7
    out[:r, t:] = p3 + p5
    out[r:, :t] = p2 + p4
    out[r:, t:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def quantised(col: pa.ChunkedArray, dim: int, scale: int) -> np.ndarray:
    """Rows x dim int64: floor(scale * component), shorter vectors filled with zeros."""
    with np.errstate(over="ignore"):
        x = np.floor(float(scale) * vectors(col, dim))
    if x.size and not np.abs(x).max() < 2.0 ** 62:
        raise OverflowError("a component does not fit into a long")
    return x.astype(np.int64)


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, largest first; of equal ones the earlier."""
    at = np.arange(len(scores))
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    # ~x falls as x rises, and unlike -x it cannot overflow
    return at[np.argsort(~scores[at], kind="stable")[:k]]


class Heaps:
    """The best rows of numbered lists, taken up tile by tile in the order of rows."""

    def __init__(self, k: int):
        self.k, self.lists = k, {}

    def add(self, name: tuple, places: np.ndarray, scores: np.ndarray) -> None:
        if name in self.lists:
            places = np.concatenate([self.lists[name][0], places])
            scores = np.concatenate([self.lists[name][1], scores])
        top = best(scores, self.k)
        self.lists[name] = places[top], scores[top]


class Group:
    """A block of anchors and a block of rows, the rows by (id, row)."""

    def __init__(self, anchors: pa.Table, rows: pa.Table, dim: int, scale: int):
        self.a, b = anchors, rows
        self.x = quantised(anchors["vec"], dim, scale)
        y = quantised(rows["vec"], dim, scale)
        order = np.lexsort((b["row"].to_numpy(), b["id"].to_numpy()))
        self.y = np.ascontiguousarray(y[order].T)
        self.rows, self.ids, self.labels = (b[c].to_numpy()[order] for c in ("row", "id", "label"))
        self.a_rows, self.a_ids, self.a_labels = (anchors[c].to_numpy() for c in ("row", "id", "label"))
        top = lambda x: max(-int(x.min()), int(x.max())) if x.size else 0
        if top(self.x) * top(self.y) * max(1, dim) >= 1 << 63:
            raise OverflowError("a score may not fit into a long")

    def tiles(self):
        """(anchor, first row, scores, same label) of every anchor in every tile."""
        for f in range(0, len(self.ids), TILE_ROWS):
            y, labels = self.y[:, f:f + TILE_ROWS], self.labels[f:f + TILE_ROWS]
            for g in range(0, len(self.x), TILE_ANCHORS):
                scores = strassen(self.x[g:g + TILE_ANCHORS], y)
                for i, s in enumerate(scores, g):
                    yield i, f, s, labels == self.a_labels[i]

    def positives(self, k: int) -> Heaps:
        heaps = Heaps(k)
        for i, f, s, same in self.tiles():
            at = np.flatnonzero(same & (self.rows[f:f + len(s)] != self.a_rows[i]))
            heaps.add((i,), at + f, s[at])
        return heaps

    def negatives(self, k: int, low: int, high: int) -> Heaps:
        heaps = Heaps(k)
        windows = [[(-(-low * p // 100), high * p // 100) for p in ps] for ps in self.a["scores"].to_pylist()]
        for i, f, s, same in self.tiles():
            least, most = min(w[0] for w in windows[i]), max(w[1] for w in windows[i])
            at = np.flatnonzero(~same & (s >= least) & (s <= most))
            found = s[at]
            for j, (lo, hi) in enumerate(windows[i]):
                own = (found >= lo) & (found <= hi)
                if own.any():
                    heaps.add((i, j), at[own] + f, found[own])
        return heaps


def usable(rows: DataFrame, is_anchor: Column, id_col: str, label_col: str, vec_col: str) -> DataFrame:
    """``row, id, label, vec, anchor`` of the rows that take part."""
    element = rows.schema[vec_col].dataType.elementType
    vec = F.col(vec_col) if isinstance(element, (T.FloatType, T.DoubleType)) else F.col(vec_col).cast("array<double>")
    good = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                       vec.alias("vec"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = good.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()).filter(~bad)
    return materialize(good.select(F.monotonically_increasing_id().alias("row"), "*"), "negatives-rows")


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
         scale: int = 256, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` is a condition on the columns of ``rows``. A negative's score lies between ``low`` and ``high`` percent of its
    positive's, ends included (with a negative positive score the window is empty unless low > high).
    """
    spark = rows.sparkSession
    r = usable(rows, is_anchor, id_col, label_col, vec_col)
    n, n_anchors, dim = r.agg(F.count("*"), F.count_if("anchor"), F.max(F.size("vec"))).first()
    dim = dim or 0
    block = max(256, BLOCK_BYTES // (8 * max(1, dim)))
    # enough blocks for every core, but none below some thousand rows
    n_rows = max(1, -(-n // block), min(spark.sparkContext.defaultParallelism, n // 4096))
    n_anchor_blocks = max(1, -(-n_anchors // max(64, block // 4)))
    deal = lambda parts: F.pmod(F.xxhash64("row"), F.lit(parts).cast("long"))
    every = lambda parts: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
    # both sides of a cogroup must not share a column of the same origin, so one gets aliases
    right = (r.select(*[F.col(c).alias(c) for c in ("row", "id", "label", "vec")], deal(n_rows).alias("rb"))
             .select("*", every(n_anchor_blocks).alias("ab")).groupBy("rb", "ab"))
    anchors = r.filter("anchor").select("row", "id", "label", "vec", deal(n_anchor_blocks).alias("ab"))

    def positives_of(a: pa.Table, b: pa.Table) -> list[tuple]:
        g = Group(a, b, dim, scale)
        return [(g.a_rows[i], g.a_ids[i], s, g.ids[p], g.rows[p])
                for (i,), (ps, ss) in g.positives(positives).lists.items() for p, s in zip(ps, ss)]

    def negatives_of(a: pa.Table, b: pa.Table) -> list[tuple]:
        g = Group(a, b, dim, scale)
        ids, scores = a["ids"].to_pylist(), a["scores"].to_pylist()
        return [(g.a_rows[i], g.a_ids[i], j, ids[i][j], scores[i][j], s, g.ids[p], g.rows[p])
                for (i, j), (ps, ss) in g.negatives(negatives, low, high).lists.items() for p, s in zip(ps, ss)]

    def pairs(left: DataFrame, task, names: list[str]) -> DataFrame:
        def run(a: pa.Table, b: pa.Table) -> pa.Table:
            # a hashed block can be empty, and an empty side has no columns
            found = task(a, b) if a.num_rows and b.num_rows else []
            values = np.array(found, np.int64).reshape(-1, len(names))
            return pa.table({name: pa.array(values[:, i]) for i, name in enumerate(names)})

        every_block = left.select("*", every(n_rows).alias("rb")).groupBy("rb", "ab")
        return every_block.cogroup(right).applyInArrow(run, ", ".join(f"{c} bigint" for c in names))

    def merged(found: DataFrame, keys: list[str], k: int) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(F.desc("score"), "id", "row")
        return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)

    close = merged(pairs(anchors, positives_of, ["anchor_row", "anchor_id", "score", "id", "row"]),
                   ["anchor_row"], positives)
    lists = close.groupBy("anchor_row").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("list"))
    lists = lists.select(F.col("anchor_row").alias("row"), F.col("list.id").alias("ids"), F.col("list.score").alias("scores"))
    windows = materialize(anchors.join(lists, "row"), "negatives-windows")
    found = pairs(windows, negatives_of, ["anchor_row", "anchor_id", "place", "positive_id", "positive_score",
                                          "score", "id", "row"])
    return merged(found, ["anchor_row", "place"], negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
