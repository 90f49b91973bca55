"""Approximate nearest neighbours by collision counting.

Unit vectors are projected on ``projections`` random directions. In a block of rows each
direction keeps its projections as one sorted array. A query opens a window around its own
projection in every array and widens all of them together, radius by radius (virtual
rehashing: no second index per radius). A row that lies in at least ``threshold`` of the windows
is verified against the original vectors, in double precision. The search of a block ends when
k verified rows are nearer than the radius, for which nearly every such row has been counted,
or when the windows cover the block. Every row is indexed; the best k of all blocks stay.

Blocks hold a bounded number of rows and of queries; a (row block, query block) pair is one
Spark group, so no task holds more than two blocks, whatever the table's size.

Vectors that are null, zero, of another length than the most, or hold null or non-finite components
take no part, neither as rows nor as queries. Rows are never paired with their own key.
Ties go to the smaller id. An empty table gives an empty result. Repeated rows count as rows each;
a null id takes no part. Only the two named columns are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rentrisk.llm.common import random64

BLOCK_ROWS = 16384
BLOCK_QUERIES = 1024


def directions(m: int, dim: int, seed: int) -> np.ndarray:
    """m x dim standard normal numbers, the same everywhere (Box-Muller over a hash)."""
    u = (random64(2 * m * dim, seed) >> np.uint64(11)).astype(np.float64) / (1 << 53)
    a, b = u[:m * dim], u[m * dim:]
    return (np.sqrt(-2 * np.log(a + 1e-300)) * np.cos(2 * np.pi * b)).reshape(m, dim)


class Block:
    """Sorted projections of a block of vectors."""

    def __init__(self, ids: np.ndarray, vecs: np.ndarray, m: int, seed: int):
        self.ids, self.vecs = ids, vecs
        self.norms = np.sqrt(np.einsum("ij,ij->i", vecs, vecs))
        self.axes = directions(m, vecs.shape[1], seed)
        p = (vecs / self.norms[:, None]) @ self.axes.T
        self.order = np.ascontiguousarray(np.argsort(p, axis=0, kind="stable").T)
        self.sorted = np.ascontiguousarray(np.sort(p, axis=0).T)

    def cosine(self, rows: np.ndarray, q: np.ndarray, qn: float) -> np.ndarray:
        """Each row is summed alone, in the same order, so equal vectors score equally."""
        return np.einsum("ij,j->i", self.vecs[rows], q) / (self.norms[rows] * qn)

    def windows(self, at: np.ndarray, half: float) -> tuple[np.ndarray, np.ndarray]:
        """Of every query (row of ``at``) and direction: the window's first place and the place after its last."""
        lo = [np.searchsorted(s, at[:, j] - half, "left") for j, s in enumerate(self.sorted)]
        hi = [np.searchsorted(s, at[:, j] + half, "right") for j, s in enumerate(self.sorted)]
        return np.stack(lo, 1), np.stack(hi, 1)

    def search(self, qids: np.ndarray, qs: np.ndarray, k: int, threshold: int, width: float, growth: float,
               start: float, slack: float):
        """Yield (query id, ids, scores) of the k best verified rows of each query."""
        n, m = len(self.ids), len(self.axes)
        norms = np.sqrt(np.einsum("ij,ij->i", qs, qs))
        at = (qs / norms[:, None]) @ self.axes.T
        middle = self.windows(at, 0.0)[0]
        levels: list = []
        for x, (qid, q, qn) in enumerate(zip(qids, qs, norms)):
            lo, hi = middle[x], middle[x]
            counts, seen = np.zeros(n, np.int64), self.ids == qid
            best, score, level, radius = np.zeros(0, np.int64), np.zeros(0), 0, start
            while True:
                if level == len(levels):
                    levels.append(self.windows(at, width * radius / 2))
                a, b = np.minimum(levels[level][0][x], lo), np.maximum(levels[level][1][x], hi)
                parts = [self.order[j, f:t] for j in range(m) for f, t in ((a[j], lo[j]), (hi[j], b[j]))]
                lo, hi = a, b
                counts += np.bincount(np.concatenate(parts), minlength=n)
                new = np.flatnonzero((counts >= threshold) & ~seen)
                if len(new):
                    seen[new] = True
                    best, score = np.concatenate([best, new]), np.concatenate([score, self.cosine(new, q, qn)])
                    if len(best) > k:
                        near = np.flatnonzero(score >= np.partition(score, -k)[-k])
                        top = near[np.lexsort((self.ids[best[near]], -score[near]))[:k]]
                        best, score = best[top], score[top]
                # the distance of unit vectors follows from their cosine
                if len(best) == k and np.sqrt(max(0.0, 2 - 2 * score.min())) <= slack * radius or seen.all():
                    yield qid, self.ids[best], score
                    break
                level, radius = level + 1, radius * growth


def nearest(rows: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
            projections: int = 24, share: float = 0.62, width: float = 2.7, growth: float = 1.25,
            start: float = 0.6, slack: float = 1.15, seed: int = 11) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows of largest cosine found for each query.

    ``width`` times the radius is the whole width of a window; with 2.7 a row at just the radius
    falls into 82 % of the windows, and ``share`` is asked for. ``growth`` is the step between radii,
    and a block's search ends when its k-th verified row is nearer than ``slack`` times the radius.
    """
    def usable(df):
        v = F.col(vec_col).cast("array<double>")
        return (df.select(F.col(id_col).cast("long").alias("id"), v.alias("vec"))
                .filter("id is not null and vec is not null and not exists(vec, x -> x is null or isnan(x)"
                        " or abs(x) = double('infinity')) and exists(vec, x -> x <> 0)"))

    r = usable(rows)
    dims = r.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dim, n = (dims["d"], dims["count"]) if dims else (0, 0)
    r = r.filter(F.size("vec") == dim)
    q = usable(queries).filter(F.size("vec") == dim)
    n_rows = max(1, -(-n // BLOCK_ROWS))
    n_queries = max(1, -(-q.count() // BLOCK_QUERIES))
    block = lambda parts: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(parts).cast("long"))
    every = lambda parts: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
    left = r.select("*", block(n_rows).alias("rb")).select("*", every(n_queries).alias("qb"))
    right = q.select("*", block(n_queries).alias("qb")).select("*", every(n_rows).alias("rb"))

    def task(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(a) and len(b):
            stack = lambda x: np.stack(x["vec"].to_numpy()).astype(np.float64)
            block = Block(a["id"].to_numpy(), stack(a), projections, seed)
            for qid, ids, score in block.search(b["id"].to_numpy(), stack(b), k, int(np.ceil(share * projections)),
                                                width, growth, start, slack):
                out["query_id"] += [qid] * len(ids)
                out["vec_id"] += ids.tolist()
                out["score"] += score.tolist()
        return pd.DataFrame(out)

    schema = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()),
                           T.StructField("score", T.DoubleType())])
    found = (left.groupBy("rb", "qb").cogroup(right.groupBy("rb", "qb"))
             .applyInPandas(task, schema))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
