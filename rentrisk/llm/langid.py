"""Language of a text from averaged hashed subword embeddings and a linear softmax.

A text's letters and white space are cut into overlapping byte n-grams of two to four; other bytes
count as a space. Each n-gram is hashed to one of ``BUCKETS`` embeddings, the text's embedding is
their mean, and a linear softmax over it gives the languages. Embeddings and weights are trained
together by stochastic gradient descent in numpy on a bounded sample of labelled rows
(``Settings.per_language`` different rows of each language, fewer where languages are so many that these would be more than
``Settings.rows``, one of each at least), of whose whole texts Spark's tasks send back only bucket counts. Rows are drawn by a hash: those
below a threshold from the number of a language's rows, about twice as many as are needed, and of those the lowest, so that
no task sees more of a language than that. A part of the sample sets the
temperature that calibrates the probabilities and the rejection level: the score under which the
calibrated answers are wrong too often (extra column ``accepted``).

As the model is linear, embeddings times weights is one table (bucket x language), and a text of
any length is scored whole by averaging rows of it.

Null text or text without a letter: ``und``, score 0, not accepted. A table without any label gives
``und`` throughout. Ties of the softmax go to the first language by name. Repeated rows and null
keys get their rows, and a repeated row is learned once; they hash to one fold by the key's text (null: held out). Labels are read only
from the training fold; no other column takes part in a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rentrisk.llm.common import mix64, row_chunks, small_batches, utf8

BUCKETS = 1 << 13
#: Draws are told apart by this many values against a language's threshold.
DRAWS = 1 << 40
ORDERS = (2, 3, 4)


@dataclass(frozen=True)
class Settings:
    per_language: int = 400
    rows: int = 25_600
    dim: int = 16
    epochs: int = 30
    batch: int = 32
    rate: float = 0.5
    calibration: float = 0.25
    most_wrong: float = 0.05
    seed: int = 5


def _plain() -> np.ndarray:
    """Byte table: letters in lower case and bytes of longer characters stay, the rest is a space."""
    t = np.full(256, 32, np.uint8)
    t[128:] = np.arange(128, 256)
    t[97:123] = np.arange(97, 123)
    t[65:91] = np.arange(97, 123)
    return t


PLAIN = _plain()


def grams(data: np.ndarray) -> list[np.ndarray]:
    """Per order, the bucket of the n-gram that starts at each byte of the texts laid end to end.

    N-grams over the end of a text belong to none; ``_spans`` leaves them out.
    """
    d = PLAIN[data].astype(np.uint32)
    out = []
    for k in ORDERS:
        n = max(0, len(d) - k + 1)
        code = d[:n].copy()
        for j in range(1, k):
            code |= d[j:n + j] << np.uint32(8 * j)
        h = (code.astype(np.uint64) + np.uint64(k << 40)) * np.uint64(0x9E3779B97F4A7C15)
        out.append((h >> np.uint64(51)).astype(np.int32))
    return out


def _spans(offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First place, and place after the last, of each text's n-grams of order k."""
    return offsets[:-1], np.maximum(offsets[1:] - (k - 1), offsets[:-1])


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, lang, text) to (key, lang, buckets, counts)."""
    for b in batches:
        data, offsets = utf8(b.column(2))
        index, counts = [], []
        for i in range(b.num_rows):
            c = np.bincount(np.concatenate(grams(data[offsets[i]:offsets[i + 1]])), minlength=BUCKETS)
            at = np.flatnonzero(c)
            index.append(at.astype(np.int32))
            counts.append(c[at].astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [b.column(1), pa.array(index, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
            ["lang", "buckets", "counts"])


@dataclass
class Model:
    names: list[str]
    table: np.ndarray  # bucket x language: embeddings times weights
    bias: np.ndarray
    temperature: float = 1.0
    level: float = 0.0

    def softmax(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


class Shares:
    """Rows of bucket shares, kept sparse; an index gives them as a dense array."""

    def __init__(self, buckets: list, counts: list):
        self.rows = [(np.asarray(b, np.int64), np.asarray(c, np.float64) / max(1, sum(c))) for b, c in zip(buckets, counts)]

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, part: np.ndarray) -> np.ndarray:
        out = np.zeros((len(part), BUCKETS), np.float32)
        for i, j in enumerate(part):
            at, share = self.rows[j]
            out[i, at] = share
        return out

    def times(self, part: np.ndarray, table: np.ndarray) -> np.ndarray:
        runs = [self[part[f:f + 256]] @ table for f in range(0, len(part), 256)]
        return np.concatenate(runs) if runs else np.zeros((0, table.shape[1]), np.float32)


def fit(names: list[str], x: Shares, y: np.ndarray, s: Settings) -> Model:
    """Stochastic gradient descent on mean embeddings of the rows ``x`` and classes ``y``."""
    rng = np.random.default_rng(s.seed)
    order = rng.permutation(len(y))
    held = max(1, int(len(y) * s.calibration)) if len(y) > 3 else 0
    hold, train = order[:held], order[held:]
    emb = rng.normal(0, 0.1, (BUCKETS, s.dim)).astype(np.float32)
    w = rng.normal(0, 0.1, (s.dim, len(names))).astype(np.float32)
    b = np.zeros(len(names), np.float32)
    steps = s.epochs * max(1, -(-len(train) // s.batch))
    step = 0
    for _ in range(s.epochs):
        for part in np.array_split(rng.permutation(train), max(1, -(-len(train) // s.batch))):
            rate = s.rate * (1 - step / steps)
            step += 1
            xb = x[part]
            h = xb @ emb
            z = h @ w + b
            z = np.exp(z - z.max(axis=1, keepdims=True))
            g = z / z.sum(axis=1, keepdims=True)
            g[np.arange(len(part)), y[part]] -= 1
            g /= len(part)
            gh = g @ w.T
            w -= rate * (h.T @ g)
            b -= rate * g.sum(axis=0)
            # mean embeddings have small gradients, spread over all buckets of the text
            emb -= rate * 100 * (xb.T @ gh)
    m = Model(names, (emb @ w).astype(np.float32), b)
    if held:
        logits = x.times(hold, m.table) + m.bias
        losses = []
        for t in np.geomspace(0.1, 10, 41):
            m.temperature = float(t)
            p = m.softmax(logits)[np.arange(held), y[hold]]
            losses.append((-np.log(np.maximum(p, 1e-9)).mean(), abs(np.log(t)), float(t)))
        m.temperature = min(losses)[2]
        p = m.softmax(logits)
        score, right = p.max(axis=1), p.argmax(axis=1) == y[hold]
        # from the best scores down: the lowest score down to which few enough answers are wrong
        o = np.argsort(-score, kind="stable")
        wrong = np.cumsum(~right[o]) / np.arange(1, held + 1)
        good = np.flatnonzero(wrong <= s.most_wrong)
        m.level = float(score[o[good[-1]]]) if len(good) else 1.0
    return m


def in_fold(key: str):
    """The held-out fold: crc32 of the key's text, modulo 5, is 0. A null key is held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          settings: Settings = Settings()) -> Model:
    """Fit on a bounded sample of the rows of ``docs`` that carry a label."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
                       ).filter("lang is not null and text is not null")
    # the draw needs keys only; the drawn keys then fetch their texts
    keys = rows.select("key", "lang", F.xxhash64("text").alias("text"))
    keys = keys.withColumn("_draw", F.xxhash64("key", "text", F.lit(settings.seed)))
    # a row per language, of which the model holds a column each
    found = keys.groupBy("lang").agg(F.approx_count_distinct("_draw").alias("n")).collect()
    if not found:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32))
    each = max(1, min(settings.per_language, settings.rows // len(found)))
    limits = [(r["lang"], int(min(1.0, 2 * max(each, 50) / max(1, r["n"])) * DRAWS)) for r in found]
    limits = docs.sparkSession.createDataFrame(limits, "lang string, _limit long")
    low = keys.join(F.broadcast(limits), "lang").filter(F.pmod("_draw", F.lit(DRAWS)) < F.col("_limit"))
    w = Window.partitionBy("lang").orderBy("_draw", "key", "text")
    # copies are one row before they meet
    keys = (low.select("key", "lang", "text", "_draw").distinct().withColumn("_n", F.row_number().over(w))
            .filter(F.col("_n") <= each).select(F.col("key").alias("k"), F.col("lang").alias("l"), F.col("text").alias("t")))
    drawn = rows.join(F.broadcast(keys), F.col("key").eqNullSafe(F.col("k")) & (F.col("lang") == F.col("l"))
                      & (F.xxhash64("text") == F.col("t")), "left_semi")
    # a drawn row brings all its copies; one stays
    drawn = drawn.select("key", "lang", "text", F.xxhash64("text").alias("_t")).dropDuplicates(["key", "lang", "_t"])
    got = (drawn.select("key", "lang", "text")
           .mapInArrow(count_rows, "lang string, buckets array<int>, counts array<bigint>")
           .orderBy("lang", "buckets", "counts").collect())
    names = sorted({r["lang"] for r in got})
    x = Shares([r["buckets"] for r in got], [r["counts"] for r in got])
    return fit(names, x, np.array([names.index(r["lang"]) for r in got]), settings)


def score_rows(model: Model):
    """A mapInArrow function: (key, held_out, text) to (key, held_out, lang_pred, score, accepted)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, n = b.column(2), b.num_rows
            data, offsets = utf8(texts)
            logits = np.zeros((n, len(model.names)), np.float64)
            total = np.zeros(n)
            for lo, hi in row_chunks(offsets):
                base = offsets[lo]
                own = offsets[lo:hi + 1] - base
                for k, g in zip(ORDERS, grams(data[base:offsets[hi]])):
                    s, e = _spans(own, k)
                    total[lo:hi] += e - s
                    e = np.minimum(e, len(g))
                    s = np.minimum(s, e)
                    for c in range(len(model.names)):
                        cum = np.concatenate([[0.0], np.cumsum(model.table[g, c], dtype=np.float64)])
                        logits[lo:hi, c] += cum[e] - cum[s]
            low = (data >= 97) & (data <= 122) | (data >= 65) & (data <= 90)
            seen = np.concatenate([[0], np.cumsum(low)])
            letters = seen[offsets[1:]] > seen[offsets[:-1]]
            for i in np.flatnonzero(~letters & (offsets[1:] > offsets[:-1])):
                letters[i] = has_letter(texts[int(i)].as_py())
            if model.names:
                p = model.softmax(logits / np.maximum(total, 1)[:, None] + model.bias)
                best, score = p.argmax(axis=1), np.where(letters, p.max(axis=1), 0.0)
            else:
                letters, best, score = np.zeros(n, bool), np.zeros(n, int), np.zeros(n)
            names = [model.names[c] if ok else "und" for c, ok in zip(best, letters)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(names, pa.string()), pa.array(score),
                 pa.array(letters & (score >= model.level))],
                ["key", "held_out", "lang_pred", "score", "accepted"])
    return run


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, held_out, lang_pred, score, accepted``: one row per row."""
    small_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), in_fold(key).alias("held_out"), F.col(text).alias("text"))
    return rows.mapInArrow(score_rows(model), f"key {kind}, held_out boolean, lang_pred string, score double,"
                           " accepted boolean").withColumnRenamed("key", key)
