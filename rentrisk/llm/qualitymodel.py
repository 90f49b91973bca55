"""Quality scores: ridge regression on random Fourier features of document statistics, then isotonic calibration.

A text, whole, is measured by ``STATISTICS`` in numpy, one pass per Arrow batch: shares of kinds of characters, lengths and
repetition of words and lines. Standardised statistics z become cosines of random projections,
``sqrt(2 / D) * cos(W z + b)`` with normal W, whose inner products approximate a Gaussian kernel (Rahimi and Recht). Each task sums the
normal equations of its labelled rows, Spark adds those up cell by cell, and the driver solves one system of D + 1 unknowns.
All labelled rows of the training fold take part. For the calibration they are dealt into ``Settings.parts``, each scored by
the equations of the others; these raw scores are counted on a fixed grid, and pool-adjacent-violators over the grid gives shares
of good rows that rise with the raw score, joined by straight lines.

Null text counts as empty; empty and blank texts have statistics (all zero) and a score like any other. A text of any length is measured whole.
Repeated rows and null keys get their rows; null keys are held out. A document labelled several times has the mean of its labels; null labels and
labels other than 0 and 1 do not count. Without labels in the training fold the score is 0.5; with one class only,
that class. An empty table gives an empty result. Only the named columns are read, and only the text enters a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentrisk.llm.ann import directions
from rentrisk.llm.common import mix64, random64, row_chunks, small_batches, sum_batches, utf8, vectors, word_bounds
from rentrisk.llm.langid import in_fold
from rentrisk.session import materialize

STATISTICS = ["log_words", "word_length", "word_spread", "long_words", "short_words", "upper_share", "upper_words", "digit_share",
              "symbol_rate", "stop_mark_rate", "shout_rate", "bar_rate", "other_marks", "high_share", "log_lines",
              "words_per_line", "repeated_lines", "distinct_words", "top_word", "same_neighbours", "repeated_triples"]

# kinds of bytes
LOWER, UPPER, DIGIT, SYMBOL, MARK, SHOUT, BAR, OTHER, HIGH, BLANK, LINE = range(11)


def _kinds() -> np.ndarray:
    t = np.full(256, OTHER, np.uint8)
    t[128:] = HIGH
    for kind, chars in ((LOWER, b"abcdefghijklmnopqrstuvwxyz"), (UPPER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (DIGIT, b"0123456789"),
                        (SYMBOL, b"#*$%&<>"), (MARK, b".,;:?'\"-()"), (SHOUT, b"!"), (BAR, b"|"), (BLANK, b"\t\x0b\x0c\r "), (LINE, b"\n")):
        t[list(chars)] = kind
    return t


KINDS = _kinds()
#: A word's hash adds up a number per byte and place; places repeat after 64.
LETTERS = random64(256 * 64, 17)


@dataclass(frozen=True)
class Settings:
    features: int = 256
    width: float = 5.0
    ridge: float = 1e-5
    parts: int = 4
    grid: int = 4096
    seed: int = 23


# ---- statistics

def _repeats(owner: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per owner: different values, times the commonest value occurs, occurrences of values met twice or more."""
    if not len(value):
        return np.zeros(n), np.zeros(n), np.zeros(n)
    # one number to sort by: the owner in the upper bits, as much of the hash as fits in the lower ones
    bits = np.uint64(64 - max(1, int(n).bit_length()))
    key = np.sort(owner.astype(np.uint64) << bits | value >> (np.uint64(64) - bits))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(first, len(key)))
    at = (key[first] >> bits).astype(np.int64)
    top = np.zeros(n)
    head = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    top[at[head]] = np.maximum.reduceat(size, head)
    return np.bincount(at, minlength=n), top, np.bincount(at, weights=np.where(size > 1, size, 0), minlength=n)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts x STATISTICS of texts laid end to end."""
    n = len(offsets) - 1
    row = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
    kind = KINDS[data]
    count = np.bincount(row * 16 + kind, minlength=n * 16).reshape(n, 16).astype(np.float64)
    start, end = word_bounds(data, offsets)
    owner = row[start] if len(start) else np.zeros(0, np.int64)
    length = (end - start).astype(np.float64)
    words = np.bincount(owner, minlength=n).astype(np.float64)
    per = np.maximum(words, 1)
    total = np.bincount(owner, weights=length, minlength=n)
    mean = total / per
    spread = np.sqrt(np.maximum(np.bincount(owner, weights=length * length, minlength=n) / per - mean * mean, 0))
    share = lambda mask: np.bincount(owner, weights=mask, minlength=n) / per
    if len(start):
        place = np.arange(len(data)) - np.repeat(np.append(0, start), np.diff(np.concatenate([[0], start, [len(data)]])))
        ink = (kind != BLANK) & (kind != LINE)
        code = np.where(ink, LETTERS[data.astype(np.int64) * 64 + (place & 63)], np.uint64(0))
        word = mix64(np.add.reduceat(code, start))
        big = np.add.reduceat((kind == UPPER).astype(np.int32), start)
        small = np.add.reduceat((kind == LOWER).astype(np.int32), start)
    else:
        word, big, small = np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)
    distinct, top, _ = _repeats(owner, word, n)
    same = np.zeros(len(word))
    same[1:] = (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])
    m = max(0, len(word) - 2)
    whole = owner[:m] == owner[2:] if m else np.zeros(0, bool)
    triple = mix64(word[:m] + np.uint64(3) * word[1:m + 1] + np.uint64(7) * word[2:])[whole] if m else word[:0]
    triples = np.maximum(words - 2, 1)
    again = _repeats(owner[:m][whole], triple, n)[2] if m else np.zeros(n)
    # lines with a word: hashed as the sum of their words' hashes by place
    if len(start):
        breaks = np.cumsum(kind == LINE)
        line = breaks[start]
        new = np.concatenate([[True], (line[1:] != line[:-1]) | (owner[1:] != owner[:-1])])
        head = np.flatnonzero(new)
        at = np.arange(len(word)) - np.repeat(head, np.diff(np.append(head, len(word))))
        lines_hash = mix64(np.add.reduceat(word * (2 * at.astype(np.uint64) + np.uint64(1)), head))
        lines = np.bincount(owner[head], minlength=n).astype(np.float64)
        different = _repeats(owner[head], lines_hash, n)[0]
    else:
        lines, different = np.zeros(n), np.zeros(n)
    letters = np.maximum(count[:, LOWER] + count[:, UPPER] + count[:, HIGH], 1)
    size = np.maximum(np.diff(offsets), 1)
    return np.column_stack([
        np.log1p(words), np.log1p(mean), np.log1p(spread), share(length > 15), share(length <= 2), count[:, UPPER] / letters,
        share((big > 1) & (small == 0)), count[:, DIGIT] / size, np.log1p(count[:, SYMBOL] / per), count[:, MARK] / per,
        np.log1p(count[:, SHOUT] / per), count[:, BAR] / per, count[:, OTHER] / size, count[:, HIGH] / size, np.log1p(lines),
        np.log1p(words / np.maximum(lines, 1)), 1 - different / np.maximum(lines, 1) * (lines > 0) - (lines == 0),
        distinct / per, top / per, share(same), np.minimum(again / triples, 1)])


def measure_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, held_out, text) to (key, held_out, z)."""
    k = len(STATISTICS)
    for b in batches:
        data, offsets = utf8(b.column(2))
        found = [statistics(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]) for lo, hi in row_chunks(offsets)]
        flat = np.concatenate(found).ravel() if found else np.zeros(0)
        z = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * k, pa.int32()), pa.array(flat, pa.float64()))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), z], ["key", "held_out", "z"])


# ---- features and fit

@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    axes: np.ndarray
    phase: np.ndarray
    weights: np.ndarray | None = None
    knots: np.ndarray | None = None
    shares: np.ndarray | None = None
    constant: float = 0.5

    def features(self, z: np.ndarray) -> np.ndarray:
        """Rows x (D + 1): the cosines and a one."""
        u = np.clip((z - self.mean) / self.scale, -6, 6)
        cosines = np.cos(u @ self.axes.T + self.phase) * np.sqrt(2 / len(self.phase))
        return np.column_stack([cosines, np.ones(len(z))])

    def raw(self, z: np.ndarray) -> np.ndarray:
        return self.features(z) @ self.weights

    def score(self, z: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(z), self.constant)
        raw = self.raw(z)
        return np.clip(np.interp(raw, self.knots, self.shares), 0.0, 1.0)


def isotonic(at: np.ndarray, good: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: places and never falling shares of the pools of ``good`` out of ``n`` rows at places ``at``."""
    pools: list[list[float]] = []
    for x, g, c in zip(at, good, n):
        pools.append([x * c, g, c])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    p = np.array(pools)
    return p[:, 0] / p[:, 2], p[:, 1] / p[:, 2]


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, held_out, z``: the statistics of every row, written out, as training and scoring both read them."""
    small_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), in_fold(key).alias("held_out"), F.col(text).alias("text"))
    return materialize(rows.mapInArrow(measure_rows, f"key {kind}, held_out boolean, z array<double>"), "quality-statistics")


def solve(cells: np.ndarray, features: int, ridge: float) -> np.ndarray:
    """The weights of summed normal equations: lower triangle, products with y, rows; the constant is not shrunk."""
    low = np.tril_indices(features + 1)
    gram = np.zeros((features + 1, features + 1))
    gram[low] = cells[:len(low[0])]
    gram = gram + np.tril(gram, -1).T
    gram[np.arange(features), np.arange(features)] += ridge * max(1.0, cells[-1])
    return np.linalg.lstsq(gram, cells[len(low[0]):-1], rcond=1e-13)[0]


def fit(rows: DataFrame, settings: Settings) -> Model:
    """From ``z``, ``y`` and ``part`` of the labelled rows; three sums over all of them and a count per grid cell."""
    s, k, d = settings, len(STATISTICS), settings.features
    n, least, most = rows.agg(F.count("*"), F.min("y"), F.max("y")).first()
    if not n or least == most:
        return Model(*[np.zeros(0)] * 4, constant=float(least) if n else 0.5)
    read = lambda b: vectors(b.column(0), k)
    numbers = lambda b, i: b.column(i).to_numpy(zero_copy_only=False)
    mean = sum_batches(rows, k, lambda b: read(b).sum(axis=0)) / n
    spread = np.sqrt(sum_batches(rows, k, lambda b: ((read(b) - mean) ** 2).sum(axis=0)) / n)
    phase = (random64(d, s.seed + 1) >> np.uint64(11)).astype(np.float64) * (2 * np.pi / (1 << 53))
    model = Model(mean, np.where(spread > 1e-9, spread, 1.0), directions(d, k, s.seed) / s.width, phase)
    low = np.tril_indices(d + 1)
    size = len(low[0]) + d + 2

    def normal(b: pa.RecordBatch) -> np.ndarray:
        x, y, part = model.features(read(b)), numbers(b, 1), numbers(b, 2)
        out = np.zeros((s.parts, size))
        for f in np.unique(part):
            xf = x[part == f]
            out[f] = np.concatenate([(xf.T @ xf)[low], xf.T @ y[part == f], [len(xf)]])
        return out.ravel()

    cells = sum_batches(rows, s.parts * size, normal).reshape(s.parts, size)
    total = cells.sum(axis=0)
    model.weights = solve(total, d, s.ridge)
    apart = np.stack([solve(total - c, d, s.ridge) for c in cells])

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = (model.features(read(b)) * apart[numbers(b, 2)]).sum(axis=1)
            # raw scores lie around 0 and 1; the grid covers -0.5 to 1.5
            cell = np.minimum(np.floor(np.clip((raw + 0.5) / 2, 0, 1) * s.grid), s.grid - 1)
            yield pa.RecordBatch.from_arrays([pa.array(cell), b.column(1)], ["cell", "y"])

    counted = (rows.mapInArrow(places, "cell double, y double").groupBy("cell")
               .agg(F.sum("y").alias("good"), F.count("*").alias("n")).orderBy("cell").collect())
    at = np.array([(r["cell"] + 0.5) / s.grid * 2 - 0.5 for r in counted])
    model.knots, model.shares = isotonic(at, np.array([r["good"] for r in counted]), np.array([r["n"] for r in counted], float))
    return model


def train(measured: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality",
          settings: Settings = Settings()) -> Model:
    """Fit on the labelled rows of ``measured`` that are not held out."""
    known = labels.select(F.col(key).alias("k"), F.col(label).cast("double").alias("l")).filter("k is not null and l in (0, 1)")
    known = known.groupBy("k").agg(F.avg("l").alias("y"))
    rows = measured.filter(~F.col("held_out")).join(known, F.col("key") == F.col("k"))
    part = F.pmod(F.xxhash64("key", F.lit(settings.seed)), F.lit(settings.parts).cast("long"))
    return fit(materialize(rows.select("z", "y", part.alias("part")), "quality-labelled"), settings)


def predict(measured: DataFrame, model: Model, key: str = "doc_id", least: float = 0.3) -> DataFrame:
    """``key, held_out, score, predicted``: one row per row; ``predicted`` is 1 from a score of ``least`` on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = model.score(vectors(b.column(2), len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(score),
                                              pa.array((score >= least).astype(np.int32))], ["key", "held_out", "score", "predicted"])

    kind = measured.schema["key"].dataType.simpleString()
    return measured.select("key", "held_out", "z").mapInArrow(
        run, f"key {kind}, held_out boolean, score double, predicted int").withColumnRenamed("key", key)


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          settings: Settings = Settings(), least: float = 0.3) -> DataFrame:
    """Learn from ``labels`` outside the held-out fold and score every row of ``docs``."""
    measured = measure(docs, key, text)
    return predict(measured, train(measured, labels, key, label, settings), key, least)
