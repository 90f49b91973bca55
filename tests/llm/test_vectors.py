"""Quality classifier, whitening and hard negatives against brute force, and their edge cases."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rentrisk.llm import negatives, queries, whitening
from rentrisk.llm import qualitymodel as qm
from tests.conftest import SF01
from tests.llm.test_llm import EDGE

CLASHES = ("row", "rb", "ab", "id", "vec", "anchor", "label2", "score", "rank", "scores", "ids", "x", "kind", "dim", "n", "z",
           "a", "b", "component", "at", "whitened", "key", "held_out", "y", "part", "predicted", "k", "l")


def clash(df):
    for c in CLASHES:
        if c not in df.columns:
            df = df.withColumn(c, F.lit("own"))
    return df


# ---- hard negatives

@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 7, 9), (65, 64, 200), (130, 129, 131), (0, 4, 3), (64, 200, 33)])
def test_strassen_is_exact(shape):
    rng = np.random.default_rng(sum(shape))
    a, b = rng.integers(-10**6, 10**6, shape[:2]), rng.integers(-10**6, 10**6, shape[1:])
    assert (negatives.strassen(a, b, 8) == a @ b).all()


def test_strassen_near_the_end_of_long():
    # sums in between wrap, the products fit
    rng = np.random.default_rng(1)
    a, b = rng.integers(-2**30, 2**30, (70, 66)), rng.integers(-2**26, 2**26, (66, 70))
    want = np.array([[sum(int(x) * int(y) for x, y in zip(r, c)) for c in b.T] for r in a])
    assert (negatives.strassen(a, b, 8) == want).all()


def plain_negatives(rows, pos=5, neg=5, low=80, high=100, scale=256, anchor=lambda k: k % 100 == 0):
    """rows: (id, label, vector); the contract, pair by pair."""
    good = [(k, c, v) for k, c, v in rows if None not in (k, c, v) and all(x is not None and np.isfinite(x) for x in v)]
    good = [(k, c, [int(np.floor(scale * float(x))) for x in v]) for k, c, v in good]
    out = []
    for i, (a, ca, va) in enumerate(good):
        if not anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), k, c) for j, (k, c, v) in enumerate(good) if j != i)
        for s, k, _ in [t for t in scored if t[2] == ca][:pos]:
            fits = [t for t in scored if t[2] != ca and low * -s <= 100 * -t[0] <= high * -s][:neg]
            out += [(a, k, r, t[1], -s, -t[0]) for r, t in enumerate(fits, 1)]
    return sorted(out)


def mined(df, **kw):
    return sorted(map(tuple, negatives.mine(df, F.col("vec_id") % 100 == 0, **kw).collect()))


SCHEMA = "vec_id long, label int, embedding array<float>"


def test_negatives_in_many_blocks(spark, monkeypatch):
    rng = np.random.default_rng(7)
    # few values, so that scores tie; repeated rows and ids
    rows = [(int(k), int(rng.integers(0, 3)), [float(x) for x in rng.integers(-2, 3, 6) / 4]) for k in range(0, 3000, 5)]
    rows += rows[:40] + [(500, 1, [0.5] * 6), (500, 2, [0.5] * 6)]
    monkeypatch.setattr(negatives, "BLOCK_BYTES", 256 * 48)
    monkeypatch.setattr(negatives, "TILE_ROWS", 64)
    monkeypatch.setattr(negatives, "TILE_ANCHORS", 8)
    assert mined(spark.createDataFrame(rows, SCHEMA)) == plain_negatives(rows)


def test_negatives_edge(spark):
    bad = [(0, None, [1.0, 1.0]), (0, 1, None), (100, 1, [None, 1.0]), (200, 1, [float("nan"), 1.0]),
           (200, 1, [float("inf"), 1.0]), (None, 1, [1.0, 1.0])]
    good = [(300, 1, [1.0, 0.0]), (301, 1, [1.0, 0.0]), (302, 1, [1.0, 0.0]), (303, 2, [0.9, 0.0]), (304, 2, [0.5, 0.0]),
            (305, 2, [0.8, 0.0]), (400, 3, [1.0, 0.0]), (500, 4, [-1.0, 0.0]), (501, 4, [1.0, 0.0]), (306, 2, [0.95]),
            (307, 2, [])]
    df = clash(spark.createDataFrame(bad + good, SCHEMA))
    padded = [(k, c, v and v + [0.0] * (2 - len(v))) for k, c, v in good if v] + [(307, 2, [0.0, 0.0])]
    want = plain_negatives(padded)
    assert mined(df) == want and want and not any(r[0] in (400, 500) for r in want)
    assert negatives.mine(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert negatives.mine(df, F.lit(False)).count() == 0
    with pytest.raises(Exception, match="does not fit into a long"):
        mined(spark.createDataFrame([(0, 1, [3e38]), (1, 1, [3e38])], SCHEMA))


# ---- whitening

def test_jacobi_davidson_spectra():
    rng = np.random.default_rng(0)
    g = rng.normal(size=(300, 300))
    cases = [(g @ g.T, 10), (np.eye(100), 32), (g[:, :5] @ g[:, :5].T, 32), (np.zeros((4, 4)), 3), (np.ones((1, 1)), 3),
             (np.diag(np.r_[np.full(50, 3.0), np.linspace(1, 2, 100), np.zeros(50)]), 32), (np.diag(10.0 ** -np.arange(64)), 32),
             (np.diag(1 + 1e-9 * np.arange(64)), 32)]
    for a, k in cases:
        values, axes, left = whitening.jacobi_davidson(lambda u: a @ u, len(a), k)
        want = np.linalg.eigvalsh(a)[::-1][:k]
        size = max(want[0], 1e-300)
        assert np.abs(values - want).max() <= 1e-12 * size and left.max() <= 2 * len(a) * whitening.EPS * size
        assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-12


def test_minres_solves():
    rng = np.random.default_rng(3)
    g = rng.normal(size=(30, 30))
    a, b = g + g.T, rng.normal(size=(30, 4))
    assert np.abs(a @ whitening.minres(lambda v: a @ v, b, 60, 1e-13) - b).max() < 1e-6


def test_whitening_brute_force(spark):
    src = spark.read.parquet(f"{SF01}/embeddings.parquet").toPandas()
    x = np.floor(64 * np.stack(src.embedding).astype(float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    off = n * x - sums
    cov = (off / n).T @ (off / n) / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1], q[:, ::-1]
    want = (off / n) @ q[:, :32] / np.sqrt(e[:32])
    got = queries.op12_whitening(spark, SF01).toPandas()
    assert list(got.columns[:7]) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    z = got.pivot(index="vec_id", columns="component", values="whitened").loc[src.vec_id].to_numpy()
    assert np.abs(z - want * np.sign((z * want).sum(axis=0))).max() < 1e-9
    deviation = got.groupby("vec_id").deviation.first().loc[src.vec_id].to_numpy()
    assert (deviation == (off ** 2).sum(axis=1)).all() and (got.n == n).all()
    assert np.abs(got.groupby("component").explained.first().to_numpy() / (e[:32] / e.sum()) - 1).max() < 1e-9
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9 and got.residual[0] < 64 * whitening.EPS


def test_whitening_edge(spark):
    schema = "vec_id long, embedding array<float>"
    bad = [(90, None), (91, [None, 1.0, 1.0]), (92, [float("nan"), 1.0, 1.0]), (93, []), (94, [float("inf"), 0.0, 0.0])]
    # one independent direction; ids null and repeated
    good = [(1, [0.0, 0.0, 1.0]), (1, [0.0, 0.0, 1.0]), (None, [1.0, 2.0, 1.0]), (3, [2.0, 4.0, 1.0])]
    got = whitening.whiten(clash(spark.createDataFrame(bad + good, schema))).collect()
    assert sorted((str(r.vec_id), r.component, r.n) for r in got) == [("1", 1, 4), ("1", 1, 4), ("3", 1, 4), ("None", 1, 4)]
    assert all(abs(r.explained - 1) < 1e-12 and r.identity_error < 1e-12 for r in got)
    x = np.array([[0, 0], [0, 0], [64, 128], [128, 256]])
    assert sorted(int(r.deviation) for r in got) == sorted(((4 * x - x.sum(axis=0)) ** 2).sum(axis=1).tolist())
    frame = lambda rows: whitening.whiten(spark.createDataFrame(rows, schema))
    assert frame([(1, [0.5, 1.0])]).count() == frame([(1, [0.5]), (2, [0.5])]).count() == frame(bad).count() == 0
    with pytest.raises(ValueError, match="no common covariance"):
        frame([(1, [1.0]), (2, [1.0, 2.0])])


# ---- quality classifier

def plain_statistics(text):
    """The statistics that can be counted plainly."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    size = max(len(text.encode()), 1)
    per = max(len(words), 1)
    lines = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in text.split("\n")]
    lines = [tuple(t) for t in lines if t]
    letters = max(sum(b >= 128 or chr(b).isalpha() for b in text.encode()), 1)
    triples = list(zip(words, words[1:], words[2:]))
    twice = Counter(triples)
    length = [len(w.encode()) for w in words]
    return {
        "log_words": np.log1p(len(words)), "word_length": np.log1p(sum(length) / per), "long_words": sum(x > 15 for x in length) / per,
        "short_words": sum(x <= 2 for x in length) / per, "upper_share": sum("A" <= c <= "Z" for c in text) / letters,
        "digit_share": sum(c in "0123456789" for c in text) / size, "bar_rate": text.count("|") / per,
        "shout_rate": np.log1p(text.count("!") / per), "symbol_rate": np.log1p(sum(c in "#*$%&<>" for c in text) / per),
        "log_lines": np.log1p(len(lines)), "repeated_lines": 1 - len(set(lines)) / len(lines) if lines else 0,
        "distinct_words": len(set(words)) / per, "top_word": max(Counter(words).values(), default=0) / per,
        "same_neighbours": sum(a == b for a, b in zip(words, words[1:])) / per,
        "repeated_triples": sum(c for c in twice.values() if c > 1) / max(len(words) - 2, 1),
    }


def test_statistics_brute_force(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("text").limit(300).collect()
    texts = [r.text for r in docs] + [t or "" for _, t in EDGE] + ["\n\n", "a\nb\na\n b", "x", " x", "x y", "A! A! A!"]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    z = qm.statistics(data, np.cumsum([0, *map(len, raw)]))
    for row, t in zip(z, texts):
        for name, value in plain_statistics(t).items():
            assert abs(row[qm.STATISTICS.index(name)] - value) < 1e-9, (name, t[:80])


def test_isotonic_is_least_squares():
    at = np.arange(6.0)
    places, shares = qm.isotonic(at, np.array([1, 0, 2, 1, 4, 3.0]), np.array([2, 2, 4, 4, 4, 4.0]))
    assert shares.tolist() == [0.25, 0.375, 0.875]
    got = np.interp(at, places, shares)
    assert (np.diff(got) >= 0).all()
    same = qm.isotonic(at, np.array([0, 0, 1, 2, 3, 4.0]), np.full(6, 4.0))
    assert same[1].tolist() == [0, 0.25, 0.5, 0.75, 1]


def test_normal_equations_give_the_ridge_solution(spark):
    rng = np.random.default_rng(4)
    z = rng.normal(size=(400, len(qm.STATISTICS)))
    y = (z[:, 0] + z[:, 1] ** 2 > 0.5).astype(float)
    rows = spark.createDataFrame([(v.tolist(), float(t), i % 4) for i, (v, t) in enumerate(zip(z, y))],
                                 "z array<double>, y double, part long").repartition(5)
    s = qm.Settings(features=64, ridge=1e-3)
    m = qm.fit(rows, s)
    x = m.features(z)
    assert np.abs(m.mean - z.mean(axis=0)).max() < 1e-12 and np.abs(m.scale - z.std(axis=0)).max() < 1e-12
    want = np.linalg.solve(x.T @ x + np.diag([s.ridge * len(z)] * 64 + [0]), x.T @ y)
    assert np.abs(m.raw(z) - x @ want).max() < 1e-8
    # the features' inner products approximate the Gaussian kernel
    wide = qm.Model(m.mean, m.scale, qm.directions(1 << 15, z.shape[1], 5) / s.width,
                    np.random.default_rng(1).uniform(0, 2 * np.pi, 1 << 15))
    f = wide.features(z[:40])[:, :-1]
    u = (z[:40] - m.mean) / m.scale
    kernel = np.exp(-((u[:, None] - u[None]) ** 2).sum(axis=2) / (2 * s.width ** 2))
    assert np.abs(f @ f.T - kernel).max() < 0.05


def test_quality_held_out(spark):
    got = {r.doc_id: r for r in queries.op11_quality_classifier(spark, SF01).collect()}
    held = lambda k: zlib.crc32(str(k).encode()) % 5 == 0
    assert len(got) == spark.read.parquet(f"{SF01}/documents.parquet").count()
    assert all(r.held_out == held(k) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for k, r in got.items())
    labels = spark.read.parquet(f"{SF01}/labels.parquet").collect()
    right = [got[r.doc_id].predicted == r.quality for r in labels if held(r.doc_id)]
    assert len(right) > 50 and np.mean(right) > 0.95
    good = [got[r.doc_id].predicted for r in labels if held(r.doc_id) and r.quality == 1]
    assert np.mean(good) > 0.98


def test_quality_edge(spark):
    docs = clash(spark.createDataFrame([(k, t) for k, t in EDGE], "doc_id long, text string"))
    labels = clash(spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, 0), (4, None), (5, 7), (6, 0), (None, 1)], "doc_id long, quality int"))
    got = qm.score(docs, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(k for k, _ in EDGE) and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [True]
    by_text = {}
    for r, t in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id)), sorted(EDGE, key=lambda e: (e[0] is None, e[0]))):
        by_text.setdefault(t[1] or "", set()).add(r.score)
    assert all(len(v) == 1 for v in by_text.values())
    assert {r.score for r in qm.score(docs, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in qm.score(docs, labels.filter("doc_id = 2")).collect()} <= {0.5, 1.0}
    assert qm.score(docs.limit(0), labels).count() == 0
