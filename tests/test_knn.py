"""kNN and SMOTE properties and edge cases."""

from collections import Counter

from pyspark.sql import functions as F

from rentrisk.operators.knn import knn, row_neighbours
from rentrisk.operators.lsh import knn_lsh
from rentrisk.operators.smote import SmoteSpec, synthetic_rows
from rentrisk.plans import registry as Q
from tests.conftest import SF01, SF1

D, C = Q.SMOTE_DISCRETE, Q.SMOTE_CONTINUOUS


def _rows(spark, data):
    return spark.createDataFrame(data, "id long, name string, house_id long, house_zip long, "
                                       "age double, rent_amount double, default_amount double")


def brute(rows, k):
    """Row-level neighbour attribute lists by brute force in Python."""
    rs = [r.asDict() for r in rows]
    known = {c: [r[c] for r in rs if r[c] is not None] for c in C}
    rng = {c: max(v) - min(v) if v else 0 for c, v in known.items()}

    def apart(c, x, y):
        if x is None or y is None:
            return 0.0 if x is y else 1.0
        return ((x - y) / rng[c]) ** 2 if rng[c] else 0.0
    out = {}
    for a in rs:
        cands = []
        for b in rs:
            if a["id"] == b["id"]:
                continue
            d2 = sum(apart(c, a[c], b[c]) for c in C)
            d2 += sum(0 if a[d] == b[d] else 1 for d in D)
            cands.append((d2, tuple((b[x] is not None, b[x]) for x in D + C)))
        cands.sort()
        out[a["id"]] = [round(x[0], 9) for x in cands[:min(k, len(rs) - 1)]]
    return out


def spark_lists(spark, df, res):
    nb = row_neighbours(df, "id", res, D, C).collect()
    got = {}
    for r in sorted(nb, key=lambda r: (r["id"], r["slot"])):
        got.setdefault(r["id"], []).append(round(r["d2"], 9))
    return got


def test_duplicates_and_small_k(spark):
    data = [(i, "a" if i < 6 else "b", 1, 2, 30.0, 700.0, 100.0) for i in range(8)] + \
           [(100 + i, f"n{i}", i % 3, 5, 20.0 + i, 500.0 + 7 * i, 50.0 * i) for i in range(12)]
    df = _rows(spark, data)
    for k in (1, 3, 10, 50):
        res = knn(df.select(*D, *C), D, C, k)
        assert spark_lists(spark, df, res) == brute(df.collect(), k)


def test_one_row_and_identical_rows(spark):
    one = _rows(spark, [(1, "x", 1, 1, 30.0, 700.0, 10.0)])
    res = knn(one.select(*D, *C), D, C, 10)
    assert res.k_eff == 0
    syn = synthetic_rows(one, SmoteSpec(D, C, 10, 3, 0), res).collect()
    assert len(syn) == 2 and all(r["age"] == 30.0 and r["name"] == "x" for r in syn)
    same = _rows(spark, [(i, "x", 1, 1, 30.0, 700.0, 10.0) for i in range(5)])
    syn = synthetic_rows(same, SmoteSpec(D, C, 10, 4, 0)).collect()
    assert len(syn) == 15 and {(r["age"], r["rent_amount"]) for r in syn} == {(30.0, 700.0)}


def test_constant_continuous_column(spark):
    data = [(i, f"n{i % 4}", i % 2, 1, 40.0, 600.0 + i, 25.0 * (i % 5)) for i in range(30)]
    df = _rows(spark, data)
    res = knn(df.select(*D, *C), D, C, 5)
    assert spark_lists(spark, df, res) == brute(df.collect(), 5)


def test_synthetic_between_parent_and_neighbour(spark):
    sample = Q.smote_sample(spark, SF01)
    syn = synthetic_rows(sample, SmoteSpec(D, C, 5, 4, 3))
    j = syn.join(sample.select(F.col("id").alias("parent_id"), *[F.col(c).alias(f"x_{c}") for c in C]), "parent_id")
    n = sample.count()
    assert syn.count() == 3 * n
    seen = {r[0] for r in sample.select("name").distinct().collect()}
    assert {r[0] for r in syn.select("name").distinct().collect()} <= seen
    mins = sample.agg(*[F.min(c).alias(c) for c in C]).collect()[0]
    maxs = sample.agg(*[F.max(c).alias(c) for c in C]).collect()[0]
    for c in C:
        assert j.where((F.col(c) < mins[c]) | (F.col(c) > maxs[c])).count() == 0


def _made(spark, n):
    """Lognormal amounts with one extreme outlier, few discrete values: large groups of very uneven density."""
    u = lambda s: (F.abs(F.xxhash64("id", F.lit(s))) % 1000003) / 1000003.0
    normal = lambda s: F.sqrt(-2 * F.log(u(s) + 1e-9)) * F.cos(6.283185307179586 * u(s + 100))
    return spark.range(n).select(
        "id", F.concat(F.lit("n"), (u(1) * 50).cast("int")).alias("name"), (u(2) * 5).cast("long").alias("house_id"),
        (u(3) * 3).cast("long").alias("house_zip"), F.floor(20 + 50 * u(4)).cast("double").alias("age"),
        F.exp(normal(5)).alias("rent_amount"),
        F.when(F.col("id") == 7, 1e9).otherwise(F.exp(2 * normal(6))).alias("default_amount"))


def _recall(spark, df, ex, ap):
    """Share of each row's exact neighbour distances that the approximate list holds."""
    a, b = spark_lists(spark, df, ex), spark_lists(spark, df, ap)
    assert {i: len(v) for i, v in a.items()} == {i: len(v) for i, v in b.items()}
    return sum(sum((Counter(v) & Counter(b[i])).values()) for i, v in a.items()) / sum(map(len, a.values()))


def test_candidates_do_not_grow_and_lsh_recall(spark):
    attrs, per_point = D + C, []
    for n in (1000, 8000):
        df = _made(spark, n).persist()
        ex = knn(df.select(*attrs), D, C, 10)
        per_point.append(ex.work.agg(F.avg("candidates")).first()[0])
        if n == 1000:
            assert spark_lists(spark, df, ex) == brute(df.collect(), 10)
            ap = knn_lsh(df.select(*attrs), D, C, 10, seed=1, bucket_size=32)
            assert ap.work is None or ap.work.count() < 0.05 * n
            assert _recall(spark, df, ex, ap) >= 0.9
        df.unpersist()
    assert per_point[1] < 2 * per_point[0]


def test_lsh_recall_on_the_minority(spark):
    sample = Q.smote_sample(spark, SF1)
    ex = knn(sample.select(*D, *C), D, C, 10)
    ap = knn_lsh(sample.select(*D, *C), D, C, 10, seed=1)
    assert ap.work is None or ap.work.count() < 0.05 * ex.n_rows
    assert _recall(spark, sample, ex, ap) >= 0.9


def test_null_distances(spark):
    data = []
    for i in range(150):
        data.append((i, None if i % 11 == 0 else f"n{i % 4}", i % 3 if i % 7 else None, 1,
                     None if i % 5 == 0 else 20.0 + i % 17, float("nan") if i % 13 == 0 else 500.0 + 7 * (i % 29),
                     None if i % 6 == 0 else 50.0 * (i % 8)))
    df = _rows(spark, data)
    plain = df.withColumn("rent_amount", F.when(~F.isnan("rent_amount"), F.col("rent_amount")))
    for k in (4, 12):
        assert spark_lists(spark, plain, knn(df.select(*D, *C), D, C, k, target=6)) == brute(plain.collect(), k)
    every = _rows(spark, [(i, "a", 1, 1, None, 5.0 + i, None) for i in range(6)])
    assert spark_lists(spark, every, knn(every.select(*D, *C), D, C, 3)) == brute(every.collect(), 3)


def test_hot_group_with_clumps_matches_brute_force(spark):
    # one "house" holds most rows; many share identical continuous values (clumps)
    data = []
    for i in range(120):
        data.append((i, f"t{i:03d}", 7, 107, 30.0 + (i % 3), 900.0, 900.0 if i % 4 else 450.0))
    for i in range(40):
        data.append((1000 + i, f"o{i:02d}", i % 5, 100 + i % 7, 20.0 + i, 500.0 + 10 * i, 25.0 * (i % 9)))
    df = _rows(spark, data)
    for k, limit, target in [(5, 2, 4.0), (10, 3, 8.0)]:
        res = knn(df.select(*D, *C), D, C, k, target=target, clump_limit=limit)
        assert spark_lists(spark, df, res) == brute(df.collect(), k), (k, limit)
        assert res.rounds >= 1


def test_hot_point_rows_join_broadcast_side(spark):
    # one attribute vector holds most rows: it goes through the broadcast side
    data = [(i, "h", 1, 1, 30.0, 700.0, 70.0) for i in range(3000)] + \
           [(10_000 + i, f"n{i}", i % 4, 2, 20.0 + i, 500.0 + i, 10.0 * i) for i in range(30)]
    df = _rows(spark, data)
    syn = synthetic_rows(df, SmoteSpec(D, C, 5, 3, 7))
    assert syn.count() == 2 * len(data)
    hot = syn.where(F.col("parent_id") < 3000)
    assert hot.where(F.col("age") != 30.0).count() == 0
    res = knn(df.select(*D, *C), D, C, 5)
    assert row_neighbours(df, "id", res, D, C).count() == 5 * len(data)


def test_lsh_clumps_and_short_buckets(spark):
    # many distinct points at one continuous value share every bucket; buckets of few points leave some too few candidates
    data = [(i, f"t{i:03d}", i % 3, 1, 30.0, 900.0, 90.0) for i in range(80)] + \
           [(500 + i, f"o{i}", 9, 2, 20.0 + i, 500.0 + 9 * i, 5.0 * i) for i in range(20)]
    df = _rows(spark, data)
    res = knn_lsh(df.select(*D, *C), D, C, 6, seed=3)
    assert spark_lists(spark, df, res) == brute(df.collect(), 6)
    short = spark_lists(spark, df, knn_lsh(df.select(*D, *C), D, C, 6, seed=3, bucket_size=3, bucket_length=0.3))
    assert all(len(v) == 6 for v in short.values()) and len(short) == 100
