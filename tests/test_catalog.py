"""Catalog tables, files per partition, written order and model versions."""

import pytest
from pyspark.sql import functions as F

from rentrisk.operators import gram as G
from rentrisk.operators import order as ORD
from rentrisk.operators import versions as V
from rentrisk.session import scratch_path
from rentrisk.sources import tables as TB
from rentrisk.sources.delimited import RAW_SCHEMA, read_delimited


def _db(spark):
    path = scratch_path(spark, "db")
    name = "db_" + path.rsplit("-", 1)[1]
    TB.create_database(spark, name, path)
    return name


def test_external_text_table_reads_as_the_scan(spark):
    path, db = scratch_path(spark, "raw"), _db(spark)
    lines = [' A ,01/02/1990,1,2,20200101,5,6', 'B,x,\\N,zz,,\\N,7,extra', 'short,1', '"q",2,3,4,5,6,7', 'back\\slash,2,3,4,5,6,7']
    spark.createDataFrame([(t,) for t in lines], "value string").coalesce(1).write.text(path)
    TB.external_text_table(spark, f"{db}.raw", path, RAW_SCHEMA)
    got, want = spark.table(f"{db}.raw").collect(), read_delimited(spark, path).collect()
    assert got == want and got[0]["name"] == " A " and got[1]["house_id"] is None and got[3]["name"] == '"q"'
    spark.sql(f"DROP TABLE {db}.raw")
    assert spark.read.text(path).count() == len(lines)


def test_reports_append_by_name(spark):
    name = f"{_db(spark)}.test"
    TB.report_table(spark, name, scratch_path(spark, "rep"), "model string, r2 double")
    TB.append_report(spark.createDataFrame([(0.5, "a")], "r2 double, model string"), name)
    TB.append_report(spark.createDataFrame([("b", 1)], "model string, r2 int"), name)
    assert sorted(map(tuple, spark.table(name).collect())) == [("a", 0.5), ("b", 1.0)]


def test_files_follow_the_size(spark):
    schema = spark.range(1).select("id", F.lit("").alias("v")).schema
    path = scratch_path(spark, "files")
    name = "files_" + path.rsplit("-", 1)[1]
    rows = spark.range(0, 60000, 1, 6).select("id", F.sha2(F.col("id").cast("string"), 512).alias("v"))
    conf = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(conf, None)
    TB.Table(name, path, schema, file_bytes=64 << 20).create(spark).overwrite(rows, "1")
    TB.Table(name, path, schema, file_bytes=1 << 20).overwrite(rows, "2")
    TB.Table(name, path, schema, num_files=3).append(rows, "3")
    assert spark.conf.get(conf, None) == before
    got = {r.ds: r for r in TB.files_per_partition(spark, name).collect()}
    assert got["1"].files == 1 and got["2"].files > 3 and got["3"].files == 3
    assert all(r["rows"] == 60000 and r.bytes > 0 for r in got.values())


def test_written_order_is_read_back(spark):
    path = scratch_path(spark, "ordered")
    rows = spark.range(0, 20000).select(((F.col("id") * 7919) % 20011).alias("k"), "id").repartition(7)
    ORD.write_ordered(rows, path, "k")
    got = ORD.read_positions(spark, path)
    assert got.select("id").distinct().count() == 20000
    ranks = {k: i for i, k in enumerate(sorted((i * 7919) % 20011 for i in range(20000)), 1)}
    assert all(r.position == ranks[r.k] for r in got.collect())


def test_versions(spark):
    prefix = scratch_path(spark, "model/m")
    cv = G.CrossValidated([(0.1, 0, None, 0.5), (1.0, 0, None, 0.25)], G.Lasso(0.1, G.np.array([2.0, 0.0]), 1.0), [("a", None), ("b", "x")])
    with pytest.raises(FileNotFoundError):
        V.newest(spark, prefix)
    first = V.save(spark, cv, prefix, "20200101_000000")
    second = V.save(spark, cv, prefix, "20210101_000000")
    spark.range(1).write.parquet(f"{prefix}_notes")
    assert V.versions(spark, prefix) == [first, second] and V.newest(spark, prefix) == second
    with pytest.raises(ValueError):
        V.save(spark, cv, prefix, "today")
    with pytest.raises(Exception, match="exist"):
        V.save(spark, cv, prefix, "20210101_000000")
    assert sorted(map(tuple, V.load(spark, first).collect()), key=str) == sorted([("(intercept)", None, 1.0), ("a", None, 2.0)], key=str)
    reports = V.report(spark, cv, first).union(V.report(spark, cv, second)).union(
        spark.createDataFrame([("z_20220101_000000", 0.1, float("nan"), True), ("y_20220101_000000", 0.1, 0.9, False)], V.REPORT))
    assert tuple(V.best(reports).first()) == (second, 0.1, 0.5)
