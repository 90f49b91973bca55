"""Catalog tables: partitioned (and bucketed) Parquet / ORC tables.

A table is registered in the session catalog at an explicit location, so any
metastore (or the in-memory catalog) works. Writes go through ``insertInto`` with
dynamic partition overwrite: replacing ``ds=20190326`` leaves the other partitions
alone and registers the partition in the catalog as part of the same write.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITION_COL = "ds"


def _ddl_type(dt: T.DataType) -> str:
    return dt.simpleString()


@dataclass
class Table:
    """A ``ds``-partitioned table at ``path`` in format ``fmt`` (``parquet`` or ``orc``).

    Files per write (B6): ``files_per_bucket`` of a bucketed table; ``num_files``, or about ``file_bytes`` each, of another.
    """

    name: str
    path: str
    schema: T.StructType
    fmt: str = "parquet"
    bucket_col: str | None = None
    num_buckets: int = 16
    sort_col: str | None = None
    files_per_bucket: int | None = None
    num_files: int | None = None
    file_bytes: int | None = None

    # ---------------------------------------------------------------- DDL
    def create(self, spark: SparkSession) -> "Table":
        _mkdirs(spark, self.path)
        cols = ", ".join(f"`{f.name}` {_ddl_type(f.dataType)}" for f in self.schema.fields
                         if f.name != PARTITION_COL)
        clustered = ""
        if self.bucket_col:
            sort = f" SORTED BY ({self.sort_col})" if self.sort_col else ""
            clustered = f" CLUSTERED BY ({self.bucket_col}){sort} INTO {self.num_buckets} BUCKETS"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({cols}, `{PARTITION_COL}` string) USING {self.fmt} "
            f"PARTITIONED BY ({PARTITION_COL}){clustered} LOCATION '{self.path}'")
        return self

    # ---------------------------------------------------------------- writes
    def _prepared(self, df: DataFrame, ds: str) -> DataFrame:
        cols = [f.name for f in self.schema.fields if f.name != PARTITION_COL]
        out = df.select(*[F.col(c).cast(self.schema[c].dataType) for c in cols], F.lit(ds).alias(PARTITION_COL))
        if self.bucket_col:
            # Hash partitioning on the bucket column with a multiple of the bucket
            # count puts each bucket's rows in whole tasks: one file per task. By
            # default the multiple follows the session's shuffle parallelism, so a
            # large write is not funnelled through num_buckets tasks.
            per = self.files_per_bucket
            if per is None:
                sp = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
                per = max(1, sp // self.num_buckets)
            out = out.repartition(self.num_buckets * per, self.bucket_col)
        elif self.num_files:
            out = out.repartition(self.num_files)
        elif self.file_bytes:
            # rows are dealt into as many files as their measured shuffle bytes ask for
            out = out.hint("rebalance")
        return out

    def _write(self, df: DataFrame, ds: str, overwrite: bool) -> None:
        """The adaptive planner sizes the files by shuffle bytes; its settings hold for this write only."""
        conf = df.sparkSession.conf
        wanted = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(self.file_bytes),
                  "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"} if self.file_bytes else {}
        before = {k: conf.get(k, None) for k in wanted}
        try:
            for k, v in wanted.items():
                conf.set(k, v)
            self._prepared(df, ds).write.insertInto(self.name, overwrite=overwrite)
        finally:
            for k, v in before.items():
                conf.unset(k) if v is None else conf.set(k, v)

    def overwrite(self, df: DataFrame, ds: str) -> None:
        spark = df.sparkSession
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        self._write(df, ds, overwrite=True)

    def append(self, df: DataFrame, ds: str) -> None:
        self._write(df, ds, overwrite=False)

    def add_partition(self, spark: SparkSession, ds: str, location: str | None = None) -> None:
        """Register a partition at a location; a no-op when it exists."""
        loc = f" LOCATION '{location}'" if location else ""
        spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS PARTITION ({PARTITION_COL}='{ds}'){loc}")

    # ---------------------------------------------------------------- scans (A2, A3)
    def scan(self, spark: SparkSession, ds: str | None = None) -> DataFrame:
        df = spark.table(self.name)
        if ds is not None:
            # String literal: the partition column is a string (a numeric literal
            # would make Spark cast every partition value).
            df = df.where(F.col(PARTITION_COL) == F.lit(str(ds)))
        return df

    def partitions(self, spark: SparkSession) -> DataFrame:
        return spark.sql(f"SHOW PARTITIONS {self.name}")


def _mkdirs(spark: SparkSession, path: str) -> None:
    """Create the table location up front (Spark otherwise logs a missing-path trace)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def write_report(df: DataFrame, path: str, mode: str = "append", fmt: str = "parquet") -> None:
    """Append report rows to a path (one small file per write)."""
    df.coalesce(1).write.mode(mode).format(fmt).save(path)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """The database the tables live in."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def payment_schema() -> T.StructType:
    return T._parse_datatype_string(
        "id bigint, name string, age int, house_id int, house_zip int, payment_date date, "
        "payment_date_year int, payment_date_month int, payment_date_day_of_week int, "
        "payment_date_day_of_month int, payment_amount int, rent_amount int, default_amount int")


def train_schema() -> T.StructType:
    return T._parse_datatype_string(
        "id bigint, name string, age int, house_id int, house_zip int, rent_amount int, default_amount int, "
        "is_syn boolean")


def payment_table(name: str, path: str, num_buckets: int = 16, files_per_bucket: int | None = None) -> Table:
    """The ``payment`` table: partitioned by ds, bucketed by id, sorted by payment_date."""
    return Table(name=name, path=path, schema=payment_schema(), bucket_col="id", sort_col="payment_date",
                 num_buckets=num_buckets, files_per_bucket=files_per_bucket)


def train_table(name: str, path: str, num_files: int | None = None) -> Table:
    return Table(name=name, path=path, schema=train_schema(), num_files=num_files)


def external_text_table(spark: SparkSession, name: str, path: str, schema: T.StructType, sep: str = ",") -> None:
    """Delimited text below ``path`` as a catalog table, read as ``sources.delimited`` reads it; dropping it leaves the files."""
    cols = ", ".join(f"`{f.name}` {_ddl_type(f.dataType)}" for f in schema.fields)
    _mkdirs(spark, path)
    # an option of the table needs its backslash escaped once more than one of the reader
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING csv OPTIONS (sep '{sep}', quote '', escape '', header 'false', "
              f"nullValue '\\\\N', emptyValue '', mode 'PERMISSIVE') LOCATION '{path}'")


def report_table(spark: SparkSession, name: str, path: str, schema: str) -> None:
    """An unpartitioned Parquet table for report rows."""
    _mkdirs(spark, path)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet LOCATION '{path}'")


def append_report(df: DataFrame, name: str) -> None:
    """Append report rows through the catalog, columns by name."""
    table = df.sparkSession.table(name)
    df.select(*[F.col(f.name).cast(f.dataType) for f in table.schema.fields]).coalesce(1).write.insertInto(name, overwrite=False)


def files_per_partition(spark: SparkSession, name: str) -> DataFrame:
    """``ds, files, bytes, rows`` of a table, from the files' own metadata."""
    rows = spark.table(name).select(PARTITION_COL, "_metadata.file_path", "_metadata.file_size")
    files = rows.groupBy(PARTITION_COL, "file_path").agg(F.max("file_size").alias("size"), F.count(F.lit(1)).alias("n"))
    return files.groupBy(PARTITION_COL).agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"), F.sum("n").alias("rows"))
