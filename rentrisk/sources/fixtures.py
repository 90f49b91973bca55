"""Raw payment rows derived from the driver's ``orders`` and ``customer`` tables.

Integer arithmetic only, so Spark and DuckDB produce the same rows. Every tenth
customer carries the 1900-01-01 placeholder birth date and every tenth a future
one; order keys divisible by 97 have no payment and by 101 a negative one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentrisk.session import table_path

RAW_COLUMNS = ["name", "dob", "house_id", "house_zip", "payment_date", "payment_amount", "rent_amount"]


def derived_raw(spark: SparkSession, sf_dir: str, with_key: bool = True) -> DataFrame:
    o = spark.read.parquet(table_path(sf_dir, "orders")).select("o_orderkey", "o_custkey", "o_orderdate")
    c = spark.read.parquet(table_path(sf_dir, "customer")).select("c_custkey", "c_name")
    j = o.join(c, o.o_custkey == c.c_custkey)
    ck, ok = F.col("c_custkey"), F.col("o_orderkey")
    born = F.date_add(F.lit("1950-01-01").cast("date"), (ck % 18000).cast("int"))
    cols = [
        F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")).alias("name"),
        F.when(ck % 10 == 0, F.lit("01/01/1900"))
        .when(ck % 10 == 1, F.lit("20990101"))
        .when(ck % 2 == 0, F.date_format(born, "MM/dd/yyyy"))
        .otherwise(F.date_format(born, "yyyyMMdd")).alias("dob"),
        (ck % 50).cast("int").alias("house_id"),
        (100 + ck % 20).cast("int").alias("house_zip"),
        F.when(ok % 2 == 0, F.date_format("o_orderdate", "MM/dd/yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("payment_date"),
        F.when(ok % 97 == 0, F.lit(None).cast("int"))
        .when(ok % 101 == 0, (F.lit(-1) * (500 + ok % 700)).cast("int"))
        .otherwise((500 + ck % 2000).cast("int")).alias("payment_amount"),
        (500 + ck % 2000).cast("int").alias("rent_amount"),
    ]
    if with_key:
        cols.append(ok.alias("src_key"))
    return j.select(*cols)


# DuckDB form of the same table, used by the SQL oracles.
DERIVED_RAW_SQL = """
select ' ' || c_name || ' ' as name,
  case when c_custkey % 10 = 0 then '01/01/1900'
       when c_custkey % 10 = 1 then '20990101'
       when c_custkey % 2 = 0
         then strftime(date '1950-01-01' + cast(c_custkey % 18000 as int), '%m/%d/%Y')
       else strftime(date '1950-01-01' + cast(c_custkey % 18000 as int), '%Y%m%d')
  end as dob,
  cast(c_custkey % 50 as int) as house_id,
  cast(100 + c_custkey % 20 as int) as house_zip,
  case when o_orderkey % 2 = 0 then strftime(o_orderdate, '%m/%d/%Y')
       else strftime(o_orderdate, '%Y%m%d') end as payment_date,
  case when o_orderkey % 97 = 0 then null
       when o_orderkey % 101 = 0 then cast(-1 * (500 + o_orderkey % 700) as int)
       else cast(500 + c_custkey % 2000 as int) end as payment_amount,
  cast(500 + c_custkey % 2000 as int) as rent_amount,
  o_orderkey as src_key
from orders join customer on o_custkey = c_custkey
"""
