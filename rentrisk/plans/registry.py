"""Query registry: one Spark callable and (where SQL can express it) one oracle per operator.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the driver's
whole tables; the matching SQL runs in DuckDB on the same parquet files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentrisk.functions.amounts import default_amount, payment_amount
from rentrisk.functions.dates import age_years, clean_dob, date_parts, parse_local_date
from rentrisk.plans import oracle as O
from rentrisk.plans.clean import DEFAULT_AS_OF, DEFAULT_DOB, clean_payments, trim_raw
from rentrisk.operators.ids import dense_random_id
from rentrisk.session import table_path
from rentrisk.sources.fixtures import DERIVED_RAW_SQL, derived_raw

SEED = 11
AS_OF_SQL = "date '2019-03-26'"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def payments(spark: SparkSession, sf_dir: str, keep_key: bool = True) -> DataFrame:
    """The cleaned payment table of the derived raw rows (flow 1)."""
    return clean_payments(derived_raw(spark, sf_dir), as_of=DEFAULT_AS_OF, default_dob=DEFAULT_DOB,
                          seed=SEED, key_cols=["src_key"], distinct_keys=True, keep_key=keep_key)


# ---------------------------------------------------------------- flow 1: clean

@register("clean_dates", f"""
select src_key, {O.clean_dob('trim(dob)', DEFAULT_DOB, AS_OF_SQL)} as dob,
       {O.parse_date('trim(payment_date)')} as payment_date
from ({DERIVED_RAW_SQL})""")
def q_clean_dates(spark, sf_dir):
    t = trim_raw(derived_raw(spark, sf_dir), ["src_key"])
    return t.select("src_key", clean_dob("dob", DEFAULT_DOB, DEFAULT_AS_OF).alias("dob"),
                    parse_local_date("payment_date").alias("payment_date"))


@register("clean_age", f"""
select src_key, {O.age(O.clean_dob('trim(dob)', DEFAULT_DOB, AS_OF_SQL), AS_OF_SQL)} as age
from ({DERIVED_RAW_SQL})""")
def q_clean_age(spark, sf_dir):
    t = trim_raw(derived_raw(spark, sf_dir), ["src_key"])
    return t.select("src_key", age_years(clean_dob("dob", DEFAULT_DOB, DEFAULT_AS_OF), DEFAULT_AS_OF).alias("age"))


@register("clean_date_parts", f"""
select src_key, cast(year(d) as int) as payment_date_year, cast(month(d) as int) as payment_date_month,
       cast(isodow(d) as int) as payment_date_day_of_week, cast(day(d) as int) as payment_date_day_of_month
from (select src_key, {O.parse_date('trim(payment_date)')} as d from ({DERIVED_RAW_SQL}))""")
def q_clean_date_parts(spark, sf_dir):
    t = trim_raw(derived_raw(spark, sf_dir), ["src_key"])
    return t.select("src_key", *date_parts(parse_local_date("payment_date"), "payment_date"))


@register("clean_payment_amount", f"""
select src_key, p as payment_amount, r - p as default_amount
from (select src_key, coalesce(rent_amount, 0) as r,
             case when payment_amount is null then 0 else least(abs(payment_amount), coalesce(rent_amount, 0)) end as p
      from ({DERIVED_RAW_SQL}))""")
def q_clean_payment_amount(spark, sf_dir):
    raw = derived_raw(spark, sf_dir)
    rent = F.coalesce("rent_amount", F.lit(0))
    p = payment_amount("payment_amount", rent)
    return raw.select("src_key", p.alias("payment_amount"), default_amount(rent, p).alias("default_amount"))


@register("clean_payments", O.payments_sql(SEED))
def q_clean_payments(spark, sf_dir):
    return payments(spark, sf_dir)


@register("dense_random_id", f"""
select l_orderkey, l_linenumber,
       row_number() over (order by {O.hash60(SEED, 'l_orderkey', 'l_linenumber')}, l_orderkey, l_linenumber) as id
from lineitem""")
def q_dense_random_id(spark, sf_dir):
    # (l_orderkey, l_linenumber) repeats in the driver's data, so this runs the
    # duplicate-collapsing path; identical rows are interchangeable.
    li = spark.read.parquet(table_path(sf_dir, "lineitem")).select("l_orderkey", "l_linenumber")
    return dense_random_id(li, SEED)


# ---------------------------------------------------------------- scans, splits, set ops

from rentrisk.operators import rows as R  # noqa: E402
from rentrisk.operators import split as S  # noqa: E402
from rentrisk.operators.setops import union_by_first  # noqa: E402
from rentrisk.session import materialize, scratch_path  # noqa: E402
from rentrisk.sources.delimited import read_delimited, write_delimited  # noqa: E402
from rentrisk.sources.fixtures import RAW_COLUMNS  # noqa: E402
from rentrisk.sources.tables import Table  # noqa: E402

DS = "20190326"
DS_PREV = "20190325"
RAW_N_SQL = "(select count(*) from orders join customer on o_custkey = c_custkey)"
CUT_SQL = f"({RAW_N_SQL} * 7 // 10 + 1)"
PAYMENTS = f"({O.payments_sql(SEED)})"


def train_cut(n_rows: int) -> int:
    """First test id: the first 70% of the random ids train, the rest test."""
    return n_rows * 7 // 10 + 1


def _cut(spark, sf_dir) -> int:
    return train_cut(derived_raw(spark, sf_dir, with_key=False).count())


def payment_table(spark: SparkSession, sf_dir: str, fmt: str = "parquet", bucketed: bool = True) -> Table:
    schema = payments(spark, sf_dir, keep_key=False).schema
    name = "payment_" + scratch_path(spark, "t").rsplit("-", 1)[1]
    kw = dict(bucket_col="id", sort_col="payment_date", num_buckets=16) if bucketed else {}
    return Table(name=name, path=scratch_path(spark, name), schema=schema, fmt=fmt, **kw).create(spark)


def loaded_payment_table(spark, sf_dir) -> Table:
    t = payment_table(spark, sf_dir)
    t.overwrite(payments(spark, sf_dir, keep_key=False), DS)
    return t


@register("scan_delimited", f"select {', '.join(RAW_COLUMNS)} from ({DERIVED_RAW_SQL})")
def q_scan_delimited(spark, sf_dir):
    path = scratch_path(spark, "raw")
    write_delimited(derived_raw(spark, sf_dir, with_key=False), path)
    return read_delimited(spark, path)


@register("scan_pruned", f"select * exclude (src_key), '{DS}' as ds from {PAYMENTS} where id < {CUT_SQL}")
def q_scan_pruned(spark, sf_dir):
    t = loaded_payment_table(spark, sf_dir)
    return t.scan(spark, DS).where(F.col("id") < F.lit(_cut(spark, sf_dir)))


@register("train_split", f"""
select id, name, age, house_id, house_zip, rent_amount, default_amount, false as is_syn
from {PAYMENTS} where id < {CUT_SQL}""")
def q_train_split(spark, sf_dir):
    return S.train_rows(payments(spark, sf_dir), _cut(spark, sf_dir))


@register("test_split", f"""
select default_amount as label, name, age, house_id, house_zip, rent_amount, id
from {PAYMENTS} where id >= {CUT_SQL}""")
def q_test_split(spark, sf_dir):
    return S.test_rows(payments(spark, sf_dir), _cut(spark, sf_dir))


CLASS_COUNTS_SQL = f"""
select cast(count_if(default_amount = 0) as bigint) as majority,
       cast(count_if(default_amount <> 0) as bigint) as minority
from {PAYMENTS} where id < {CUT_SQL}"""


@register("class_counts", CLASS_COUNTS_SQL)
def q_class_counts(spark, sf_dir):
    return S.class_counts(S.train_rows(payments(spark, sf_dir), _cut(spark, sf_dir)))


@register("size_multiplier", f"""
select majority, minority,
       case when minority > 0 then greatest(cast(majority // minority as int), 2) end as multiplier
from ({CLASS_COUNTS_SQL})""")
def q_size_multiplier(spark, sf_dir):
    return S.size_multiplier(S.class_counts(S.train_rows(payments(spark, sf_dir), _cut(spark, sf_dir))))


@register("replace_field", f"select * replace (upper(name) as name) from {PAYMENTS}")
def q_replace_field(spark, sf_dir):
    return R.replace_field(payments(spark, sf_dir), "name", F.upper("name"))


@register("cast_trunc", f"""
select id, cast(house_id as bigint) as house_id, cast(age as double) as age_d,
       cast(trunc(cast(rent_amount as double) / 7) as int) as rent_sevenths,
       cast(trunc(-(cast(default_amount as double) / 7)) as int) as neg_default_sevenths
from {PAYMENTS}""")
def q_cast_trunc(spark, sf_dir):
    p = R.widen(payments(spark, sf_dir), ["house_id"], ["age", "rent_amount", "default_amount"])
    return p.select("id", "house_id", F.col("age").alias("age_d"),
                    R.truncate_to_int(F.col("rent_amount") / 7).alias("rent_sevenths"),
                    R.truncate_to_int(-(F.col("default_amount") / 7)).alias("neg_default_sevenths"))


@register("union_by_name", f"""
select id, name, default_amount, false as is_syn from {PAYMENTS}
union all
select id, name, default_amount, true as is_syn from {PAYMENTS} where default_amount <> 0""")
def q_union_by_name(spark, sf_dir):
    p = payments(spark, sf_dir)
    left = p.select("id", "name", "default_amount", F.lit(False).alias("is_syn"))
    # different column order plus an extra column that the union drops
    right = S.minority(p).select(F.lit(True).alias("is_syn"), "default_amount", "rent_amount", "name", "id")
    return union_by_first(left, right)


# ---------------------------------------------------------------- sinks, read back

def _overwrite_flow(spark, sf_dir, fmt):
    t = payment_table(spark, sf_dir, fmt=fmt, bucketed=(fmt == "parquet"))
    p = payments(spark, sf_dir, keep_key=False)
    t.overwrite(p, DS)                   # first load of the day
    t.overwrite(S.minority(p), DS_PREV)  # another partition
    t.overwrite(S.majority(p), DS)       # reload: replaces ds=DS only
    return t.scan(spark)


def _append_flow(spark, sf_dir, fmt):
    t = payment_table(spark, sf_dir, fmt=fmt, bucketed=False)
    p = payments(spark, sf_dir, keep_key=False)
    t.append(p, DS)
    t.append(S.minority(p), DS)          # duplicates are kept
    # reference-style: write partition files to a path, then register the partition
    loc = scratch_path(spark, "part")
    p.where(S.is_minority()).write.format(fmt).save(loc)
    t.add_partition(spark, DS_PREV, loc)
    t.add_partition(spark, DS_PREV, loc)  # idempotent
    return t.scan(spark)


OVERWRITE_SQL = f"""
select * exclude (src_key), '{DS}' as ds from {PAYMENTS} where default_amount = 0
union all
select * exclude (src_key), '{DS_PREV}' as ds from {PAYMENTS} where default_amount <> 0"""
APPEND_SQL = f"""
select * exclude (src_key), '{DS}' as ds from {PAYMENTS}
union all
select * exclude (src_key), '{DS}' as ds from {PAYMENTS} where default_amount <> 0
union all
select * exclude (src_key), '{DS_PREV}' as ds from {PAYMENTS} where default_amount <> 0"""


@register("partition_overwrite", OVERWRITE_SQL)
def q_partition_overwrite(spark, sf_dir):
    return _overwrite_flow(spark, sf_dir, "parquet")


@register("partition_append", APPEND_SQL)
def q_partition_append(spark, sf_dir):
    return _append_flow(spark, sf_dir, "parquet")


@register("orc_overwrite", OVERWRITE_SQL)
def q_orc_overwrite(spark, sf_dir):
    return _overwrite_flow(spark, sf_dir, "orc")


@register("orc_append", APPEND_SQL)
def q_orc_append(spark, sf_dir):
    return _append_flow(spark, sf_dir, "orc")


# ---------------------------------------------------------------- kNN and SMOTE

from rentrisk.operators.knn import knn, row_neighbours  # noqa: E402
from rentrisk.operators.lsh import direction, knn_lsh, size_of  # noqa: E402
from rentrisk.operators.smote import SmoteSpec, synthetic_rows  # noqa: E402

K = 10   # the reference's smote_k
SMOTE_DISCRETE = ["name", "house_id", "house_zip"]
SMOTE_CONTINUOUS = ["age", "rent_amount", "default_amount"]
SMOTE_ATTRS = SMOTE_DISCRETE + SMOTE_CONTINUOUS


def smote_sample(spark, sf_dir) -> DataFrame:
    """The minority rows of the train split, widened before SMOTE; written once, as every search reads them often."""
    train = S.train_rows(payments(spark, sf_dir), _cut(spark, sf_dir))
    return materialize(R.widen(S.minority(train).select("id", *SMOTE_ATTRS), ["house_id", "house_zip"],
                               SMOTE_CONTINUOUS), "minority")


MINO_SQL = f"""
select id, name, cast(house_id as bigint) as house_id, cast(house_zip as bigint) as house_zip,
       cast(age as double) as age, cast(rent_amount as double) as rent_amount,
       cast(default_amount as double) as default_amount
from {PAYMENTS} where id < {CUT_SQL} and default_amount <> 0"""


def _t_sql(c):
    return (f"(case when st.rng_{c} = 0 then 0.0 else ((a.{c} - b.{c}) / st.rng_{c}) * ((a.{c} - b.{c}) / st.rng_{c}) end)")


def _d2_sql():
    cont = " + ".join(_t_sql(c) for c in SMOTE_CONTINUOUS)
    mism = " + ".join(f"(case when a.{d} is not distinct from b.{d} then 0 else 1 end)" for d in SMOTE_DISCRETE)
    return f"(({cont}) + cast(({mism}) as double))"


def knn_sql(k: int) -> str:
    order = ", ".join(f"b.{a} nulls first" for a in SMOTE_ATTRS)
    return f"""
with mino as ({MINO_SQL}),
st as (select count(*) as n, {', '.join(f'max({c}) - min({c}) as rng_{c}' for c in SMOTE_CONTINUOUS)} from mino),
pairs as (
  select a.id, {', '.join(f'b.{x} as nb_{x}' for x in SMOTE_ATTRS)}, {_d2_sql()} as d2,
         row_number() over (partition by a.id order by {_d2_sql()}, {order}) - 1 as slot,
         least({k}, st.n - 1) as k_eff
  from mino a join mino b on a.id <> b.id cross join st)
select id, cast(slot as bigint) as slot, {', '.join(f'nb_{x}' for x in SMOTE_ATTRS)}, d2 from pairs where slot < k_eff"""


@register("knn_exact", knn_sql(K))
def q_knn_exact(spark, sf_dir):
    sample = smote_sample(spark, sf_dir)
    res = knn(sample.select(*SMOTE_ATTRS), SMOTE_DISCRETE, SMOTE_CONTINUOUS, K)
    return row_neighbours(sample, "id", res, SMOTE_DISCRETE, SMOTE_CONTINUOUS)


MULT_SQL = f"(select case when minority > 0 then greatest(cast(majority // minority as int), 2) end from ({CLASS_COUNTS_SQL}))"


def smote_sql(k: int, seed: int) -> str:
    u = O.hash32(seed, "g.id", "g.copy", "'u'")
    gap = O.hash_unit(seed, "g.id", "g.copy", "'g'")
    disc = ", ".join(
        f"case when {O.hash32(seed, 'g.id', 'g.copy', repr(f'c{i}'))} % 2 = 0 then g.{d} else n.nb_{d} end as {d}"
        for i, d in enumerate(SMOTE_DISCRETE))
    cont = ", ".join(f"g.{c} + {gap} * (n.nb_{c} - g.{c}) as {c}" for c in SMOTE_CONTINUOUS)
    return f"""
with nbrs as ({knn_sql(k)}),
mino as ({MINO_SQL}),
keff as (select least({k}, count(*) - 1) as k_eff from mino),
gen as (select m.*, c.copy from mino m, (select unnest(range(1, {MULT_SQL})) as copy) c)
select g.id as parent_id, cast(g.copy as int) as copy, {disc}, {cont}
from gen g cross join keff join nbrs n on n.id = g.id and n.slot = {u} % keff.k_eff"""


def smote_train_sql(k: int, seed: int) -> str:
    syn = smote_sql(k, seed)
    return f"""
with syn as ({syn}),
t as (
  select id as _src, 0 as _copy, name, age, house_id, house_zip, rent_amount, default_amount, false as is_syn
  from {PAYMENTS} where id < {CUT_SQL}
  union all
  select parent_id, copy, name, cast(trunc(age) as int), cast(house_id as int), cast(house_zip as int),
         cast(trunc(rent_amount) as int), cast(trunc(default_amount) as int), true from syn)
select row_number() over (order by {O.hash60(seed, '_src', '_copy')}, _src, _copy) as id,
       name, age, house_id, house_zip, rent_amount, default_amount, is_syn
from t"""


@register("smote_exact", smote_sql(K, SEED))
def q_smote_exact(spark, sf_dir):
    train = S.train_rows(payments(spark, sf_dir), _cut(spark, sf_dir))
    from rentrisk.plans.sample import multiplier_of
    spec = SmoteSpec(SMOTE_DISCRETE, SMOTE_CONTINUOUS, K, multiplier_of(train), SEED)
    return synthetic_rows(smote_sample(spark, sf_dir), spec).withColumn("copy", F.col("copy").cast("int"))


def _train_table(spark, sf_dir, **kw) -> DataFrame:
    """Sampling reads the payments for the class counts, the minority and the rows themselves: they are cleaned once."""
    from rentrisk.plans.sample import sample_train
    pay = materialize(payments(spark, sf_dir).select(*S.SAMPLE_COLUMNS), "payments")
    return sample_train(pay, train_cut(pay.count()), k=K, seed=SEED, **kw)


@register("smote_train_table", smote_train_sql(K, SEED))
def q_smote_train_table(spark, sf_dir):
    return _train_table(spark, sf_dir)


LSH_TABLES = 2
LSH_LEVELS = 8  # levels of splits written out; a level without an over-full bucket changes nothing


def knn_lsh_sql(k: int, seed: int, tables: int = LSH_TABLES, levels: int = LSH_LEVELS) -> str:
    """The composite hashes of ``operators.lsh`` in SQL: the same buckets, candidates and fallback."""
    size = size_of(k, None)
    c, d = SMOTE_CONTINUOUS, SMOTE_DISCRETE
    dims = len(c)
    keys = ", ".join(f"case when mask & {1 << i} <> 0 then {x} end as k{i}" for i, x in enumerate(d))
    group = "mask, " + ", ".join(f"k{i}" for i in range(len(d)))
    z = ", ".join(f"case when rng_{x} = 0 then 0.0 else ({x} - min_{x}) / rng_{x} end as z{i}" for i, x in enumerate(c))

    def dot(t, j):
        return " + ".join(f"cast('{w!r}' as double) * z{i}" for i, w in enumerate(direction(seed, t, j, dims)[0]))

    def by_table(value):
        return "case t " + " ".join(f"when {t} then {value(t)}" for t in range(tables)) + " end"

    steps = [f"""b0 as (
  select s.*, t, cast(t as varchar) as key, n as gn from
    (select *, sum(cast(data as int)) over (partition by {group}) as n from strata) s, (select unnest(range({tables})) as t) tt
  where t = 0 or n > {size})"""]
    for j in range(levels):
        offset = by_table(lambda t: f"cast('{direction(seed, t, j, dims)[1]!r}' as double)")
        steps.append(f"""b{j + 1} as (
  select * exclude (x, cnt, lo, hi) replace (case when cnt > {size} and hi > lo then key || '.' || cast(floor(
      (case when cnt > {4 * size} then 8 when cnt > {2 * size} then 4 else 2 end) * (x - lo) / (hi - lo) + {offset}) as bigint)
    else key end as key)
  from (select *, sum(cast(data as int)) over w as cnt, min(x) filter (data) over w as lo, max(x) filter (data) over w as hi
        from (select *, {by_table(lambda t: dot(t, j))} as x from b{j}) window w as (partition by {group}, key)))""")
    agree = " + ".join(f"(case when a.{x} is not distinct from b.{x} then {1 << i} else 0 end)" for i, x in enumerate(d))
    same = " and ".join(f"a.k{i} is not distinct from b.k{i}" for i in range(len(d)))
    point = " and ".join(f"{{0}}.{x} is not distinct from {{1}}.{x}" for x in d + c)
    order = ", ".join(f"b.{x} nulls first" for x in d + c)
    return f"""
with mino as ({MINO_SQL}),
st as (select count(*) as n, {', '.join(f'min({x}) as min_{x}, max({x}) - min({x}) as rng_{x}' for x in c)} from mino),
pts as (select row_number() over (order by {', '.join(d + c)}) as pid, * from (select distinct {', '.join(d + c)} from mino)),
strata as (
  select *, row_number() over (partition by {group}, {', '.join(c)} order by {', '.join(f'{x} nulls first' for x in d)})
            <= least({k}, (select n from st) - 1) + 1 as data
  from (select *, {keys} from (select p.*, {z} from pts p, st) q, (select unnest(range({1 << len(d)})) as mask) mm)),
{', '.join(steps)},
met as (select distinct a.pid as a, b.pid as b from b{levels} a join b{levels} b on a.mask = b.mask and {same} and a.key = b.key
        where b.data and a.pid <> b.pid and {agree} = a.mask),
r as (select m.*, p.pid from mino m join pts p on {point.format('m', 'p')}),
near as (select a.id as ia, b.id as ib from r a join r b on a.id <> b.id and a.pid = b.pid
         union all select a.id, b.id from met join r a on a.pid = met.a join r b on b.pid = met.b),
enough as (select ia from near group by ia having count(*) >= least({k}, (select n from st) - 1)),
cand as (select ia, ib from near where ia in (select ia from enough)
         union all select a.id, b.id from r a join r b on a.id <> b.id where a.id not in (select ia from enough)),
ranked as (
  select a.id, {', '.join(f'b.{x} as nb_{x}' for x in SMOTE_ATTRS)}, {_d2_sql()} as d2,
         row_number() over (partition by a.id order by {_d2_sql()}, {order}) - 1 as slot, least({k}, st.n - 1) as k_eff
  from cand join mino a on a.id = ia join mino b on b.id = ib cross join st)
select id, cast(slot as bigint) as slot, {', '.join(f'nb_{x}' for x in SMOTE_ATTRS)}, d2 from ranked where slot < k_eff"""


@register("knn_lsh", knn_lsh_sql(K, SEED))
def q_knn_lsh(spark, sf_dir):
    """Approximate neighbours by composite hashes; the SQL computes the same hashes, the tests hold the recall."""
    sample = smote_sample(spark, sf_dir)
    res = knn_lsh(sample.select(*SMOTE_ATTRS), SMOTE_DISCRETE, SMOTE_CONTINUOUS, K, num_tables=LSH_TABLES, seed=SEED)
    return row_neighbours(sample, "id", res, SMOTE_DISCRETE, SMOTE_CONTINUOUS)


# ---------------------------------------------------------------- features, folds, models, metrics

from pyspark.ml import Pipeline  # noqa: E402
from pyspark.ml.feature import VectorAssembler  # noqa: E402
from pyspark.ml.regression import LinearRegression  # noqa: E402

from rentrisk.operators import features as FE  # noqa: E402
from rentrisk.operators import model as M  # noqa: E402
from rentrisk.operators.metrics import regression_metrics, report_row  # noqa: E402
from rentrisk.sources.tables import write_report  # noqa: E402

TRAIN_ROWS_SQL = f"""(select default_amount as label, name, age, house_id, house_zip, rent_amount, id
                      from {PAYMENTS} where id < {CUT_SQL})"""
NAME_INDEX_SQL = f"""(select name, cast(row_number() over (order by count(*) desc, name) - 1 as int) as name_index
                      from {TRAIN_ROWS_SQL} group by name)"""


def model_train_rows(spark, sf_dir) -> DataFrame:
    return S.model_rows(S.train_rows(payments(spark, sf_dir), _cut(spark, sf_dir)))


@register("string_index", f"select * from {NAME_INDEX_SQL}")
def q_string_index(spark, sf_dir):
    tr = model_train_rows(spark, sf_dir)
    m = FE.name_indexer().fit(tr)
    return m.transform(tr.select("name").distinct()).select("name", F.col("name_index").cast("int"))


@register("one_hot_long", f"""
select id, 'name_1hot' as feature, cast(i.name_index as bigint) as slot, cast(1 as double) as value
from {TRAIN_ROWS_SQL} t join {NAME_INDEX_SQL} i using (name)
union all select id, 'house_id_1hot', cast(house_id as bigint), 1.0 from {TRAIN_ROWS_SQL}
union all select id, 'house_zip_1hot', cast(house_zip as bigint), 1.0 from {TRAIN_ROWS_SQL}""")
def q_one_hot_long(spark, sf_dir):
    tr = model_train_rows(spark, sf_dir)
    m = Pipeline(stages=[FE.name_indexer(), FE.one_hot()]).fit(tr)
    return FE.vector_long(m.transform(tr), "id", FE.ONE_HOT_OUTPUTS)


@register("age_buckets", f"""
select id, age, cast(case when age < 0 then 0 when age < 20 then 1 when age < 30 then 2 when age < 40 then 3
                          when age < 50 then 4 when age < 60 then 5 else 6 end as double) as age_buckets
from {TRAIN_ROWS_SQL}""")
def q_age_buckets(spark, sf_dir):
    return FE.age_buckets().transform(model_train_rows(spark, sf_dir)).select("id", "age", "age_buckets")


@register("assemble_long", f"""
with t as {TRAIN_ROWS_SQL}, i as {NAME_INDEX_SQL},
w as (select (select count(*) + 1 from i) as wn,  -- names + the unseen-name slot
 max(house_id) + 1 as wh, max(house_zip) + 1 as wz from t),
b as (select id, rent_amount, case when age < 0 then 0.0 when age < 20 then 1.0 when age < 30 then 2.0
      when age < 40 then 3.0 when age < 50 then 4.0 when age < 60 then 5.0 else 6.0 end as ab from t)
select id, 'features' as feature, cast(i.name_index as bigint) as slot, 1.0 as value from t join i using (name)
union all select id, 'features', cast(wn + house_id as bigint), 1.0 from t, w
union all select id, 'features', cast(wn + wh + house_zip as bigint), 1.0 from t, w
union all select id, 'features', cast(wn + wh + wz as bigint), ab from b, w where ab <> 0
union all select id, 'features', cast(wn + wh + wz + 1 as bigint), cast(rent_amount as double) from b, w
  where rent_amount <> 0""")
def q_assemble_long(spark, sf_dir):
    tr = model_train_rows(spark, sf_dir)
    m = Pipeline(stages=FE.feature_stages()).fit(tr)
    return FE.vector_long(m.transform(tr), "id", ["features"])


@register("fold_assign", f"select id, cast({O.hash32(M.FOLD_SEED, 'id')} % 3 as int) as fold from {TRAIN_ROWS_SQL}")
def q_fold_assign(spark, sf_dir):
    return M.add_folds(model_train_rows(spark, sf_dir)).select("id", "fold")


LASSO_REGS = [0.1, 1.0, 20.0]


@register("lasso_one_feature", f"""
with s as (select avg(rent_amount) as mx, avg(default_amount) as my, stddev_pop(rent_amount) as sx,
                  stddev_pop(default_amount) as sy, corr(rent_amount, default_amount) as r
           from {PAYMENTS} where id < {CUT_SQL}),
g as (select cast(unnest([{', '.join(str(x) for x in LASSO_REGS)}]) as double) as reg_param),
b as (select reg_param, sign(r) * greatest(abs(r) - reg_param / sy, 0) * sy / sx as coefficient, mx, my from s, g)
select reg_param, round(coefficient, 6) as coefficient, round(my - coefficient * mx, 6) as intercept from b""")
def q_lasso_one_feature(spark, sf_dir):
    """M1: one-feature lasso fits against the closed-form soft threshold."""
    tr = S.train_rows(payments(spark, sf_dir), _cut(spark, sf_dir))
    data = VectorAssembler(inputCols=["rent_amount"], outputCol="features").transform(
        tr.select(F.col("default_amount").cast("double").alias("label"), "rent_amount")).persist()
    out = []
    for reg in LASSO_REGS:
        lr = LinearRegression(elasticNetParam=1.0, regParam=reg, maxIter=100, tol=1e-12).fit(data)
        out.append((reg, float(lr.coefficients[0]), float(lr.intercept)))
    data.unpersist()
    df = spark.createDataFrame(out, "reg_param double, coefficient double, intercept double")
    return df.select("reg_param", F.round("coefficient", 6).alias("coefficient"), F.round("intercept", 6).alias("intercept"))


def _fitted(spark, sf_dir):
    """Fit, save and report; every query that needs a model fits its own."""
    from rentrisk.plans.train import train_flow
    train = materialize(_train_table(spark, sf_dir), "train")
    report_path = scratch_path(spark, "validation")
    cvm, path, _ = train_flow(spark, train, scratch_path(spark, "model/reg_lasso_r2"), report_path)
    return cvm, path, spark.read.parquet(report_path)


@register("lasso_cv_report")
def q_lasso_cv_report(spark, sf_dir):
    """Fit, save with a time suffix, and the validation row (iterative fit: rows only)."""
    _, _, report = _fitted(spark, sf_dir)
    return report


@register("best_params")
def q_best_params(spark, sf_dir):
    cvm, _, _ = _fitted(spark, sf_dir)
    return M.best_params(M.candidates(spark, cvm), cvm.getEvaluator().isLargerBetter())


@register("score_test")
def q_score_test(spark, sf_dir):
    """Load the saved model and score the rows from the id cut up."""
    _, path, _ = _fitted(spark, sf_dir)
    rows = S.test_rows(payments(spark, sf_dir), _cut(spark, sf_dir))
    return M.score(M.load(path), rows).select("id", "label", "prediction")


METRIC_SQL = """
with s as (select count(*) as n, sum((y - p) * (y - p)) as sse, sum(abs(y - p)) as sae, var_pop(y) as vy,
                  var_pop(p) as vp, avg(y) as my, avg(p) as mp
           from (select l_quantity as y, cast(l_linenumber * 7 as double) as p from lineitem))
select round(1 - sse / (n * vy), 6) as r2, round(vp + (mp - my) * (mp - my), 6) as explained_var,
       round(sae / n, 6) as mae, round(sse / n, 6) as mse, round(sqrt(sse / n), 6) as rmse from s"""


def _fixed_prediction(spark, sf_dir):
    li = spark.read.parquet(table_path(sf_dir, "lineitem"))
    return li.select(F.col("l_quantity").alias("label"), (F.col("l_linenumber") * 7).cast("double").alias("prediction"))


def _rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if c != "model" else F.col(c) for c in df.columns])


@register("regression_metrics", METRIC_SQL)
def q_regression_metrics(spark, sf_dir):
    return _rounded(regression_metrics(_fixed_prediction(spark, sf_dir)))


@register("test_report", f"select 'fixed_prediction' as model, * from ({METRIC_SQL})")
def q_test_report(spark, sf_dir):
    """The report row appended to a path and read back."""
    path = scratch_path(spark, "test_report")
    write_report(report_row(regression_metrics(_fixed_prediction(spark, sf_dir)), "fixed_prediction"), path)
    return _rounded(spark.read.parquet(path))


# ---------------------------------------------------------------- lasso from fold statistics, scoring by a coefficient table

from rentrisk.operators import dictionary as DICT  # noqa: E402
from rentrisk.operators import gram as G  # noqa: E402

_LASSO_FOLDS_SQL = f"""
with t as (select label, rent_amount as x, cast({O.hash32(M.FOLD_SEED, 'id')} % {M.NUM_FOLDS} as int) as fold from {TRAIN_ROWS_SQL}),
f as (select unnest(range({M.NUM_FOLDS})) as f),
s as (select f, avg(x) as mx, avg(label) as my, stddev_pop(x) as sx, stddev_pop(label) as sy, corr(x, label) as r
      from t join f on fold <> f group by f),
g as (select cast(unnest([{', '.join(str(x) for x in LASSO_REGS)}]) as double) as reg_param),
b as (select f, reg_param, sign(r) * greatest(abs(r) - reg_param / sy, 0) * sy / sx as b, mx, my from s, g),
m as (select f, reg_param, b, my - b * mx as a from b)
select cast(f as int) as fold, reg_param, b as coefficient, a as intercept,
       1 - sum((label - a - b * x) * (label - a - b * x)) / (count(*) * var_pop(label)) as r2
from m join t on fold = f group by f, reg_param, b, a"""


def _one_feature_cv(spark, sf_dir):
    rows = M.add_folds(model_train_rows(spark, sf_dir)).withColumn("x", G.numeric_entries(["rent_amount"]))
    return G.cross_validate(rows, LASSO_REGS, names=[("rent_amount", None)])


@register("lasso_cv_folds", f"""
select fold, reg_param, round(coefficient, 6) as coefficient, round(intercept, 6) as intercept, round(r2, 6) as r2
from ({_LASSO_FOLDS_SQL})""")
def q_lasso_cv_folds(spark, sf_dir):
    """M1-M3: every candidate on every fold from one pass of fold statistics, against the closed form."""
    cv = _one_feature_cv(spark, sf_dir)
    rows = [(f, r, float(m.coefficients[0]), m.intercept, v) for r, f, m, v in cv.folds]
    df = spark.createDataFrame(rows, "fold int, reg_param double, coefficient double, intercept double, r2 double")
    return df.select("fold", "reg_param", *[F.round(c, 6).alias(c) for c in ("coefficient", "intercept", "r2")])


@register("lasso_cv_best", f"""
select arg_max(reg_param, avg_metric) as reg_param, round(max(avg_metric), 6) as avg_metric
from (select reg_param, avg(r2) as avg_metric from ({_LASSO_FOLDS_SQL}) group by reg_param)""")
def q_lasso_cv_best(spark, sf_dir):
    """M4, F2: the best candidate of the cross-validation from fold statistics."""
    best = M.best_params(G.candidates(spark, _one_feature_cv(spark, sf_dir)))
    return best.select("reg_param", F.round("avg_metric", 6).alias("avg_metric"))


@register("score_lasso_table", f"""
with f as ({_LASSO_FOLDS_SQL}),
best as (select arg_max(reg_param, m) as reg from (select reg_param, avg(r2) as m from f group by reg_param)),
s as (select avg(rent_amount) as mx, avg(label) as my, stddev_pop(rent_amount) as sx, stddev_pop(label) as sy,
             corr(rent_amount, label) as r from {TRAIN_ROWS_SQL}),
b as (select sign(r) * greatest(abs(r) - reg / sy, 0) * sy / sx as b, mx, my from s, best)
select id, default_amount as label, round(my - b * mx + b * rent_amount, 6) as prediction
from {PAYMENTS}, b where id >= {CUT_SQL}""")
def q_score_lasso_table(spark, sf_dir):
    """The best model of the fold statistics saved as coefficient rows, read back, and the rows from the id cut up scored by it."""
    cv = _one_feature_cv(spark, sf_dir)
    table = materialize(G.coefficient_rows(spark, cv.best, cv.names), "coefficients")
    rows = S.test_rows(payments(spark, sf_dir), _cut(spark, sf_dir)).select("id", "label", "rent_amount")
    return G.score(rows, table, ["rent_amount"], []).select("id", "label", F.round("prediction", 6).alias("prediction"))


_EFFECTS = ["name", "house_id", "house_zip"]


@register("score_effects_table", f"""
with t as (select * from {TRAIN_ROWS_SQL}), m as (select avg(label) as m from t),
{', '.join(f"e_{c} as (select {c}, avg(label) - any_value(m) as e from t, m group by {c})" for c in _EFFECTS)}
select id, default_amount as label, round(m + {' + '.join(f'coalesce(e_{c}.e, 0)' for c in _EFFECTS)}, 6) as prediction
from {PAYMENTS} p cross join m {' '.join(f'left join e_{c} on p.{c} = e_{c}.{c}' for c in _EFFECTS)}
where id >= {CUT_SQL}""")
def q_score_effects_table(spark, sf_dir):
    """M6 with a row per category value: the effects of name, house and zip on the label, as mean differences, looked up by value.
    Values that the train rows do not hold add nothing."""
    train = model_train_rows(spark, sf_dir)
    mean = train.agg(F.avg("label").alias("_mean"))
    parts = [mean.select(F.lit(G.INTERCEPT).alias("feature"), F.lit(None).cast("string").alias("value"), F.col("_mean").alias("coefficient"))]
    for c in _EFFECTS:
        effect = train.groupBy(F.col(c).cast("string").alias("value")).agg(F.avg("label").alias("_m"))
        parts.append(effect.crossJoin(F.broadcast(mean)).select(F.lit(c).alias("feature"), "value", (F.col("_m") - F.col("_mean")).alias("coefficient")))
    table = parts[0]
    for p in parts[1:]:
        table = table.unionByName(p)
    rows = S.test_rows(payments(spark, sf_dir), _cut(spark, sf_dir)).select("id", "label", *_EFFECTS)
    scored = G.score(materialize(rows, "scored-rows"), materialize(table, "coefficients"), [], _EFFECTS)
    return scored.select("id", "label", F.round("prediction", 6).alias("prediction"))


# ---------------------------------------------------------------- dictionary of categories

DICT_SQL = f"""
select "column", value, n, row_number() over (order by place, n desc, value) - 1 as slot
from ({' union all '.join(f"select {i} as place, '{c}' as column, cast({c} as varchar) as value, count(*) as n from {TRAIN_ROWS_SQL} group by all"
                           for i, c in enumerate(FE.CATEGORICAL))})"""


@register("dictionary_slots", DICT_SQL)
def q_dictionary_slots(spark, sf_dir):
    """K1, K2: observed values of all categorical columns numbered by column and frequency, nothing per value on the driver."""
    return DICT.build(model_train_rows(spark, sf_dir), FE.CATEGORICAL)


@register("dictionary_encode", f"""
with d as ({DICT_SQL})
select id, {', '.join(f'd_{c}.slot as {c}_slot' for c in FE.CATEGORICAL)}
from (select * from {PAYMENTS} where id >= {CUT_SQL}) p
{' '.join(f"left join d d_{c} on d_{c}.column = '{c}' and d_{c}.value = cast(p.{c} as varchar)" for c in FE.CATEGORICAL)}""")
def q_dictionary_encode(spark, sf_dir):
    """The test rows encoded by the train rows' dictionary; unseen values have no slot."""
    d = materialize(DICT.build(model_train_rows(spark, sf_dir), FE.CATEGORICAL), "slots")
    rows = S.test_rows(payments(spark, sf_dir), _cut(spark, sf_dir)).select("id", *FE.CATEGORICAL)
    return DICT.encode(materialize(rows, "encoded-rows"), d, FE.CATEGORICAL).drop(*FE.CATEGORICAL)


# ---------------------------------------------------------------- options of SMOTE: votes, folds by parent

def _vote_sql(c: str) -> str:
    return f"""select id, nb_{c} as {c} from (select id, nb_{c}, row_number() over (partition by id
      order by count(*) desc, nb_{c} nulls first) as rn from nbrs group by id, nb_{c}) where rn = 1"""


@register("smote_vote", f"""
with nbrs as ({knn_sql(K)}),
{', '.join(f"v_{c} as ({_vote_sql(c)})" for c in SMOTE_DISCRETE)}
select s.parent_id, s.copy, {', '.join(f'v_{c}.{c}' for c in SMOTE_DISCRETE)}, {', '.join(f's.{c}' for c in SMOTE_CONTINUOUS)}
from ({smote_sql(K, SEED)}) s {' '.join(f'join v_{c} on v_{c}.id = s.parent_id' for c in SMOTE_DISCRETE)}""")
def q_smote_vote(spark, sf_dir):
    """Discrete attributes by majority vote of the k neighbours."""
    from rentrisk.plans.sample import multiplier_of
    train = S.train_rows(payments(spark, sf_dir), _cut(spark, sf_dir))
    spec = SmoteSpec(SMOTE_DISCRETE, SMOTE_CONTINUOUS, K, multiplier_of(train), SEED, discrete_by="vote")
    return synthetic_rows(smote_sample(spark, sf_dir), spec).withColumn("copy", F.col("copy").cast("int"))


@register("fold_by_parent", smote_train_sql(K, SEED).replace(
    "       name, age, house_id, house_zip, rent_amount, default_amount, is_syn\nfrom t",
    f"       _src as parent_id, is_syn, cast({O.hash32(M.FOLD_SEED, '_src')} % {M.NUM_FOLDS} as int) as fold\nfrom t"))
def q_fold_by_parent(spark, sf_dir):
    """Folds of the train table by parent, so that no synthetic row is validated by a model that saw its parent."""
    train = _train_table(spark, sf_dir, with_parent=True)
    return M.add_folds(train, key="parent_id").select("id", "parent_id", "is_syn", "fold")


# ---------------------------------------------------------------- catalog tables, files, order, model versions

from rentrisk.operators import order as ORD  # noqa: E402
from rentrisk.operators import versions as V  # noqa: E402
from rentrisk.sources import tables as TB  # noqa: E402
from rentrisk.sources.delimited import RAW_SCHEMA  # noqa: E402


def _database(spark: SparkSession) -> str:
    """A named database of its own in the shared folder."""
    path = scratch_path(spark, "rent")
    name = "rent_" + path.rsplit("-", 1)[1]
    TB.create_database(spark, name, path)
    return name


@register("raw_catalog_scan", ORACLES["scan_delimited"])
def q_raw_catalog_scan(spark, sf_dir):
    """The raw text as an external table of a named database, scanned as db.table."""
    path, db = scratch_path(spark, "raw"), _database(spark)
    write_delimited(derived_raw(spark, sf_dir, with_key=False), path)
    TB.external_text_table(spark, f"{db}.raw", path, RAW_SCHEMA)
    return spark.table(f"{db}.raw")


@register("test_table_append", " union all ".join(
    f"select 'prediction_{m}' as model, * from ({METRIC_SQL.replace('l_linenumber * 7', f'l_linenumber * {m}')})" for m in (7, 6)))
def q_test_table_append(spark, sf_dir):
    """Metrics rows of two models appended to the test table through the catalog, one after the other, and read back."""
    name = f"{_database(spark)}.test"
    TB.report_table(spark, name, scratch_path(spark, "test"),
                    "model string, r2 double, explained_var double, mae double, mse double, rmse double")
    li = spark.read.parquet(table_path(sf_dir, "lineitem"))
    for m in (7, 6):
        fixed = li.select(F.col("l_quantity").alias("label"), (F.col("l_linenumber") * m).cast("double").alias("prediction"))
        TB.append_report(report_row(regression_metrics(fixed), f"prediction_{m}"), name)
    return _rounded(spark.table(name))


_VERSIONS = [("20190326_010000", [20.0]), ("20190326_020000", [0.1, 1.0]), ("20190326_030000", [1.0, 20.0])]


@register("model_versions", f"""
with a as (select reg_param, avg(r2) as m from ({_LASSO_FOLDS_SQL}) group by reg_param),
v(version, reg_param) as (values {', '.join(f"('{v}', cast({r} as double))" for v, regs in _VERSIONS for r in regs)}),
r as (select version, reg_param, m, m = max(m) over (partition by version) as chosen from v join a using (reg_param)),
b as (select arg_max(version, (m, version)) as version from r where chosen)
select version, reg_param, round(m, 6) as avg_metric, chosen, version = (select version from b) and chosen as loaded from r""")
def q_model_versions(spark, sf_dir):
    """Three fits saved under their times, a row per candidate in the validation table, the best found again by its report."""
    name, prefix = f"{_database(spark)}.validation", scratch_path(spark, "model/lasso")
    TB.report_table(spark, name, scratch_path(spark, "validation"), V.REPORT)
    rows = M.add_folds(model_train_rows(spark, sf_dir)).withColumn("x", G.numeric_entries(["rent_amount"]))
    rows = materialize(rows.select("x", "label", "fold"), "model-rows")
    for suffix, regs in _VERSIONS:
        cv = G.cross_validate(rows, regs, names=[("rent_amount", None)])
        TB.append_report(V.report(spark, cv, V.save(spark, cv, prefix, suffix)), name)
    reports = spark.table(name)
    best = V.best(reports).first()
    # the saved version is there and holds an intercept
    held = V.load(spark, best["model"]).where(F.col("feature") == G.INTERCEPT).select(F.lit(best["model"]).alias("_model"))
    out = reports.join(F.broadcast(held), F.col("model") == F.col("_model"), "left")
    return out.select(F.regexp_extract("model", r"_(\d{8}_\d{6})$", 1).alias("version"), "reg_param",
                      F.round("avg_metric", 6).alias("avg_metric"), "chosen",
                      (F.col("_model").isNotNull() & F.col("chosen")).alias("loaded"))


@register("files_by_size", f"""
select '{DS}' as ds, cast(1 as bigint) as files, count(*) as rows from {PAYMENTS} where default_amount <> 0
union all select '{DS_PREV}', 4, count(*) from {PAYMENTS}""")
def q_files_by_size(spark, sf_dir):
    """Files per partition as the files' metadata tell: few rows fill one file of the asked size, four files are four."""
    schema, p = payments(spark, sf_dir, keep_key=False).schema, payments(spark, sf_dir, keep_key=False)
    path = scratch_path(spark, "files")
    name = "files_" + path.rsplit("-", 1)[1]
    Table(name=name, path=path, schema=schema, file_bytes=128 << 20).create(spark).overwrite(S.minority(p), DS)
    Table(name=name, path=path, schema=schema, num_files=4).overwrite(p, DS_PREV)
    return TB.files_per_partition(spark, name).select("ds", "files", "rows")


@register("ordered_positions", f"""
select id, row_number() over (order by id) as position from {PAYMENTS} where id >= {CUT_SQL}""")
def q_ordered_positions(spark, sf_dir):
    """the test rows written in the order of their ids over all files; a row's place is read back from the files."""
    path = scratch_path(spark, "ordered")
    ORD.write_ordered(S.test_rows(payments(spark, sf_dir), _cut(spark, sf_dir)), path, "id")
    return ORD.read_positions(spark, path).select("id", "position")


@register("rows_with_schema", CLASS_COUNTS_SQL)
def q_rows_with_schema(spark, sf_dir):
    """A4: rows held by the driver (the one of the class counts) made a frame by a schema."""
    counts = S.class_counts(S.train_rows(payments(spark, sf_dir), _cut(spark, sf_dir)))
    return R.to_df(spark, [tuple(r) for r in counts.collect()], "majority bigint, minority bigint")


@register("time_suffixes", "select o_orderkey, strftime(o_orderdate, '%Y%m%d_%H%M%S') as suffix from orders")
def q_time_suffixes(spark, sf_dir):
    """Timestamps as the suffixes of model versions."""
    from rentrisk.functions.dates import time_suffix
    orders = spark.read.parquet(table_path(sf_dir, "orders"))
    return orders.select("o_orderkey", time_suffix("o_orderdate").alias("suffix"))
