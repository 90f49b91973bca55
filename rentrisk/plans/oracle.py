"""SQL text of the oracles (DuckDB dialect) that check the Spark flows.

These build the same quantities with the same operation order as the column
expressions in ``rentrisk.functions``, so results agree to the bit.
"""

from __future__ import annotations

from rentrisk.sources.fixtures import DERIVED_RAW_SQL


def parse_date(s: str) -> str:
    slash = f"contains({s}, '/')"
    y = f"try_cast(case when {slash} then substr({s}, 7, 4) else substr({s}, 1, 4) end as int)"
    m = f"try_cast(case when {slash} then substr({s}, 1, 2) else substr({s}, 5, 2) end as int)"
    d = f"try_cast(case when {slash} then substr({s}, 4, 2) else substr({s}, 7, 2) end as int)"
    shaped = (f"(case when {slash} then regexp_full_match({s}, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}') "
              f"else regexp_full_match({s}, '[0-9]{{8}}') end)")
    ok = f"({shaped} and {y} >= 1 and {m} between 1 and 12 and {d} between 1 and 31)"
    first = f"make_date({y}, {m}, 1)"
    return f"(case when {ok} then least({first} + ({d} - 1), last_day({first})) end)"


def key_string(seed, *exprs: str) -> str:
    parts = [f"'{seed}'"] + [f"coalesce(cast({e} as varchar), '\\N')" for e in exprs]
    return "concat_ws(':', " + ", ".join(parts) + ")"


def hash60(seed, *exprs: str) -> str:
    return f"cast(('0x' || substr(md5({key_string(seed, *exprs)}), 1, 15)) as bigint)"


def hash32(seed, *exprs: str) -> str:
    return f"cast(('0x' || substr(md5({key_string(seed, *exprs)}), 1, 8)) as bigint)"


def hash_unit(seed, *exprs: str) -> str:
    return f"({hash32(seed, *exprs)} / cast(4294967296 as double))"


def age(dob: str, as_of: str) -> str:
    tm = (f"((year({as_of}) - year({dob})) * 12 + month({as_of}) - month({dob}))")
    tm2 = (f"(case when {tm} > 0 and day({as_of}) < day({dob}) then {tm} - 1 "
           f"when {tm} < 0 and day({as_of}) > day({dob}) then {tm} + 1 else {tm} end)")
    return f"cast(trunc({tm2} / 12) as int)"


def clean_dob(dob: str, default_dob: str, as_of: str) -> str:
    p = parse_date(dob)
    dflt = parse_date(f"'{default_dob}'")
    return (f"(case when {p} < {as_of} then (case when {p} = date '1900-01-01' then {dflt} else {p} end) "
            f"when {p} is not null then {dflt} end)")


def typed_payments_sql(as_of: str = "date '2019-03-26'", default_dob: str = "19800101") -> str:
    """Typed payment rows (no id) from the derived raw table, with ``src_key``."""
    return f"""
with raw as ({DERIVED_RAW_SQL}),
t as (select trim(name) as name, trim(dob) as dob, house_id, house_zip, trim(payment_date) as payment_date,
             payment_amount, rent_amount, src_key from raw),
s as (select name, {clean_dob('dob', default_dob, as_of)} as dob_d, coalesce(house_id, 0) as house_id,
             coalesce(house_zip, 0) as house_zip, {parse_date('payment_date')} as payment_date,
             case when payment_amount is null then 0
                  else least(abs(payment_amount), coalesce(rent_amount, 0)) end as payment_amount,
             coalesce(rent_amount, 0) as rent_amount, src_key from t)
select name, {age('dob_d', as_of)} as age, house_id, house_zip, payment_date,
       cast(year(payment_date) as int) as payment_date_year, cast(month(payment_date) as int) as payment_date_month,
       cast(isodow(payment_date) as int) as payment_date_day_of_week,
       cast(day(payment_date) as int) as payment_date_day_of_month,
       payment_amount, rent_amount, rent_amount - payment_amount as default_amount, src_key
from s"""


def payments_sql(seed: int = 0, **kw) -> str:
    """Payment rows with the hashed dense id ordered by (hash(seed, src_key), src_key)."""
    return f"""
select row_number() over (order by {hash60(seed, 'src_key')}, src_key) as id, * exclude (src_key), src_key
from ({typed_payments_sql(**kw)})"""
