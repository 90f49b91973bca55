"""Side-by-side check of a Spark query against its DuckDB oracle (like the driver's)."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if hasattr(v, "isoformat"):
        return str(v)[:10] if len(str(v)) >= 10 and str(v)[10:].strip("0: ") == "" else str(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows(df_or_rel, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in df_or_rel), key=repr)


def compare(spark, sf_dir, name, query, sql):
    sdf = query(spark, sf_dir)
    s_cols = sorted(sdf.columns)
    s_rows = [r.asDict() for r in sdf.collect()]
    con = duck(sf_dir)
    rel = con.sql(sql)
    d_cols = sorted(rel.columns)
    d_df: pd.DataFrame = rel.df()
    d_rows = [{c: (None if (not isinstance(v, (list, tuple)) and pd.isna(v)) else v) for c, v in r.items()}
              for r in d_df.to_dict("records")]
    assert s_cols == d_cols, f"{name}: columns {s_cols} vs {d_cols}"
    duck_types = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
                  "BOOLEAN": "boolean"}
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    d_types = {c: duck_types.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert s_types == d_types, f"{name}: types {s_types} vs {d_types}"
    assert len(s_rows) == len(d_rows), f"{name}: rows {len(s_rows)} vs {len(d_rows)}"
    a, b = rows(s_rows, s_cols), rows(d_rows, d_cols)
    diffs = [(x, y) for x, y in zip(a, b) if x != y]
    assert not diffs, f"{name}: {len(diffs)} differing rows, e.g. {diffs[:3]}"
    return len(s_rows)
