"""Runs a query in Spark and its SQL in DuckDB and compares them as bags of rows."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter
from decimal import Decimal

import duckdb


def duck(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return int(value) if value == int(value) and abs(value) < 2**53 else value
    return value


def compare(spark_df, con, sql: str):
    """Differences as text, or None if there are none."""
    names = sorted(spark_df.columns)
    result = con.execute(sql)
    sql_names = [d[0] for d in result.description]
    if sorted(sql_names) != names:
        return f"columns {names} against {sorted(sql_names)}"
    order = [sql_names.index(n) for n in names]
    expected = Counter(tuple(plain(r[i]) for i in order) for r in result.fetchall())
    found = Counter(tuple(plain(x) for x in r) for r in spark_df.select(*[f"`{n}`" for n in names]).collect())
    if expected == found:
        return None
    missing, extra = list((expected - found).items())[:3], list((found - expected).items())[:3]
    return f"{sum(found.values())} rows against {sum(expected.values())}\n columns {names}\n only sql {missing}\n only spark {extra}"
