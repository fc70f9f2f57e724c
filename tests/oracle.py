"""Run queries and their SQL side by side and compare values regardless of order."""

from __future__ import annotations

import collections
import decimal
import glob
import math
import os

import duckdb


TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER"}


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, decimal.Decimal):
        return format(value.normalize(), "f")
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return format(decimal.Decimal(str(value)).normalize(), "f")
    return str(value)


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(df, con, sql: str) -> str | None:
    """What differs, or None."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    types = {d[0]: str(d[1]) for d in result.description}
    wrong = {
        f.name: (f.dataType.simpleString(), types[f.name])
        for f in df.schema.fields
        if TYPES[f.dataType.simpleString()] != types[f.name]
    }
    if wrong:
        return f"types {wrong}"
    order = sorted(names)
    theirs = collections.Counter(
        tuple(plain(row[names.index(c)]) for c in order) for row in result.fetchall()
    )
    ours = collections.Counter(tuple(plain(row[c]) for c in order) for row in df.collect())
    if ours == theirs:
        return None
    only_ours, only_theirs = ours - theirs, theirs - ours
    return (
        f"{sum(ours.values())} against {sum(theirs.values())} rows; {order}; only Spark"
        f" {list(only_ours)[:2]} ({sum(only_ours.values())}); only SQL {list(only_theirs)[:2]}"
    )
