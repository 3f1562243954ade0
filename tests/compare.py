"""Rows of a Spark query and of its SQL, made comparable."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal


def cell(v):
    if v is None or v != v:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float, Decimal)):
        return f"{float(v):.6f}"
    if isinstance(v, dt.datetime):
        return str(v.replace(tzinfo=None))
    return str(v)


def agree(spark_df, duck, sql: str) -> None:
    result = duck.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(spark_df.columns)
    order = sorted(names)
    want = sorted(tuple(cell(r[names.index(c)]) for c in order) for r in result.fetchall())
    got = sorted(tuple(cell(r[c]) for c in order) for r in spark_df.collect())
    assert got == want
