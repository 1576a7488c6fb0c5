"""Run a registered query against its DuckDB oracle and compare results.

Mirrors the driver's check: same column names, same row count, and the same
multiset of rows. Integers, booleans, text and times must be equal; doubles
may differ by one unit of the sixth digit or later, where a query declares that many (plus what a
double of that size can hold), and not at all at fewer digits. Both sides are compared as Python values, so a column
of integers with NULLs stays exact. DuckDB runs in-process on the same
Parquet files (no server).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

from riskweave.sources.testdata import TABLES

Result = tuple[list[str], list[tuple]]


def duckdb_result(sql: str, sf_dir: str) -> Result:
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    try:
        cur = con.execute(sql)
        return [d[0] for d in cur.description], cur.fetchall()
    finally:
        con.close()


def spark_result(df) -> Result:
    return df.columns, [tuple(r) for r in df.collect()]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return int(v) if v == v.to_integral_value() and v.as_tuple().exponent >= 0 else float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(timespec="microseconds")
    if isinstance(v, (dt.date, dt.time)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _order(v):
    """Sort key of a value; doubles count in full only after all other columns."""
    if isinstance(v, tuple):
        return (str(tuple), repr(v))
    return (str(type(v)), 0 if v is None else v)


def _rows(result: Result) -> list[tuple]:
    names, rows = result
    place = [names.index(c) for c in sorted(names)]
    out = [tuple(_norm(r[i]) for i in place) for r in rows]
    exact = lambda r: [_order(v) for v in r if not isinstance(v, float)]
    rough = lambda r: [round(v, 4) for v in r if isinstance(v, float)]
    return sorted(out, key=lambda r: ([v is None for v in r], exact(r), rough(r)))


def _same(x, y, digits: int) -> bool:
    if isinstance(x, bool) != isinstance(y, bool):
        return False
    if isinstance(x, float) or isinstance(y, float):
        if not (isinstance(x, (int, float)) and isinstance(y, (int, float))):
            return False
        unit = 1.01 * 10.0**-digits if digits >= 6 else 0.0
        return x == y or abs(x - y) <= unit + 1e-12 * abs(y)
    if isinstance(x, tuple) and isinstance(y, tuple):
        return len(x) == len(y) and all(_same(a, b, digits) for a, b in zip(x, y))
    return type(x) is type(y) and x == y


def compare(got: Result, oracle: Result, digits: int = 6, overrides: dict[str, int] | None = None) -> tuple[bool, str]:
    """Whether both results hold the same rows; ``digits`` is the rounding of doubles."""
    if sorted(got[0]) != sorted(oracle[0]):
        return False, f"columns differ: {sorted(got[0])} vs {sorted(oracle[0])}"
    if len(got[1]) != len(oracle[1]):
        return False, f"row count {len(got[1])} vs {len(oracle[1])}"
    digits_of = [(overrides or {}).get(c, digits) for c in sorted(got[0])]
    for ra, rb in zip(_rows(got), _rows(oracle)):
        if not all(_same(x, y, d) for x, y, d in zip(ra, rb, digits_of)):
            return False, f"row differs: {ra} vs {rb}"
    return True, "ok"


def check(spark, name: str, sf_dir: str) -> tuple[bool, str]:
    from riskweave.plans.registry import load_all

    q = load_all()[name]
    got = spark_result(q.run(spark, sf_dir))
    if q.sql is None:
        return True, f"rows-only ({len(got[1])} rows)"
    return compare(got, duckdb_result(q.sql, sf_dir), q.digits, q.overrides)
