"""Every registered query with SQL is compared with DuckDB at sf0.01
(the driver's correctness gate, run locally)."""

import pytest

from riskweave.plans.oracle import check, compare
from riskweave.plans.registry import load_all

from conftest import SF001

SQL_QUERIES = sorted(n for n, q in load_all().items() if q.sql is not None)


@pytest.mark.parametrize("name", SQL_QUERIES)
def test_query_matches_oracle(spark, name):
    ok, msg = check(spark, name, SF001)
    assert ok, msg


def test_checker_is_exact_but_for_rounding():
    base = (["n", "x", "s"], [(100_000, 1.25, "a"), (None, 2.0, "b")])
    assert compare(base, (["x", "s", "n"], [(2.0, "b", None), (1.2500005, "a", 100_000)]))[0]
    for row in ((100_001, 1.25, "a"), (100_000, 1.2501, "a"), (100_000, 1.25, "A"), (100_000, None, "a"), (100_000.0, 1.25, None)):
        assert not compare(base, (["n", "x", "s"], [row, (None, 2.0, "b")]))[0]
    assert not compare((["t"], [(1704067200000575,)]), (["t"], [(1704067200000000,)]))[0]
    assert not compare((["t"], [(True,)]), (["t"], [(1,)]))[0]


def test_entry_contract(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
