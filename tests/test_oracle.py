"""Every query that SQL can express equals DuckDB's result on the same tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import differences

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(name, spark, sf_dir, duck):
    assert differences(QUERIES[name](spark, sf_dir), duck, SQL[name]) == []


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_comparison_notices_a_difference(spark, sf_dir, duck):
    segments = SQL["rate_segments"].replace("<= 1000", "<= 1100")
    assert segments != SQL["rate_segments"]
    assert differences(QUERIES["rate_segments"](spark, sf_dir), duck, segments) != []
    changed = SQL["class_balance"].replace(">= 7500", "> 7000")
    assert differences(QUERIES["class_balance"](spark, sf_dir), duck, changed) != []


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert sum(r["count"] for r in rows) == 6000
    assert sum(r["percentage"] for r in rows) == pytest.approx(100)
