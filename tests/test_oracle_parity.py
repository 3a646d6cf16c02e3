"""Every registered query against its independent DuckDB SQL (sf0.001),
and the fused suite against the same SQL (sf0.01)."""

import pytest

from __spark_entry__ import entry
from cirrus.plans import oracle as O
from cirrus.plans import weather as W
from cirrus.plans.registry import FRESHNESS_AS_OF, registry
from cirrus.sources.derived import events_readings, orders_readings
from conftest import SF001, SF01, norm_rows

QUERIES = {name: fn for name, (fn, _) in registry().items()}
SQL = {name: sql for name, (_, sql) in registry().items() if sql is not None}


def _oracle(duck, schema, sql):
    cur = duck.cursor()
    cur.execute(f"SET schema = '{schema}'")
    res = cur.execute(sql)
    return [d[0] for d in res.description], res.fetchall()


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    ocols, orows = _oracle(duck, "s001", SQL[name])
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert norm_rows(df.columns, rows) == norm_rows(ocols, orows)


def test_entry_returns_rows(spark):
    df = entry(spark)
    assert df.columns[:2] == ["city", "country"]
    assert len(df.collect()) > 0


def test_fused_suite_matches_oracle(spark, duck):
    for view, readings in (("E", events_readings(spark, SF01)), ("O", orders_readings(spark, SF01))):
        results, shared = W.fused_queries(readings, FRESHNESS_AS_OF)
        for name, df in results.items():
            ocols, orows = _oracle(duck, "s01", O.query_sql(name, view))
            got = [tuple(r) for r in df.collect()]
            assert norm_rows(df.columns, got) == norm_rows(ocols, orows), (view, name)
        assert shared.columns
