import os

import pytest

from tests.oracle import check, connect
from vellumix.plans import REGISTRIES

CASES = [(n, r.queries[n], s) for r in REGISTRIES for n, s in r.sql.items()]
ROWS_ONLY = [(n, q) for r in REGISTRIES for n, q in r.queries.items() if n not in r.sql]


@pytest.fixture(scope="module")
def con(data):
    if not os.path.isdir(data):
        pytest.skip("no tables")
    return connect(data)


@pytest.mark.parametrize("name,query,sql", CASES, ids=[c[0] for c in CASES])
def test_same_rows_as_sql(spark, con, data, name, query, sql):
    check(spark, con, data, query, sql)


@pytest.mark.parametrize("name,query", ROWS_ONLY, ids=[c[0] for c in ROWS_ONLY])
def test_runs(spark, con, data, name, query):
    df = query(spark, data)
    assert len(df.collect()) > 0


def test_entry_has_rows_and_every_sql_a_query(spark, con):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
