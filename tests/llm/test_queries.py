import os

import pytest

from tests.oracle import check, connect
from vellumix.llm.queries import R

COLUMNS = {"p1_found": ["name_a", "name_b"], "p5_found": ["doc_id", "seg_no", "lang"], "p6_found": ["line_id", "kind"], "p8_ids": ["doc_id", "ids"], "p10_found": ["doc_id"]}


@pytest.mark.parametrize("name", list(R.queries))
def test_columns_and_distinct_rows(spark, data, name):
    if not os.path.isdir(data):
        pytest.skip("no tables")
    df = R.queries[name](spark, data)
    assert df.columns == COLUMNS.get(name, df.columns)
    rows = [str(r) for r in df.collect()]
    assert len(rows) == len(set(rows))


def test_same_rows_as_sql(spark, data):
    for name, sql in R.sql.items():
        check(spark, connect(data), data, R.queries[name], sql)
