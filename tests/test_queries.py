import pytest

import __spark_entry__ as entry
from tests.oracle import spark_rows, sql_rows
from tidemark.plans import gates as _, rules as _rules  # noqa: F401
from tidemark.plans.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    got = spark_rows(QUERIES[name](spark, sf_dir))
    if name in ORACLES:
        assert got == sql_rows(ORACLES[name], sf_dir)
    else:
        assert got[0]


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[0] == "event_id"
    assert set(entry.oracle_sql()) <= set(entry.queries())


