"""Queries against their DuckDB statements."""

import pytest

from dialtone.llm.queries import QUERIES
from dialtone.llm.sql import ORACLE_SQL


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, run_sql, name):
    df = QUERIES[name](spark, sf_dir)
    names, want = run_sql(ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(names)
    got = [tuple(r) for r in df.select(*names).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_every_operator_has_one_query():
    numbers = [int(n[2:].split("_")[0]) for n in QUERIES]
    assert sorted(numbers) == list(range(1, 14))
