"""Every registered query against its DuckDB oracle at the smallest scale."""

import pytest

import __spark_entry__ as entry_mod
from dialtone.catalog.compare import compare
from dialtone.catalog.oracle import oracle_sql
from dialtone.catalog.queries import queries
from conftest import SMOKE_DIR


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(entry_mod.queries()) and set(oracle_sql()) <= set(entry_mod.oracle_sql())


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns[:3] == ["ivrcount", "queuedcount", "abandonedcount"]


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, name):
    rep = compare(spark, SMOKE_DIR, [name], verbose=True)[name]
    assert rep["values_ok"], rep


_KIND = {"integer": "int32", "int": "int32", "bigint": "int64", "double": "float64",
         "string": "str", "varchar": "str", "date": "date", "timestamp_ntz": "ts",
         "timestamp": "ts", "boolean": "bool"}


def test_result_types_match_oracle(spark):
    from dialtone.catalog.compare import duck_connection
    con = duck_connection(SMOKE_DIR)
    sqls = oracle_sql()
    mismatched = {}
    for name, build in queries().items():
        df = build(spark, SMOKE_DIR)
        spark_types = {f.name: _KIND.get(f.dataType.simpleString(), f.dataType.simpleString())
                       for f in df.schema.fields}
        rel = con.sql(sqls[name])
        duck_types = {c: _KIND.get(str(t).lower(), str(t).lower())
                      for c, t in zip(rel.columns, rel.types)}
        if spark_types != duck_types:
            mismatched[name] = (spark_types, duck_types)
    assert not mismatched, mismatched
