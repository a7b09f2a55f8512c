import os
import shutil

import pytest

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def run_sql():
    """Rows of a DuckDB statement over the tables of a folder."""
    import duckdb

    def run(sql, sf_dir=SF):
        con = duckdb.connect()
        for t in TABLES:
            con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
        found = con.sql(sql)
        return found.columns, found.fetchall()
    return run


@pytest.fixture
def tables_dir(tmp_path):
    """Write frames as <name>.parquet beside copies of the other tables."""

    def write(**frames):
        for t in TABLES:
            if t in frames:
                frames[t].coalesce(1).write.parquet(str(tmp_path / f"{t}.parquet"))
            else:
                shutil.copy(os.path.join(SF, f"{t}.parquet"), tmp_path / f"{t}.parquet")
        return str(tmp_path)
    return write
