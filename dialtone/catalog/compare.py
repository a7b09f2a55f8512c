"""Run a registered query on Spark and its oracle SQL on DuckDB, compare results.

Usage: python -m dialtone.catalog.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return f"{round(v, 6):.6f}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.6f}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime().isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    return str(v)


def normalise(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted((tuple(_norm(r[i]) for i in order) for r in rows),
                 key=lambda t: tuple("" if x is None else x for x in t))
    return cols, out


def digest(rows: list[tuple]) -> str:
    h = hashlib.sha256()
    for r in rows:
        h.update(repr(r).encode())
    return h.hexdigest()[:16]


def duck_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict:
    from dialtone.catalog.oracle import oracle_sql
    from dialtone.catalog.queries import queries

    qs, sqls = queries(), oracle_sql()
    con = duck_connection(sf_dir)
    report = {}
    for name in names or list(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        t_spark = time.time() - t0
        entry = {"rows": len(s_rows), "spark_sec": round(t_spark, 2)}
        if name in sqls:
            rel = con.sql(sqls[name])
            d_cols = list(rel.columns)
            d_rows = rel.fetchall()
            sc, sr = normalise(s_cols, s_rows)
            dc, dr = normalise(d_cols, d_rows)
            entry.update(oracle_rows=len(d_rows), schema_ok=sc == dc,
                         values_ok=sr == dr and sc == dc)
            if verbose and not entry["values_ok"]:
                if sc != dc:
                    print(name, "columns differ:", sorted(set(sc) ^ set(dc)))
                else:
                    ds, dd = set(sr) - set(dr), set(dr) - set(sr)
                    print(name, "spark-only rows:", list(ds)[:3])
                    print(name, "oracle-only rows:", list(dd)[:3])
                    for i, col in enumerate(sc):
                        a = sorted((r[i] or "") for r in sr)
                        b = sorted((r[i] or "") for r in dr)
                        if a != b:
                            print("   column differs:", col)
        report[name] = entry
        if verbose:
            print(name, entry, flush=True)
    return report


def main(argv: list[str]) -> int:
    from dialtone.session import build_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    rep = compare(spark, sf_dir, argv[1:] or None)
    bad = [n for n, e in rep.items() if e.get("values_ok") is False]
    print("FAILED:" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
