"""Print the formatted physical plan of registered queries.

Usage: python -m dialtone.catalog.explain [sf_dir] name [name ...]

Shows what reaches each parquet scan (``PushedFilters``, ``ReadSchema``),
where the exchanges are, and which joins are broadcast.
"""

from __future__ import annotations

import sys


def main(argv: list[str]) -> int:
    from dialtone.catalog.queries import queries
    from dialtone.session import build_session

    sf_dir, names = (argv[0], argv[1:]) if argv and "/" in argv[0] else ("/root/testdata/sf0.01", argv)
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    qs = queries()
    for name in names:
        print(f"===== {name} =====")
        qs[name](spark, sf_dir).explain("formatted")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
