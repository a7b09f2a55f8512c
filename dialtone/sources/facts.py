"""Fact tables stored by day, and call legs bucketed by their uuid.

``call legs``, ``status``, ``acw`` and ``breaks`` are stored by the UTC day of their
timestamp, in a column ``<timestamp>_day`` that the operators know
(``operators.cdr.within``): a report over a week opens the folders of eight days.
Daily summaries are stored by their own ``summary_date``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialtone import schemas
from dialtone.operators.cdr import day_column
from dialtone.sources.days import DayTable
from dialtone.sources.tables import conform

# the column whose day a fact table is stored by
TIMES = {"cdr": "created_time", "status": "created_at", "acw": "created_at", "breaks": "created_at",
         "counter_events": "ts"}


def fact_table(spark: SparkSession, root: str, name: str) -> DayTable:
    """The fact table ``name`` (a key of ``TIMES``, or ``daily``) under ``root``."""
    if name == "daily":
        return DayTable(spark, f"{root}/daily", schemas.DAILY, "summary_date")
    day = day_column(TIMES[name])
    schema = T.StructType([*schemas.ALL[name].fields, T.StructField(day, T.DateType())])
    return DayTable(spark, f"{root}/{name}", schema, day)


def write_fact(df: DataFrame, root: str, name: str, first: dt.date, last: dt.date) -> list[dt.date]:
    """Replace the days ``first`` .. ``last`` of a fact table by the rows of ``df`` on these days."""
    rows = conform(df, schemas.ALL[name])
    if name != "daily":
        rows = rows.withColumn(day_column(TIMES[name]), F.to_date(TIMES[name]))
    return fact_table(df.sparkSession, root, name).replace(rows, first, last)


def read_fact(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A fact table in its declared columns, and the day column that prunes it."""
    return fact_table(spark, root, name).read()


# ---- legs by uuid -----------------------------------------------------------

def write_legs_by_uuid(cdr: DataFrame, table: str, path: str, buckets: int = 64, mode: str = "append") -> None:
    """Store what after-call work needs of the legs, bucketed by uuid, as the catalog table ``table`` at ``path``.

    Appending new days adds files to the buckets; a uuid stays in one bucket.
    Choose ``buckets`` for the table's final size (a bucket is read by one task).
    """
    legs = cdr.select("uuid", "direction")
    (legs.repartition(buckets, "uuid").write.mode(mode).bucketBy(buckets, "uuid").sortBy("uuid")
     .option("path", path).saveAsTable(table))
