"""Materialising reports: the agent productivity summary table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialtone import schemas
from dialtone.sources.days import DayTable


def summary_rows(report: DataFrame, bu: str | None = None) -> DataFrame:
    """A report's rows with the declared columns and types of the summary table.

    ``bu`` fills the unit column for reports that have none.
    """
    df = report if "bu" in report.columns else report.withColumn("bu", F.lit(bu).cast("string"))
    missing = [f.name for f in schemas.AGENT_SUMMARY if f.name not in df.columns]
    if missing:
        raise ValueError(f"the report lacks {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.AGENT_SUMMARY])


def agent_summary(spark: SparkSession, path: str) -> DayTable:
    """The summary table, stored by ``summary_date``."""
    return DayTable(spark, path, schemas.AGENT_SUMMARY, "summary_date")


def write_agent_summary(report: DataFrame, path: str, first: dt.date, last: dt.date, bu: str | None = None) -> list[dt.date]:
    """Replace the dates ``first`` .. ``last`` of the summary table by the report's rows, all at once.

    The report runs once. Readers see the old range until all rows are written;
    a run that fails leaves it, and is simply repeated. Returns the dates that have rows.
    """
    return agent_summary(report.sparkSession, path).replace(summary_rows(report, bu), first, last)


def read_agent_summary(spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """The summary table with its declared schema, or a range of its dates."""
    return agent_summary(spark, path).read(first, last)
