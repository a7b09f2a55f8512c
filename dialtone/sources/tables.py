"""Reading parquet tables with a declared schema."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialtone import schemas


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; projections and filters applied later reach the reader."""
    return spark.read.parquet(table_path(sf_dir, name))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns in order, cast to the declared types.

    A declared column the input lacks becomes a typed NULL: this is how a
    column added later to a table (``ALTER TABLE .. ADD COLUMN``) reads
    from files written before it existed.
    """
    present = set(df.columns)
    cols = []
    for field in schema.fields:
        if field.name in present:
            c = F.col(field.name)
            if df.schema[field.name].dataType != field.dataType:
                c = c.cast(field.dataType)
        else:
            c = F.lit(None).cast(field.dataType)
        cols.append(c.alias(field.name))
    return df.select(*cols)


def with_added_columns(df: DataFrame, table: str) -> DataFrame:
    """``df`` with the columns that ``table`` got later, as typed NULLs where it lacks them."""
    added = schemas.ADDED_COLUMNS[table]
    kept = [f for f in df.schema.fields if f.name not in added.fieldNames()]
    return conform(df, T.StructType([*kept, *added.fields]))


def read_evolving(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Read files written under older and newer versions of one table.

    Parquet schema merging unions the file schemas; ``conform`` then pins
    the result to the declared schema, so a column missing from older files
    (or from all files) reads as NULL.
    """
    df = spark.read.option("mergeSchema", "true").parquet(*paths)
    return conform(df, schema)
