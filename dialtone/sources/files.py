"""Small files and folders of any store that Spark can reach, through Hadoop's file API."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none where the folder doesn't exist."""
    fs, path = _open(spark, folder)
    return sorted(x.getPath().getName() for x in fs.listStatus(path)) if fs.exists(path) else []


def matches(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    fs, path = _open(spark, pattern)
    return sorted(x.getPath().toString() for x in fs.globStatus(path) or [])


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _open(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that must not exist yet; fails if another writer was first."""
    fs, hadoop_path = _open(spark, path)
    stream = fs.create(hadoop_path, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _open(spark, path)
    fs.delete(hadoop_path, True)
