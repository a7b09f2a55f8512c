"""Shared helpers: table access, intermediate tables, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialtone.session import shared_folder

#: Arrow batches are cut into pieces of about so many bytes of text before numpy sees them.
PIECE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/corpus/{name}-{uuid.uuid4().hex}"


_SCOPES: list[list[str]] = []
#: Paths of the tables made by :func:`stored_by`, which the catalog knows.
_TABLES: set[str] = set()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage there.

    A lost executor then costs only the tasks that were running on it, and a
    table that is used twice is computed once. Inside :func:`scratch` the table goes when that ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    if _SCOPES:
        _SCOPES[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    # shuffle files of plans that nothing refers to any more go when the driver's JVM collects these
    spark._jvm.System.gc()
    out = spark.read.schema(schema).parquet(path)
    out.stored_at = path
    return out


def stored_by(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """As :func:`stored`, in buckets by ``keys``: joins on all of them don't shuffle the table again.

    ``df`` should be dealt by ``keys`` already, as an aggregation by them leaves it;
    there are as many buckets as shuffle partitions, each in one file then.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _SCOPES:
        _SCOPES[-1].append(path)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.write.option("compression", "zstd").bucketBy(buckets, *keys)
     .option("path", path).saveAsTable(_table_name(path)))
    spark._jvm.System.gc()
    out = spark.table(_table_name(path))
    out.stored_at = path
    _TABLES.add(path)
    return out


def _table_name(path: str) -> str:
    return "corpus_" + path.rsplit("/", 1)[1].replace("-", "_")


def _delete(spark: SparkSession, path: str) -> None:
    if path in _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_table_name(path)}")
        _TABLES.remove(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def remove(df: DataFrame) -> None:
    """Delete the files under a table made by :func:`stored` that nothing reads any more."""
    _delete(df.sparkSession, df.stored_at)
    for scope in _SCOPES:
        if df.stored_at in scope:
            scope.remove(df.stored_at)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A scope whose :func:`stored` tables are deleted at its end, but for those given to the function it yields.

    These belong to the scope around it, if there is one. What a result still
    reads must be kept; the shuffles of the others are left to Spark's cleaner.
    """
    made: list[str] = []
    kept: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df.stored_at)
        return df

    _SCOPES.append(made)
    try:
        yield keep
    except BaseException:
        kept.clear()
        raise
    finally:
        _SCOPES.pop()
        for path in made:
            if path not in kept:
                _delete(spark, path)
        if _SCOPES:
            _SCOPES[-1].extend(kept)


def pieces(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``PIECE_BYTES`` of text each, one row at least."""
    n, size = batch.num_rows, batch.column(batch.schema.get_field_index(text)).nbytes
    step = max(1, int(n * PIECE_BYTES / max(size, 1)))
    for at in range(0, n, step):
        yield batch.slice(at, step)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable id of every node that has an edge.

    ``edges`` has two bigint columns ``a``, ``b`` in any order; loops and
    repeats do no harm, rows with a null are left out. Alternates the large-star
    and small-star steps, each an aggregation (combined before the shuffle) and
    an equi-join, until the edges are stars around the smallest id. Every round
    is written to the shared folder; nothing is collected but a count and a
    checksum of each round. Returns (node, component), which reads the last round's table.
    """
    links = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m"))
        .distinct(), "edges")
    before = _fingerprint(links)
    for _ in range(max_rounds):
        both = links.select(F.col("v").alias("u"), F.col("m").alias("w")).unionByName(
            links.select(F.col("m").alias("u"), F.col("v").alias("w")))
        low = both.groupBy("u").agg(F.min("w").alias("lo")).select(
            "u", F.least("u", "lo").alias("m"))
        large = both.join(low, "u").where("w > u").select(F.col("w").alias("v"), "m").distinct()
        low = large.groupBy("v").agg(F.min("m").alias("lo"))
        small = large.join(low, "v")
        step = (small.where("m > lo").select(F.col("m").alias("v"), F.col("lo").alias("m"))
                .unionByName(low.select("v", F.col("lo").alias("m"))).distinct())
        nxt = stored(step, "edges")
        after = _fingerprint(nxt)
        remove(links)
        links = nxt
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = links.select(F.col("m").alias("node"), F.col("m").alias("component")).distinct()
    out = links.select(F.col("v").alias("node"), F.col("m").alias("component")).unionByName(roots)
    out.stored_at = links.stored_at
    return out


def _fingerprint(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("v", "m")).alias("x")).first()
    return row["n"], row["x"]
