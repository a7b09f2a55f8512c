"""Consecutive row ids in a total order, without a one-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ROW = (1 << 33) - 1  # monotonically_increasing_id(): partition number above, row number below


def _ascending(order: list[str]) -> Column:
    """The order columns as one comparable value, NULLs last."""
    return F.struct(*[x for k, name in enumerate(order) for x in (
        F.col(name).isNull().alias(f"n{k}"), F.col(name).alias(f"v{k}"))])


def ordered_index(df: DataFrame, order: list[str], name: str = "id", partitions: int | None = None) -> DataFrame:
    """The rows of ``df`` in the order of ``order`` (NULLs last), with ``name`` = 1, 2, ...

    ``row_number() OVER (ORDER BY ..)`` moves every row to one task. Here one range
    exchange deals the rows into ``partitions`` (default: shuffle partitions) of
    about equal size; rows are numbered within their partition, and the sizes of
    the partitions before it are added. The sizes are read from the same exchange
    as a single array, one entry a partition, so the input runs once and nothing
    is joined. The result is sorted: it needs no ``orderBy``.

    Both readers must see the same partitions. ``spark.sql.exchange.reuse`` (on by
    default) sees to it; every row is also checked to lie between the first and the
    last row that its partition had when it was counted, and the query fails if not.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # packed as in one_exchange: what lies under the exchange is the same for both readers
    dealt = (df.select(_ascending(order).alias("_key"), F.array(F.struct(*df.columns)).alias("_row"))
             .repartitionByRange(n, "_key"))
    whole = F.when(F.monotonically_increasing_id() >= 0, F.col("_row"))  # keeps the rows in this reader's exchange too
    counted = (dealt.select("_key", F.spark_partition_id().alias("p"), whole.alias("row")).groupBy("p")
               .agg(F.count("row").alias("n"), F.min("_key").alias("low"), F.max("_key").alias("high")))
    sizes = counted.agg(F.collect_list(F.struct("p", "n", "low", "high")).alias("s"))  # one entry a partition
    starts = sizes.select(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda p: F.struct(
        F.aggregate(F.filter("s", lambda x: x["p"] < p), F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("before"),
        F.get(F.filter("s", lambda x: x["p"] == p), F.lit(0)).alias("own"))).alias("starts")).scalar()
    placed = (dealt.sortWithinPartitions("_key")
              .select("_key", "_row", F.monotonically_increasing_id().alias("_at"))
              .withColumn("_start", F.get(starts, F.shiftright("_at", 33).cast("int"))))
    same = F.col("_key").between(F.col("_start.own.low"), F.col("_start.own.high"))
    number = (F.col("_start.before") + F.col("_at").bitwiseAND(F.lit(_ROW)) + 1).cast("int")
    checked = F.when(same, number).otherwise(F.raise_error(F.lit("the range exchange was not shared")).cast("int"))
    return placed.select(checked.alias(name), *[F.col("_row")[0][x].alias(x) for x in df.columns])
