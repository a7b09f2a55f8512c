"""One exchange for several readers of the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_exchange(df: DataFrame, by: list[str]) -> DataFrame:
    """``df`` dealt by the columns ``by``, such that all its readers share one exchange.

    Two aggregates over the same rows usually run their source twice: each needs
    other columns or other rows, so Spark prunes and filters below the exchange, and
    the two exchanges differ. Here the columns that are not dealt by travel in an
    array of one struct, which is pruned as a whole or not at all, and are unpacked
    under a condition on the row's position, below which no filter is moved. What
    lies under the exchange is then the same for every reader, and Spark reuses it.
    """
    rest = [x for x in df.columns if x not in by]
    packed = df.select(*by, F.array(F.struct(*rest)).alias("_rest")).repartition(*by)
    here = packed.select(*by, F.when(F.monotonically_increasing_id() >= 0, F.col("_rest")).alias("_rest"))
    return here.select(*[F.col("_rest")[0][x].alias(x) if x in rest else F.col(x) for x in df.columns])
