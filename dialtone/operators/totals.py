"""Grand totals attached to every row, without a one-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialtone.functions.fmt import format_hms
from dialtone.operators.shared import one_exchange


def with_grand_totals(df: DataFrame, totals: dict[str, Column],
                      outputs: list[Column] | None = None,
                      source: DataFrame | None = None,
                      durations: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
    """Add ``SUM(..) OVER ()``-style totals over all rows of ``source`` as columns of ``df``.

    ``OVER ()`` would pull every row into one task. Instead the totals are
    one global aggregate (partial sums per partition, one tiny final merge)
    evaluated as a single scalar subquery returning a struct; its value is
    then a constant in the projection of ``df``. ``outputs`` (expressions
    over the total columns, e.g. formatting) are evaluated once inside the
    subquery rather than on every row; ``durations`` names output columns
    (whole seconds) to format as ``HH:MM:SS`` there. ``source`` defaults to ``df``.

    So that rows and totals come from one run of their input, either both ``df`` and
    ``source`` read rows of one :func:`~dialtone.operators.shared.one_exchange`, or
    ``by`` names columns by which ``df`` is dealt here.
    """
    if not totals:
        return df
    if by is not None:
        df = one_exchange(df, by)
    src = source if source is not None else df
    agg = src.agg(*[e.alias(n) for n, e in totals.items()])
    if outputs is not None:
        agg = agg.select(*outputs)
    if durations:
        agg = format_hms(agg, durations)
    names = agg.columns
    packed = agg.select(F.struct(*names).alias("_t")).scalar()
    # one subquery expression, unpacked in a second projection (a getField per
    # total on the subquery itself would embed one copy of its plan per field)
    with_struct = df.select("*", packed.alias("_grand_totals"))
    return with_struct.select(*[F.col(x) for x in df.columns],
                              *[F.col("_grand_totals").getField(n).alias(n) for n in names])
