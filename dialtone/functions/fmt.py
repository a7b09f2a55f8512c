"""Number and duration formatting expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def int_div(a: Column, b: Column | int) -> Column:
    """Integer division truncating toward zero (SQL ``div``); NULL if ``b`` is 0 or NULL."""
    b = F.lit(b) if isinstance(b, int) else b
    return F.when(b != 0, F.call_function("div", a.cast("bigint"), b.cast("bigint")))


def hms(seconds: Column) -> Column:
    """Whole seconds -> ``HH:MM:SS`` text (NULL stays NULL).

    Hours are not wrapped at 24 (90000 -> ``25:00:00``); division and
    remainder truncate toward zero, so every non-zero negative field
    carries its own minus: -3661 -> ``-01:-01:-01``, -30 -> ``00:00:-30``.
    Kept small on purpose (plain string functions, no repeated subtrees):
    reports format dozens of columns in one projection, and the generated
    code of that projection must stay within the JVM's method size limit.
    Pass a column reference: the input is used several times.
    """
    s = seconds.cast("bigint")
    h = F.call_function("div", s, F.lit(3600))
    m = F.call_function("div", s % 3600, F.lit(60))
    sec = s % 60
    hours = F.concat(F.when(h < 0, F.lit("-")).otherwise(F.lit("")),
                     F.when(F.abs(h) < 10, F.lit("0")).otherwise(F.lit("")),
                     F.abs(h).cast("string"))
    return F.concat(hours, F.lit(":"), _field60(m), F.lit(":"), _field60(sec))


def _field60(x: Column) -> Column:
    # |x| < 60: two digits, a negative field keeps its own minus ("-01")
    return F.concat(F.when(x < 0, F.lit("-")).otherwise(F.lit("")),
                    F.lpad(F.abs(x).cast("string"), 2, "0"))


def hms_sql(col: str) -> str:
    """``hms`` as Spark SQL text over a column reference (one JVM call to build)."""
    x = f"cast(`{col}` AS bigint)"
    h, m, sec = f"({x} div 3600)", f"(({x} % 3600) div 60)", f"({x} % 60)"
    return (f"concat(if({h} < 0, '-', ''), if(abs({h}) < 10, '0', ''), cast(abs({h}) AS string), ':', "
            f"if({m} < 0, '-', ''), lpad(cast(abs({m}) AS string), 2, '0'), ':', "
            f"if({sec} < 0, '-', ''), lpad(cast(abs({sec}) AS string), 2, '0'))")


def format_hms(df: DataFrame, names: list[str] | set[str]) -> DataFrame:
    """Second projection turning the named whole-second columns into ``HH:MM:SS``.

    Durations are first computed as numbers in one projection and then
    formatted here from plain column references, which keeps each
    generated method small (a wide report would otherwise exceed the JVM
    method size limit and lose whole-stage code generation). The
    expressions are SQL text, so building a wide projection costs one
    JVM call per column.
    """
    names = set(names)
    return df.selectExpr(*[f"{hms_sql(n)} AS `{n}`" if n in names else f"`{n}`"
                           for n in df.columns])


def pct_int(part: Column, whole: Column) -> Column:
    """``part * 100 / whole`` in integer arithmetic; NULL when either side is NULL."""
    return int_div(part.cast("bigint") * 100, whole)


def round_avg_to_long(total: Column, n: Column) -> Column:
    """``round(total / n)`` half away from zero, exact on integers; NULL if ``n`` is 0/NULL.

    Spark's double -> bigint cast truncates while the reference's numeric
    cast rounds; this does the rounding in integer arithmetic instead.
    """
    t = total.cast("bigint")
    m = n.cast("bigint")
    q = int_div(F.abs(t) * 2 + F.abs(m), F.abs(m) * 2)
    return F.when(m != 0, F.when((t < 0) != (m < 0), -q).otherwise(q))
