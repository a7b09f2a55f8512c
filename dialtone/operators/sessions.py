"""Agent state-change events (``status``): ranks, leads, spans, first/last per day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialtone.functions.timefx import ts_literal, utc_date
from dialtone.operators.cdr import day_column, within
from dialtone.operators.shared import one_exchange

c = F.col


def day_window(first: dt.date, last: dt.date) -> Column:
    """``created_at`` on one of the UTC days ``first .. last`` (pushes down as a range)."""
    lo = dt.datetime.combine(first, dt.time(0))
    hi = dt.datetime.combine(last + dt.timedelta(days=1), dt.time(0))
    return (c("created_at") >= ts_literal(lo)) & (c("created_at") < ts_literal(hi))


def first_last_per_day(status: DataFrame, keys: list[str], first: dt.date, last: dt.date,
                       first_reason: str = "Register", last_reason: str = "UnRegister",
                       extra: Column | None = None) -> DataFrame:
    """Per UTC day and ``keys``: earliest ``first_reason`` and latest ``last_reason`` time.

    Columns: ``day``, ``keys``, ``first_at``, ``last_at`` (NULL when that
    reason did not occur). Only days ``first .. last`` are read: a report
    joins these on a summary date in that range, so older rows never match.
    """
    cond = c("reason").isin(first_reason, last_reason) & day_window(first, last)
    if extra is not None:
        cond &= extra
    if day_column("created_at") in status.columns:
        cond &= c(day_column("created_at")).between(F.lit(first), F.lit(last))
    return (status.filter(cond)
            .groupBy(utc_date("created_at").alias("day"), *keys)
            .agg(F.min(F.when(c("reason") == first_reason, c("created_at"))).alias("first_at"),
                 F.max(F.when(c("reason") == last_reason, c("created_at"))).alias("last_at")))


def last_before(status: DataFrame, reason: str, before, by: str = "resource_id",
                extra: Column | None = None, name: str = "last_at", keep_null: bool = False) -> DataFrame:
    """Latest ``reason`` event strictly before ``before``, per ``by``.

    The as-of lookup ``ORDER BY createdAt DESC LIMIT 1`` per agent, as a
    filtered ``max`` aggregate: partial maxima are combined map-side, so
    the shuffle carries at most one row per agent and partition. The lookup is
    by equality, so a NULL ``by`` has no event: it has no row, or with ``keep_null``
    a row in which ``name`` is NULL. Without a snapshot
    (``operators.snapshots``) the whole history before ``before`` is read.
    """
    cond = (c("reason") == reason) & (c("created_at") < ts_literal(before))
    if extra is not None:
        cond &= extra
    if not keep_null:
        cond &= c(by).isNotNull()
    found = status.filter(cond).groupBy(by).agg(F.max("created_at").alias(name))
    return found.withColumn(name, F.when(c(by).isNotNull(), c(name))) if keep_null else found


def micros_between(a: Column, b: Column) -> Column:
    """``b - a`` in microseconds (interval arithmetic kept exact as a long)."""
    return F.timestamp_diff("MICROSECOND", a, b)


def spans(status: DataFrame, start_reason: str, end_reason: str, from_ts, to_ts,
          require_next: str | None = None, bucket: str = "1 hour") -> DataFrame:
    """Each ``start_reason`` event with the time to the agent's next event.

    Only ``start_reason``/``end_reason`` events in ``[from_ts, to_ts]`` are
    considered; the span of a start event runs to the next such event
    (of either kind) and is NULL for the agent's last event. With
    ``require_next`` only spans closed by that reason are kept (login
    sessions: Register immediately followed by UnRegister).
    Columns: resource_id, tenant_id, company_id, business_unit,
    start_at, end_at, span_us.
    """
    ev = lead_in_time(within(status, "created_at", from_ts, to_ts, inclusive_end=True).filter(
        c("reason").isin(start_reason, end_reason)).select(
        "resource_id", "created_at", "reason", "tenant_id", "company_id", "business_unit"),
        ["resource_id"], bucket=bucket)
    keep = c("reason") == start_reason
    if require_next is not None:
        keep &= c("next_reason") == require_next
    return ev.filter(keep).select(
        "resource_id", "tenant_id", "company_id", "business_unit",
        c("created_at").alias("start_at"), c("next_at").alias("end_at"),
        micros_between(c("created_at"), c("next_at")).alias("span_us"))


# --- skew-safe ordered operators -------------------------------------------
# One agent may own a large share of all events. A window partitioned by the
# agent alone sorts all of that agent's events in one task. The operators
# below partition by (agent, time bucket) instead and stitch the buckets
# together through a per-bucket table with one row per non-empty bucket.

BUCKET = "1 hour"


def _bucket(ts: Column, bucket: str = BUCKET) -> Column:
    return F.date_trunc(_unit(bucket), ts)


def _unit(bucket: str) -> str:
    n, unit = bucket.split()
    if n != "1" or unit not in ("minute", "hour", "day"):
        raise ValueError("bucket must be '1 minute', '1 hour' or '1 day'")
    return unit


def _dealt(events: DataFrame, by: list[str], ts: str, bucket: str) -> DataFrame:
    """``events`` with ``_key``, a struct of the group and the time bucket, dealt by it once for all readers.

    A struct is never NULL itself, and two structs with NULL in the same place are
    equal: NULL groups are found again by a plain join on ``_key``.
    """
    key = F.struct(*by, _bucket(F.col(ts), bucket).alias("_bucket"))
    return one_exchange(events.withColumn("_key", key), ["_key"])


def lead_in_time(events: DataFrame, by: list[str], ts: str = "created_at",
                 carry: str = "reason", bucket: str = BUCKET) -> DataFrame:
    """Add ``next_at`` / ``next_{carry}``: the next event of the same ``by`` group in time.

    Equals ``LEAD(ts)`` / ``LEAD(carry)`` over ``PARTITION BY by ORDER BY ts,
    carry`` (the last event gets NULL), computed in two levels: within each
    (group, bucket) by a window, and across buckets from each bucket's first
    event, looked up through the bucket-level table. One exchange of the events
    serves the window, the bucket table and the join of the two.
    """
    dealt = _dealt(events, by, ts, bucket)
    w = Window.partitionBy("_key").orderBy(ts, carry)
    ev = (dealt.withColumn("next_at", F.lead(ts).over(w))
          .withColumn(f"next_{carry}", F.lead(carry).over(w)))
    heads = dealt.groupBy("_key").agg(F.min(F.struct(F.col(ts).alias("t"), F.col(carry).alias("v"))).alias("_head"))
    wb = Window.partitionBy(*[F.col("_key")[x] for x in by]).orderBy(F.col("_key._bucket"))
    out = ev.join(heads.select("_key", F.lead("_head").over(wb).alias("_next_head")), "_key", "left")
    last = F.col("next_at").isNull()
    return (out.withColumn(f"next_{carry}", F.when(last, F.col("_next_head.v"))
                           .otherwise(F.col(f"next_{carry}")))
            .withColumn("next_at", F.when(last, F.col("_next_head.t")).otherwise(F.col("next_at")))
            .drop("_next_head", "_key"))


def running_count(events: DataFrame, by: list[str], cond: Column, name: str,
                  ts: str = "created_at", tiebreak: str = "reason",
                  bucket: str = BUCKET) -> DataFrame:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END) OVER (PARTITION BY by ORDER BY ts ROWS
    UNBOUNDED PRECEDING)``, in two levels: a running count within each (group,
    bucket) plus the total of all earlier buckets of the group.
    """
    dealt = _dealt(events.withColumn("_flag", F.when(cond, 1).otherwise(0)), by, ts, bucket)
    w = (Window.partitionBy("_key").orderBy(ts, tiebreak)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ev = dealt.withColumn("_in_bucket", F.sum("_flag").over(w))
    totals = dealt.groupBy("_key").agg(F.sum("_flag").alias("_bucket_total"))
    wb = (Window.partitionBy(*[F.col("_key")[x] for x in by]).orderBy(F.col("_key._bucket"))
          .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("_key", F.coalesce(F.sum("_bucket_total").over(wb), F.lit(0)).alias("_before"))
    return (ev.join(offsets, "_key", "left")
            .withColumn(name, (F.col("_before") + F.col("_in_bucket")).cast("bigint"))
            .drop("_key", "_flag", "_in_bucket", "_before"))


# The state-change reasons that open and close each kind of span.
SPAN_REASONS = {
    "login": ("Register", "UnRegister"),
    "inbound": ("Inbound", "endInbound"),
    "outbound": ("Outbound", "endOutbound"),
}


def span_totals(status: DataFrame, from_ts, to_ts, bucket: str = BUCKET) -> DataFrame:
    """Per agent: total login-session, inbound-mode and outbound-mode time (microseconds).

    ``login_us``: each Register immediately followed (among Register and
    UnRegister events) by an UnRegister, summed. ``inbound_us`` /
    ``outbound_us``: each Inbound (Outbound) event to the agent's next
    Inbound/endInbound (Outbound/endOutbound) event, summed; a last, open
    span adds nothing. Events are those in ``[from_ts, to_ts]``. The three
    event families share one two-level ``lead`` pass, keyed by family.
    Totals are per agent (the original grouped them by tenant, company
    and unit but joined on the agent only, multiplying rows).
    """
    family = F.lit(None).cast("string")
    for fam, (opening, closing) in SPAN_REASONS.items():
        family = F.when(F.col("reason").isin(opening, closing), F.lit(fam)).otherwise(family)
    all_reasons = [r for pair in SPAN_REASONS.values() for r in pair]
    ev = (within(status, "created_at", from_ts, to_ts, inclusive_end=True).filter(F.col("reason").isin(all_reasons))
          .select("resource_id", "created_at", "reason", family.alias("family")))
    ev = lead_in_time(ev, ["resource_id", "family"], bucket=bucket)
    span = micros_between(F.col("created_at"), F.col("next_at"))
    opened = lambda fam: F.col("reason") == SPAN_REASONS[fam][0]
    login = opened("login") & (F.col("next_reason") == SPAN_REASONS["login"][1])
    return ev.groupBy("resource_id").agg(
        F.sum(F.when(login, span)).alias("login_us"),
        F.sum(F.when(opened("inbound"), span)).alias("inbound_us"),
        F.sum(F.when(opened("outbound"), span)).alias("outbound_us"),
    )
