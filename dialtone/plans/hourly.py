"""Hourly call summaries (inbound per skill, with empty hours filled in).

One scan of ``cdr`` and one conditional aggregate replace the per-measure
subqueries and join chains of the row-store version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialtone.functions.fmt import hms, pct_int
from dialtone.functions.timefx import DEFAULT_TZ, local_ts
from dialtone.operators import cdr as ops
from dialtone.operators.spine import hour_spine

c = F.col

OUTBOUND = ("outboundcallcount", "holdsec_avg_outbound_s", "billsec_avg_outbound_s", "answered_count_outbound")


def _with_local_hour(df: DataFrame, tz: str) -> DataFrame:
    lt = local_ts("created_time", tz)
    return df.withColumn("c_date", F.to_date(lt)).withColumn("c_hour", F.hour(lt))


def _inbound(cdr, from_ts, to_ts, skills, tz, b_unit, company, tenant, inclusive_end,
             from_hour=None, to_hour=None) -> DataFrame:
    legs = ops.filter_calls(cdr, from_ts, to_ts, inclusive_end=inclusive_end, company=company,
                            tenant=tenant, b_unit=b_unit, direction="inbound", obj_type="HTTAPI",
                            skills=skills)
    legs = _with_local_hour(legs, tz)
    if from_hour is not None:
        legs = legs.filter(c("c_hour").between(from_hour, to_hour))
    return (legs.groupBy("c_date", "c_hour", "agent_skill", "company_id", "tenant_id")
            .agg(*ops.inbound_measures()))


def _formatted_inbound() -> list:
    return [
        c("ivrcount"), c("queuedcount"), c("abandonedcount"),
        pct_int(c("abandonedcount"), c("queuedcount")).alias("abandonedpercent"),
        c("droppedcount"),
        pct_int(c("droppedcount"), c("queuedcount")).alias("droppedpercent"),
        hms(c("holdsec_avg_s")).alias("holdsec_avg"),
        hms(c("ivrconnect_avg_s")).alias("ivrconnect_avg"),
        hms(c("answersec_avg_s")).alias("answersec_avg"),
        hms(c("billsec_avg_s")).alias("billsec_avg"),
        c("answered_count"),
        hms(c("queuesec_avg_s")).alias("queuesec_avg"),
        pct_int(c("answered_count"), c("queuedcount")).alias("answeredpercent"),
        hms(c("abandonedqueue_avg_s")).alias("abandonedqueue_avg"),
        hms(c("answeredqueue_avg_s")).alias("answeredqueue_avg"),
    ]


def _tail() -> list:
    return [c("s_date"), c("s_hour"), c("agent_skill").alias("agentskill"), c("company_id"),
            c("tenant_id")]


def hourly_call_summary(spark: SparkSession, cdr: DataFrame, from_ts, to_ts, skills: str,
                        tz: str = DEFAULT_TZ, b_unit: str | None = None, company: int = 1,
                        tenant: int = 1) -> DataFrame:
    """R1: inbound HTTAPI legs per local date, hour and skill, every hour present.

    Calls are taken from ``[from_ts, to_ts)``. An hour without calls is one
    row with NULL measures and NULL skill; a measure no call qualified for
    is NULL, not 0. Averages are whole seconds as ``HH:MM:SS``; percentages
    are integer ``count * 100 / queuedcount``. ``answersec_avg`` uses the
    requested tenant (the original hard-coded tenant 1 in one branch).
    """
    spine = hour_spine(spark, from_ts, to_ts, tz)
    agg = _inbound(cdr, from_ts, to_ts, skills, tz, b_unit, company, tenant, inclusive_end=False)
    joined = spine.join(agg, (spine.s_date == agg.c_date) & (spine.s_hour == agg.c_hour), "left")
    return (joined.select(*_formatted_inbound(), *_tail())
            .orderBy("s_date", "s_hour", "agentskill"))


def hourly_call_summary_w_hour(spark: SparkSession, cdr: DataFrame, from_ts, to_ts,
                               from_hour: int, to_hour: int, skills: str,
                               tz: str = DEFAULT_TZ, b_unit: str | None = None,
                               company: int = 1, tenant: int = 1) -> DataFrame:
    """R2: R1 within an hour-of-day band, plus outbound GATEWAY measures.

    Calls are taken from ``[from_ts, to_ts]`` (upper end inclusive) with
    local hour in ``[from_hour, to_hour]``; the spine is limited to the
    same band. Outbound measures have no skill key and repeat on every
    skill row of their hour; they hang off the inbound row, so an hour with
    outbound calls only shows NULL (as in the original).
    """
    spine = hour_spine(spark, from_ts, to_ts, tz, from_hour, to_hour)
    # one scan: both kinds of legs are aggregated by role, then the hour's outbound row is put beside
    # its inbound rows by a window over the aggregated rows
    inbound = (c("direction") == "inbound") & (c("obj_type") == "HTTAPI") & c("agent_skill").isin(ops.skill_list(skills))
    outbound = (c("direction") == "outbound") & (c("obj_type") == "GATEWAY")
    legs = ops.filter_calls(cdr, from_ts, to_ts, inclusive_end=True, company=company, tenant=tenant, b_unit=b_unit)
    legs = _with_local_hour(legs.filter(inbound | outbound), tz).filter(c("c_hour").between(from_hour, to_hour))
    hour = ["c_date", "c_hour", "company_id", "tenant_id"]
    agg = (legs.withColumn("agent_skill", F.when(inbound, c("agent_skill"))).withColumn("is_in", inbound)
           .groupBy(*hour, "is_in", "agent_skill").agg(*ops.inbound_measures(), *ops.outbound_measures()))
    same_hour = Window.partitionBy(*hour)
    known = c("company_id").isNotNull() & c("tenant_id").isNotNull()
    for name in OUTBOUND:
        agg = agg.withColumn(name, F.max(F.when(~c("is_in") & known, c(name))).over(same_hour))
    both = agg.filter("is_in")
    joined = spine.join(both, (spine.s_date == both.c_date) & (spine.s_hour == both.c_hour), "left")
    inb = _formatted_inbound()
    cols = [
        inb[0], c("outboundcallcount"), inb[1], inb[2], inb[3], inb[4], inb[5], inb[6],
        hms(c("holdsec_avg_outbound_s")).alias("holdsec_avg_outbound"),
        inb[7], inb[8], inb[9],
        hms(c("billsec_avg_outbound_s")).alias("billsec_avg_outbound"),
        inb[10], c("answered_count_outbound"), inb[11], inb[12], inb[13], inb[14],
    ]
    return joined.select(*cols, *_tail()).orderBy("s_date", "s_hour", "agentskill")
