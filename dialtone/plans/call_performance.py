"""R8: daily call performance per tenant, company and business unit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialtone.functions.fmt import int_div, round_avg_to_long
from dialtone.functions.timefx import DEFAULT_TZ, date_bounds, local_date
from dialtone.operators import cdr as ops
from dialtone.operators.index import ordered_index

c = F.col


def ratio_1dp(num: Column, den: Column) -> Column:
    """``round(num / den, 1)`` half away from zero, exact, for non-negative counts."""
    tenths = int_div(num.cast("bigint") * 20 + den, den.cast("bigint") * 2)
    return (tenths / F.lit(10.0)).cast("double")


def call_metrics(cdr: DataFrame, from_ts, to_ts, tz: str = DEFAULT_TZ) -> DataFrame:
    """Per local date x tenant x company x unit: call counts, talk, hold, agent counts."""
    inbound = c("direction") == "inbound"
    outbound = c("direction") == "outbound"
    in_ans = inbound & c("agent_answered")
    out_ans = outbound & c("is_answered")
    in_agent_leg = inbound & c("is_answered") & (c("obj_type") == "HTTAPI")
    out_agent_leg = outbound & c("is_answered") & (c("obj_type") != "PRIVATE_USER")
    legs = ops.within(cdr, "created_time", from_ts, to_ts, inclusive_end=True)
    # A leg counts for one agent at most, as it has one direction. Sums are taken by agent first, then over
    # the agents: every distinct agent is one row there, and a unit's busy day is spread over its agents.
    keys = ["date", "tenant", "company", "bu"]
    agent = F.when(in_agent_leg, c("received_by")).when(out_agent_leg, c("sip_from_user"))
    by_agent = legs.groupBy(
        local_date("created_time", tz).alias("date"), c("tenant_id").alias("tenant"), c("company_id").alias("company"),
        c("business_unit").alias("bu"), agent.alias("agent")).agg(
        ops.count_where(inbound).alias("total_inbound"),
        ops.count_where(outbound).alias("total_outbound"),
        ops.count_where(c("is_queued")).alias("total_queued"),
        ops.count_where(c("is_queued") & ~c("agent_answered")).alias("total_queue_dropped"),
        ops.count_where(in_ans).alias("total_queue_answered"),
        ops.count_where(out_ans).alias("total_outbound_answered"),
        F.sum(F.when(in_ans, c("bill_sec")).otherwise(0)).alias("talk_in"),
        F.sum(F.when(in_ans, c("bill_sec"))).alias("talk_in_sum"),
        F.count(F.when(in_ans, c("bill_sec"))).alias("talk_in_n"),
        F.sum(F.when(in_ans, c("hold_sec")).otherwise(0)).alias("hold_in"),
        F.sum(F.when(out_ans, c("bill_sec")).otherwise(0)).alias("talk_out"),
        F.sum(F.when(out_ans, c("bill_sec"))).alias("talk_out_sum"),
        F.count(F.when(out_ans, c("bill_sec"))).alias("talk_out_n"),
        F.sum(F.when(out_ans, c("hold_sec")).otherwise(0)).alias("hold_out"),
        ops.count_where(in_agent_leg).alias("in_answers"),
        ops.count_where(out_agent_leg).alias("out_answers"))
    measures = [x for x in by_agent.columns if x not in (*keys, "agent")]
    named = c("agent").isNotNull()
    return by_agent.groupBy(*keys).agg(
        *[F.sum(x).alias(x) for x in measures],
        F.count_if(named & (c("in_answers") > 0)).alias("in_agents"),
        F.count_if(named & (c("out_answers") > 0)).alias("out_agents"))


def staff_metrics(daily: DataFrame, from_ts, to_ts) -> DataFrame:
    """Per summary date x tenant x company x unit: LOGIN rows and LOGIN/AFTERWORK/BREAK time."""
    first, last = date_bounds(from_ts, to_ts)
    w = c("window_name")
    rows = daily.filter(c("summary_date").between(F.lit(first), F.lit(last)))
    agg = (rows.groupBy("summary_date", "tenant", "company", "business_unit")
           .agg(ops.count_where(w == "LOGIN").alias("staff_count"),
                F.sum(F.when(w == "LOGIN", c("total_time")).otherwise(0)).alias("staff_time"),
                F.sum(F.when(w == "AFTERWORK", c("total_time")).otherwise(0)).alias("acw_time"),
                F.sum(F.when(w == "BREAK", c("total_time")).otherwise(0)).alias("break_time")))
    # text keys become integers for the join (as the original casts at the join)
    return agg.select(c("summary_date").alias("date"), c("tenant").cast("int").alias("tenant"),
                      c("company").cast("int").alias("company"), c("business_unit").alias("bu"),
                      "staff_count", "staff_time", "acw_time", "break_time")


def call_performance(cdr: DataFrame, daily: DataFrame, from_ts, to_ts,
                     tz: str = DEFAULT_TZ) -> DataFrame:
    """R8: call metrics left-joined to staff metrics of the same day and unit.

    Calls are taken from ``[from_ts, to_ts]`` and bucketed by local date;
    summaries by ``summary_date`` within the same range. A NULL unit never
    matches a staff row. ``id`` numbers the rows in (date, tenant, company,
    unit) order, in which they are returned. Averages round half away from zero; calls per agent is
    NULL when no agent answered and has one decimal.
    """
    main = call_metrics(cdr, from_ts, to_ts, tz)
    # other windows add nothing to a row of this report
    staff = staff_metrics(daily.filter(c("window_name").isin("LOGIN", "AFTERWORK", "BREAK")), from_ts, to_ts)
    j = main.join(staff, on=["date", "tenant", "company", "bu"], how="left")
    z = lambda x: F.coalesce(c(x).cast("bigint"), F.lit(0))
    staff_n = z("staff_count")
    per_staff = lambda x: F.when(staff_n > 0, int_div(z(x), staff_n)).otherwise(F.lit(0))  # noqa
    out = j.select(
        "date", "tenant", "company", "bu",
        z("total_inbound").alias("total_inbound"), z("total_outbound").alias("total_outbound"),
        z("total_queued").alias("total_queued"),
        z("total_queue_dropped").alias("total_queue_dropped"),
        z("total_queue_answered").alias("total_queue_answered"),
        z("total_outbound_answered").alias("total_outbound_answered"),
        z("talk_in").alias("total_talktime_inbound"),
        F.coalesce(round_avg_to_long(c("talk_in_sum"), c("talk_in_n")), F.lit(0)).alias("avg_talktime_inbound"),
        z("hold_in").alias("holdtime_inbound"),
        z("talk_out").alias("total_talktime_outbound"),
        F.coalesce(round_avg_to_long(c("talk_out_sum"), c("talk_out_n")), F.lit(0)).alias("avg_talktime_outbound"),
        z("hold_out").alias("holdtime_outbound"),
        staff_n.alias("total_staff_count"),
        z("staff_time").alias("total_staff_time"),
        per_staff("staff_time").alias("average_staff_time"),
        z("acw_time").alias("total_acw_time"),
        per_staff("acw_time").alias("average_acw_time"),
        z("break_time").alias("total_break_time"),
        F.when(z("in_agents") != 0, ratio_1dp(z("in_answers"), c("in_agents"))).alias("average_inbound_call_per_agent"),
        F.when(z("out_agents") != 0, ratio_1dp(z("out_answers"), c("out_agents"))).alias("average_outbound_call_per_agent"),
        (z("staff_time") - (z("acw_time") + z("talk_in") + z("talk_out") + z("break_time")
                            + z("hold_in") + z("hold_out"))).alias("total_idle_time"),
    )
    return ordered_index(out, ["date", "tenant", "company", "bu"], "id")
