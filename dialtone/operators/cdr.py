"""Filters and conditional measures over call legs (``cdr``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialtone.functions.fmt import int_div
from dialtone.functions.timefx import date_bounds, ts_literal

c = F.col


def skill_list(skills: str) -> list[str]:
    """Comma-separated skill list; items are not trimmed (``'a, b'`` has ``' b'``)."""
    return skills.split(",")


def in_range(ts_col: str, from_ts, to_ts, inclusive_end: bool) -> Column:
    lo, hi = ts_literal(from_ts), ts_literal(to_ts)
    upper = c(ts_col) <= hi if inclusive_end else c(ts_col) < hi
    return (c(ts_col) >= lo) & upper


def day_column(ts_col: str) -> str:
    """The partition column of a fact table stored by the UTC day of ``ts_col`` (``sources.facts``)."""
    return f"{ts_col}_day"


def within(df: DataFrame, ts_col: str, from_ts, to_ts, inclusive_end: bool) -> DataFrame:
    """The rows of a time range; of a table stored by day only the days of the range are read."""
    if day_column(ts_col) in df.columns:
        first, last = date_bounds(from_ts, to_ts)
        df = df.filter(c(day_column(ts_col)).between(F.lit(first), F.lit(last)))
    return df.filter(in_range(ts_col, from_ts, to_ts, inclusive_end))


def filter_calls(cdr: DataFrame, from_ts, to_ts, *, inclusive_end: bool,
                 company: int | None = None, tenant: int | None = None,
                 b_unit: str | None = None, direction: str | None = None,
                 obj_type: str | None = None, skills: str | None = None) -> DataFrame:
    """Range + equality + skill-membership filters; all reach the parquet scan."""
    cond = F.lit(True)
    if company is not None:
        cond &= c("company_id") == company
    if tenant is not None:
        cond &= c("tenant_id") == tenant
    if b_unit is not None:
        cond &= c("business_unit") == b_unit
    if direction is not None:
        cond &= c("direction") == direction
    if obj_type is not None:
        cond &= c("obj_type") == obj_type
    if skills is not None:
        cond &= c("agent_skill").isin(skill_list(skills))
    return within(cdr, "created_time", from_ts, to_ts, inclusive_end).filter(cond)


# --- inbound leg predicates (three-valued: a NULL flag never matches) -------
def abandoned() -> Column:
    """Queued, not answered by an agent, waited more than 5 s."""
    return c("is_queued") & ~c("agent_answered") & (c("queue_sec") > 5)


def dropped() -> Column:
    """Queued, not answered by an agent, hung up within 5 s."""
    return c("is_queued") & ~c("agent_answered") & (c("queue_sec") <= 5)


def count_where(cond: Column) -> Column:
    """``count(*) FILTER (WHERE cond)``."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def nonzero_count(cond: Column) -> Column:
    """Count that is NULL (not 0) when nothing matched, as a missing joined row would be."""
    return F.nullif(count_where(cond), F.lit(0))


def trunc_avg(value: Column, cond: Column | None = None) -> Column:
    """Average of ``value`` over rows matching ``cond``, truncated to whole seconds.

    Computed exactly as ``sum div count``; NULL when no row matched.
    """
    v = value if cond is None else F.when(cond, value)
    return int_div(F.sum(v), F.count(v))


def inbound_measures() -> list[Column]:
    """Per-group measures of the hourly inbound report, one pass over the legs."""
    answered = c("agent_answered")
    return [
        F.count(F.lit(1)).alias("ivrcount"),
        nonzero_count(c("is_queued")).alias("queuedcount"),
        nonzero_count(abandoned()).alias("abandonedcount"),
        nonzero_count(dropped()).alias("droppedcount"),
        nonzero_count(answered).alias("answered_count"),
        trunc_avg(c("hold_sec"), answered & (c("hold_sec") > 0)).alias("holdsec_avg_s"),
        trunc_avg(c("ivr_connect_sec")).alias("ivrconnect_avg_s"),
        trunc_avg(c("answer_sec"), answered).alias("answersec_avg_s"),
        trunc_avg(c("bill_sec"), answered).alias("billsec_avg_s"),
        trunc_avg(c("queue_sec"), c("is_queued")).alias("queuesec_avg_s"),
        trunc_avg(c("queue_sec"), abandoned()).alias("abandonedqueue_avg_s"),
        trunc_avg(c("queue_sec"), answered).alias("answeredqueue_avg_s"),
    ]


def outbound_measures() -> list[Column]:
    """Per-hour outbound (GATEWAY) measures; these have no skill key."""
    answered = c("is_answered")
    return [
        F.count(F.lit(1)).alias("outboundcallcount"),
        trunc_avg(c("hold_sec"), answered & (c("hold_sec") > 0)).alias("holdsec_avg_outbound_s"),
        trunc_avg(c("bill_sec"), answered).alias("billsec_avg_outbound_s"),
        nonzero_count(answered).alias("answered_count_outbound"),
    ]


def legs_per_agent(cdr: DataFrame, resources: DataFrame, from_ts, to_ts, tz: str,
                   by_unit: bool) -> DataFrame:
    """Per local date, tenant, company, (unit,) and agent: inbound and outbound leg measures.

    An inbound leg belongs to the agent named in ``received_by``, an
    outbound leg to the one in ``sip_from_user``; names resolve to agents
    through ``resources`` (inner join). Each leg is emitted once per role,
    pre-aggregated per agent *name* (map-side combine, one shuffle), and
    only then joined to the agent table: the join sees one row per
    name-day instead of one per leg. Sums are additive, so the result
    equals aggregating after the join.
    """
    from dialtone.functions.timefx import local_date

    keys = ["day", "tenant_id", "company_id"] + (["business_unit"] if by_unit else [])
    legs = within(cdr, "created_time", from_ts, to_ts, inclusive_end=True)
    one = lambda cond: f"if(coalesce({cond}, false), 1, 0)"
    val = lambda cond, v: f"if({cond}, {v}, 0)"
    inb, outb = "direction = 'inbound'", "direction = 'outbound'"
    in_ans, out_ans = f"({inb} AND agent_answered)", f"({outb} AND is_answered)"
    out_dial = f"({outb} AND NOT is_answered)"
    roles = (
        "inline(array("
        f"named_struct('role', 'in', 'agent_name', received_by, 'n_total', {one(inb)}, "
        f"'n_conn', {one(in_ans)}, 't_conn', {val(in_ans, 'bill_sec')}, "
        f"'t_hold', {val(in_ans, 'hold_sec')}, 'n_hold', {one(in_ans + ' AND hold_sec > 0')}, "
        "'n_dial', 0, 't_dial', 0), "
        f"named_struct('role', 'out', 'agent_name', sip_from_user, 'n_total', {one(outb)}, "
        f"'n_conn', {one(out_ans)}, 't_conn', {val(out_ans, 'bill_sec')}, "
        f"'t_hold', {val(out_ans, 'hold_sec')}, 'n_hold', {one(out_ans + ' AND hold_sec > 0')}, "
        f"'n_dial', {one(out_dial)}, "
        f"'t_dial', {val(out_dial + " AND obj_type != 'PRIVATE_USER'", 'ivr_connect_sec')})))")
    measures = ("n_total", "n_conn", "t_conn", "t_hold", "n_hold", "n_dial", "t_dial")
    local_day = local_date("created_time", tz).alias("day")
    per_name = (legs.select(local_day, *keys[1:], "received_by", "sip_from_user", "direction",
                            "agent_answered", "is_answered", "hold_sec", "bill_sec", "obj_type",
                            "ivr_connect_sec")
                .selectExpr(*keys, roles)
                .groupBy(*keys, "role", "agent_name")
                .agg(*[F.expr(f"sum({x}) AS {x}") for x in measures]))
    agents = resources.select(c("resource_name").alias("agent_name"), "resource_id")
    joined = per_name.join(agents, on="agent_name", how="inner")
    out = {"in": [("n_total", "in_total"), ("n_conn", "in_conn_n"), ("t_conn", "in_conn_t"),
                  ("t_hold", "in_hold_t"), ("n_hold", "in_hold_n")],
           "out": [("n_total", "out_total"), ("n_conn", "out_conn_n"), ("n_dial", "out_dial_n"),
                   ("t_conn", "out_conn_t"), ("t_hold", "out_hold_t"), ("n_hold", "out_hold_n"),
                   ("t_dial", "out_dial_t")]}
    return joined.groupBy(*keys, "resource_id").agg(*[
        F.expr(f"sum(if(role = '{r}', {x}, NULL)) AS {name}")
        for r, pairs in out.items() for x, name in pairs])


def acw_by_direction(acw: DataFrame, cdr: DataFrame, from_ts, to_ts) -> DataFrame:
    """Per agent: after-call-work seconds of inbound and of outbound calls.

    Work rows created in ``[from_ts, to_ts]`` join call legs on
    ``session_id = uuid`` (legs of any time). A uuid with several legs
    counts its work once per leg, as the original's inner join does. Both
    sides are reduced before they meet: work to one row per agent and
    session, legs to one row per uuid, each combined before its shuffle.
    Legs have no time bound here, so tables bucketed by uuid save the most;
    without them Spark can add a runtime filter from the work side.
    """
    work = (within(acw, "created_at", from_ts, to_ts, inclusive_end=True)
            .groupBy("resource_id", c("session_id").alias("uuid")).agg(F.sum("duration").alias("worked")))
    per_uuid = cdr.groupBy("uuid").agg(count_where(c("direction") == "inbound").alias("n_in"),
                                       count_where(c("direction") == "outbound").alias("n_out"))
    return (work.join(per_uuid, "uuid").groupBy("resource_id")
            .agg(F.sum(c("worked") * c("n_in")).alias("acw_in"),
                 F.sum(c("worked") * c("n_out")).alias("acw_out")))
