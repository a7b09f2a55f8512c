"""Agent productivity from raw events and call legs (R6 all units, R7 per unit).

Driver rows are agent-days with any state-change event in the range
(UTC day). Call measures come from legs resolved to agents by name
(local day, joined on the UTC day as in the original), session totals
from a skew-safe ``lead`` over state changes, after-call work from the
work rows joined to legs, breaks per UTC day. Session, work and span
totals cover the whole range per agent and repeat on each of the
agent's days, as in the original; they are summed per agent, so an agent
in several units does not multiply rows. Durations are ``HH:MM:SS``
(fractions of a second cut toward zero, hours not wrapped at 24).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialtone.functions.fmt import format_hms
from dialtone.functions.timefx import DEFAULT_TZ, utc_date
from dialtone.operators import cdr as cdr_ops
from dialtone.operators.sessions import BUCKET, span_totals
from dialtone.plans.agent_daily import earlier_logins
from dialtone.sources.snapshots import LastEvents

c = F.col


def _z(name: str) -> str:
    return f"coalesce(cast({name} AS bigint), 0L)"


def _secs_of_us(expr: str) -> str:
    """microseconds -> whole seconds toward zero (what HH24:MI:SS shows)."""
    return f"(({expr}) div 1000000L)"


def _guarded_avg(cond_count: str, extra_cond: str | None, total: str) -> str:
    """``CASE WHEN coalesce(n, 1) > 0 [AND extra] THEN total div coalesce(n, 1) ELSE 0``."""
    cond = f"coalesce({cond_count}, 1L) > 0" + (f" AND {extra_cond}" if extra_cond else "")
    return f"CASE WHEN {cond} THEN ({total}) div coalesce({cond_count}, 1L) ELSE 0L END"


def _columns(by_unit: bool) -> tuple[list[str], list[str]]:
    cols: list[str] = []
    durations: list[str] = []

    def col(expr, name):
        cols.append(f"{expr} AS {name}")

    def secs(expr, name):
        durations.append(name)
        cols.append(f"cast({expr} AS bigint) AS {name}")

    in_t, in_n, in_h = _z("in_conn_t"), _z("in_conn_n"), _z("in_hold_t")
    out_t, out_n, out_h = _z("out_conn_t"), _z("out_conn_n"), _z("out_hold_t")
    acw_in, acw_out = _z("acw_in"), _z("acw_out")
    ti, to, td = _z("inbound_us"), _z("outbound_us"), _z("login_us")
    col("day", "summary_date")
    col("tenant_id", "tenant")
    col("company_id", "company")
    col("business_unit" if by_unit else "'ALL'", "bu")
    col("resource_id", "agent")
    col("coalesce(first_at, fallback_at)", "login_time")
    secs(_secs_of_us(td), "login_total_time")
    col(in_n, "inbound_connected_total_count")
    col(out_n, "outbound_connected_total_count")
    col(f"{in_n} + {out_n}", "connected_total_count")
    col(_z("out_dial_n"), "outbound_dialed_total_count")
    secs(_z("out_dial_t"), "outbound_dialed_total_time")
    secs(_guarded_avg("out_dial_n", None, _z("out_dial_t")), "avg_outbound_dialed_time")
    secs(f"{in_t} - {in_h}", "inbound_talk_total_time")
    secs(_guarded_avg("in_conn_n", f"{in_t} >= {in_h}", f"{in_t} - {in_h}"), "avg_inbound_talk_time")
    secs(in_h, "inbound_hold_total_time")
    secs(_guarded_avg("in_hold_n", None, in_h), "avg_inbound_hold_time")
    secs(f"{out_t} - {out_h}", "outbound_talk_total_time")
    secs(_guarded_avg("out_conn_n", f"{out_t} >= {out_h}", f"{out_t} - {out_h}"),
         "avg_outbound_talk_time")
    secs(out_h, "outbound_hold_total_time")
    secs(_guarded_avg("out_hold_n", None, out_h), "avg_outbound_hold_time")
    secs(acw_in, "inbound_acw_total_time")
    secs(acw_out, "outbound_acw_total_time")
    secs(_guarded_avg("in_conn_n", None, f"{in_t} + {acw_in}"), "avg_inbound_handling_time")
    secs(_guarded_avg("out_conn_n", None, f"{out_t} + {acw_out}"), "avg_outbound_handling_time")
    secs(_z("break_secs"), "total_break_time")
    secs(_secs_of_us(ti), "inbound_total_time")
    col(_z("in_total"), "inbound_total_count")
    secs(_secs_of_us(to), "outbound_total_time")
    col(_z("out_total"), "outbound_total_count")
    secs(_secs_of_us(f"{ti} - ({acw_in} + {in_t}) * 1000000L"), "idle_time_inbound")
    secs(_secs_of_us(f"{to} - ({acw_out} + {out_t}) * 1000000L"), "idle_time_outbound")
    secs(_secs_of_us(f"{td} - ({ti} + {to}) + ({acw_in} + {in_t}) * 1000000L"
                     f" + ({acw_out} + {out_t}) * 1000000L"), "idle_time_offline")
    col("coalesce(last_at, make_timestamp_ntz(year(day), month(day), day(day), 18, 29, 59))",
        "logout_time")
    return cols, durations


def _agent_events(status: DataFrame, cdr: DataFrame, resources: DataFrame, acw: DataFrame,
                  breaks: DataFrame, from_ts, to_ts, tz: str, by_unit: bool,
                  bucket: str, legs_by_uuid: DataFrame | None, logins: LastEvents | None) -> DataFrame:
    keys = ["day", "tenant_id", "company_id"] + (["business_unit"] if by_unit else [])
    main = (cdr_ops.within(status, "created_at", from_ts, to_ts, inclusive_end=True)
            .groupBy(utc_date("created_at").alias("day"), *keys[1:], "resource_id")
            .agg(F.min(F.when(c("reason") == "Register", c("created_at"))).alias("first_at"),
                 F.max(F.when(c("reason") == "UnRegister", c("created_at"))).alias("last_at")))
    legs = cdr_ops.legs_per_agent(cdr, resources, from_ts, to_ts, tz, by_unit)
    work = cdr_ops.acw_by_direction(acw, cdr if legs_by_uuid is None else legs_by_uuid, from_ts, to_ts)
    brk = (cdr_ops.within(breaks, "created_at", from_ts, to_ts, inclusive_end=True)
           .filter((c("status_type") == "ResourceStatus") & (c("status") == "NotAvailable"))
           .groupBy("resource_id", utc_date("created_at").alias("day"))
           .agg(F.sum("duration").alias("break_secs")))
    spans = span_totals(status, from_ts, to_ts, bucket)
    fallback = earlier_logins(status, from_ts, logins)
    j = (main.join(legs, on=keys + ["resource_id"], how="left")
         .join(work, on="resource_id", how="left")
         .join(brk, on=["resource_id", "day"], how="left")
         .join(spans, on="resource_id", how="left")
         .join(fallback, on="resource_id", how="left"))
    cols, durations = _columns(by_unit)
    out = format_hms(j.selectExpr(*cols), durations)
    return out.orderBy("summary_date", "tenant", "company", "bu", "agent")


def agent_events_all(status, cdr, resources, acw, breaks, from_ts, to_ts,
                     tz: str = DEFAULT_TZ, bucket: str = BUCKET, legs_by_uuid: DataFrame | None = None,
                     logins: LastEvents | None = None) -> DataFrame:
    """R6: per UTC day, tenant, company and agent (``bu = 'ALL'``), 34 columns.

    After-call work meets legs of all time: ``legs_by_uuid``, the legs bucketed by
    uuid (``sources.facts``), saves their shuffle. ``logins``, stored boundaries
    of earlier logins, save reading the status rows before them.
    """
    return _agent_events(status, cdr, resources, acw, breaks, from_ts, to_ts, tz, False, bucket, legs_by_uuid, logins)


def agent_events_bu(status, cdr, resources, acw, breaks, from_ts, to_ts,
                    tz: str = DEFAULT_TZ, bucket: str = BUCKET, legs_by_uuid: DataFrame | None = None,
                    logins: LastEvents | None = None) -> DataFrame:
    """R7: R6 with the business unit in the day key and the call-leg key."""
    return _agent_events(status, cdr, resources, acw, breaks, from_ts, to_ts, tz, True, bucket, legs_by_uuid, logins)
