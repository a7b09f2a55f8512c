"""Agent productivity from daily summaries (R3, R4, R5).

The original joins ten to fifteen per-window subqueries of ``daily`` to
the LOGIN rows. Here ``daily`` is read once: one ``groupBy`` pivots all
windows into columns (``operators.daily.window_rollup``), the LOGIN rows
drive the report, first-login / last-logout times come from one
aggregate over ``status``, day totals from an aggregate and a join,
grand totals from one scalar subquery; all read the pivot's rows from one exchange.

Decisions on the original's defects (documented in README):
``total_hold_total_time`` is inbound + outbound hold (the original adds
inbound twice); ``full_avg_*_talk_time`` is the average of talk minus
hold (the original averaged ``x - x``); a zero count in a denominator
counts as 1 (the original raised division by zero); the logout of R5 is
matched on the logout row's unit; durations are ``HH:MM:SS`` text
without padding spaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialtone.functions.fmt import format_hms
from dialtone.functions.timefx import date_bounds
from dialtone.operators.daily import group_totals, mask_null_keys, window_rollup
from dialtone.operators.sessions import first_last_per_day, last_before
from dialtone.operators.shared import one_exchange
from dialtone.operators.totals import with_grand_totals
from dialtone.sources.snapshots import LastEvents

c = F.col

BASE_WINDOWS = ["login", "inbound", "outbound", "in_conn", "out_conn", "in_hold", "out_hold",
                "in_acw", "out_acw", "brk"]
ALL_WINDOWS = BASE_WINDOWS + ["dialed"]

AVG_DIGITS = 4  # numeric averages are compared at 4 decimals


# SQL expression text for the wide projections: one JVM call per column.
def z(name: str) -> str:
    """Window value, 0 when the window had no row."""
    return f"coalesce({name}, 0)"


def zb(name: str) -> str:
    return f"coalesce(cast({name} AS bigint), 0L)"


def per_call(total: str, count_col: str) -> str:
    """``total div coalesce(count, 1)``, a zero count also counting as 1."""
    return f"(({total}) div coalesce(nullif({count_col}, 0), 1))"


def avg_num(name: str) -> str:
    return f"round(coalesce(cast({name} AS double), 0D), {AVG_DIGITS})"


IDLE_IN = f"{zb('inbound_t')} - ({zb('in_acw_t')} + {zb('in_conn_t')})"
IDLE_OUT = f"{zb('outbound_t')} - ({zb('out_acw_t')} + {zb('out_conn_t')})"
IDLE_OFF = f"{zb('login_t')} - (({IDLE_IN}) + ({IDLE_OUT}))"
TALK_IN = f"{zb('in_conn_t')} - {zb('in_hold_t')}"
TALK_OUT = f"{zb('out_conn_t')} - {zb('out_hold_t')}"


def round_avg_sql(expr: str) -> str:
    """``round(avg(expr))`` half away from zero, exact in integer arithmetic."""
    total, n = f"sum({expr})", "count(1)"
    return (f"CASE WHEN {n} <> 0 THEN (CASE WHEN {total} < 0 THEN -1L ELSE 1L END) * "
            f"((abs({total}) * 2 + {n}) div ({n} * 2)) END")


def _grand_totals() -> dict[str, Column]:
    sums = {
        "g_login_t": zb("login_t"), "g_inbound_t": zb("inbound_t"),
        "g_outbound_t": zb("outbound_t"), "g_idle_in": IDLE_IN, "g_idle_out": IDLE_OUT,
        "g_idle_off": IDLE_OFF, "g_in_acw_t": zb("in_acw_t"), "g_out_acw_t": zb("out_acw_t"),
        "g_in_talk": TALK_IN, "g_out_talk": TALK_OUT, "g_in_hold_t": zb("in_hold_t"),
        "g_out_hold_t": zb("out_hold_t"), "g_in_hold_n": zb("in_hold_n"),
        "g_out_hold_n": zb("out_hold_n"), "g_brk_t": zb("brk_t"),
        "g_in_conn_n": zb("in_conn_n"), "g_out_conn_n": zb("out_conn_n"),
        "g_inbound_n": zb("inbound_n"), "g_outbound_n": zb("outbound_n"),
        "g_in_conn_t": zb("in_conn_t"), "g_out_conn_t": zb("out_conn_t"),
        "g_in_conn_n1": "coalesce(cast(in_conn_n AS bigint), 1L)",
        "g_out_conn_n1": "coalesce(cast(out_conn_n AS bigint), 1L)",
    }
    out = {k: F.expr(f"sum({v})") for k, v in sums.items()}
    for k, v in {"g_in_talk_avg": TALK_IN, "g_out_talk_avg": TALK_OUT,
                 "g_in_hold_avg": zb("in_hold_t"), "g_out_hold_avg": zb("out_hold_t")}.items():
        out[k] = F.expr(round_avg_sql(v))
    return out


class _Out:
    """Output columns in report order, split into per-row and grand-total columns."""

    def __init__(self) -> None:
        self.order: list[str] = []
        self.rows: list[str] = []          # SQL over the agent-day rows
        self.durations: list[str] = []     # per-row columns formatted as HH:MM:SS
        self.totals: list[tuple[str, str, bool]] = []  # (name, SQL over g_* sums, is duration)


def _columns(all_tenants: bool, bu: str | None) -> _Out:
    """Output columns as SQL expressions, durations in whole seconds.

    ``all_tenants`` selects the R4/R5 variants. Columns built from the
    grand totals (``g_*``) are evaluated once, inside the totals subquery.
    """
    out = _Out()

    def col(expr: str, name: str) -> None:
        out.order.append(name)
        out.rows.append(f"{expr} AS {name}")

    def secs(expr: str, name: str) -> None:
        out.order.append(name)
        out.durations.append(name)
        out.rows.append(f"cast({expr} AS bigint) AS {name}")

    def total(expr: str, name: str) -> None:
        out.order.append(name)
        out.totals.append((name, expr, False))

    def total_secs(expr: str, name: str) -> None:
        out.order.append(name)
        out.totals.append((name, expr, True))

    col("summary_date", "summary_date")
    col("cast(tenant AS int)", "tenant")
    col("cast(company AS int)", "company")
    if bu is not None:
        col(bu, "bu")
    col("cast(param1 AS int)", "agent")
    col(z("login_m"), "login_max_time")
    col(zb("login_n"), "login_total_count")
    secs(zb("login_t"), "login_total_time")
    col("login_time", "login_time")
    for w, name in (("inbound", "inbound"), ("outbound", "outbound")):
        col(z(f"{w}_m"), f"{name}_max_time")
        col(zb(f"{w}_n"), f"{name}_total_count")
        secs(zb(f"{w}_t"), f"{name}_total_time")
    col(f"{zb('inbound_n')} + {zb('outbound_n')}", "total_call_count")
    col(f"{zb('inbound_t')} + {zb('outbound_t')}", "total_call_time")
    col(avg_num("inbound_avg_n"), "avg_inbound_call_count")
    col(avg_num("outbound_avg_n"), "avg_outbound_call_count")
    col(avg_num("inbound_avg_t"), "avg_inbound_call_time")
    col(avg_num("outbound_avg_t"), "avg_outbound_call_time")
    for d, talk in (("in", TALK_IN), ("out", TALK_OUT)):
        name = "inbound" if d == "in" else "outbound"
        col(f"{z(d + '_conn_m')} - {z(d + '_hold_m')}", f"{name}_talk_max_time")
        col(zb(f"{d}_conn_n"), f"{name}_connected_total_count")
        secs(talk, f"{name}_talk_total_time")
    col(f"{zb('in_conn_n')} + {zb('out_conn_n')}", "connected_total_count")
    col(f"({TALK_IN}) + ({TALK_OUT})", "total_talk_total_time")
    for d, talk in (("in", TALK_IN), ("out", TALK_OUT)):
        name = "inbound" if d == "in" else "outbound"
        secs(per_call(talk if all_tenants else zb(f"{d}_conn_t"), f"{d}_conn_n"),
             f"avg_{name}_talk_time")
    for d in ("in", "out"):
        name = "inbound" if d == "in" else "outbound"
        secs(per_call(f"{zb(d + '_conn_t')} + {zb(d + '_acw_t')}", f"{d}_conn_n"),
             f"avg_{name}_handling_time")
    for d in ("in", "out"):
        name = "inbound" if d == "in" else "outbound"
        col(z(f"{d}_hold_m"), f"{name}_hold_max_time")
        col(zb(f"{d}_hold_n"), f"{name}_hold_total_count")
        secs(zb(f"{d}_hold_t"), f"{name}_hold_total_time")
    col(f"{zb('in_hold_n')} + {zb('out_hold_n')}", "total_hold_total_count")
    col(f"{zb('in_hold_t')} + {zb('out_hold_t')}", "total_hold_total_time")
    col(avg_num("in_hold_avg_n"), "avg_inbound_hold_count")
    col(avg_num("out_hold_avg_n"), "avg_outbound_hold_count")
    secs("coalesce(floor(in_hold_avg_t), 0L)", "avg_inbound_hold_time")
    secs("coalesce(floor(out_hold_avg_t), 0L)", "avg_outbound_hold_time")
    for d in ("in", "out"):
        name = "inbound" if d == "in" else "outbound"
        col(z(f"{d}_acw_m"), f"{name}_acw_max_time")
        col(zb(f"{d}_acw_n"), f"{name}_acw_total_count")
        secs(zb(f"{d}_acw_t"), f"{name}_acw_total_time")
    col(f"{zb('in_acw_n')} + {zb('out_acw_n')}", "total_acw_total_count")
    col(f"{zb('in_acw_t')} + {zb('out_acw_t')}", "total_acw_total_time")
    col(avg_num("in_acw_avg_n"), "avg_inbound_acw_count")
    col(avg_num("out_acw_avg_n"), "avg_outbound_acw_count")
    col(avg_num("in_acw_avg_t"), "avg_inbound_acw_time")
    col(avg_num("out_acw_avg_t"), "avg_outbound_acw_time")
    secs(IDLE_IN, "idle_time_inbound")
    secs(f"({IDLE_OUT}) - {zb('dialed_t')}" if all_tenants else IDLE_OUT, "idle_time_outbound")
    secs(f"{zb('login_t')} - ({zb('inbound_t')} + {zb('outbound_t')})" if all_tenants
         else IDLE_OFF, "idle_time_offline")
    secs(zb("brk_t"), "total_break_time")
    for g, name in (("g_login_t", "login"), ("g_inbound_t", "inbound"),
                    ("g_outbound_t", "outbound"), ("g_idle_in", "inbound_idle"),
                    ("g_idle_out", "outbound_idle"), ("g_idle_off", "offline_idle"),
                    ("g_in_acw_t", "inbound_acw"), ("g_out_acw_t", "outbound_acw"),
                    ("g_in_talk", "inbound_talk"), ("g_out_talk", "outbound_talk"),
                    ("g_in_hold_t", "inbound_hold"), ("g_out_hold_t", "outbound_hold")):
        total_secs(g, f"full_total_{name}_time")
    total("g_in_hold_n", "full_total_inbound_hold_count")
    total("g_out_hold_n", "full_total_outbound_hold_count")
    total_secs("g_brk_t", "full_total_break_time")
    if all_tenants:
        col("coalesce(cast(day_in_conn_n AS bigint), 0L)", "full_total_connected_inbound_calls")
        col("coalesce(cast(day_out_conn_n AS bigint), 0L)", "full_total_connected_outbound_calls")
    else:
        total("g_in_conn_n", "full_total_connected_inbound_calls")
        total("g_out_conn_n", "full_total_connected_outbound_calls")
    total("g_inbound_n", "full_total_inbound_calls")
    total("g_outbound_n", "full_total_outbound_calls")
    total_secs("(g_in_conn_t + g_in_acw_t) div coalesce(nullif(g_in_conn_n1, 0), 1)",
               "full_avg_inbound_handling_time")
    total_secs("(g_out_conn_t + g_out_acw_t) div coalesce(nullif(g_out_conn_n1, 0), 1)",
               "full_avg_outbound_handling_time")
    total_secs("g_in_talk_avg", "full_avg_inbound_talk_time")
    total_secs("g_out_talk_avg", "full_avg_outbound_talk_time")
    total_secs("g_in_hold_avg", "full_avg_inbound_hold_time")
    total_secs("g_out_hold_avg", "full_avg_outbound_hold_time")
    if all_tenants:
        secs(zb("dialed_t"), "outbound_dialed_total_time")
        secs(per_call(zb("dialed_t"), "dialed_n"), "avg_outbound_dialed_time")
        col(zb("dialed_n"), "outbound_dialed_total_count")
        col("logout_time", "logout_time")
    return out


def _finish(rows: DataFrame, totalled: DataFrame, all_tenants: bool, bu: str | None) -> DataFrame:
    """Project and format the per-row columns, order, attach formatted grand totals of ``totalled``.

    Per-row durations are formatted before the sort, in the parallel stage
    that produced the rows; the grand totals are computed and formatted
    once in the totals subquery. Projections after the sort keep its order.
    """
    out = _columns(all_tenants, bu)
    per_row = format_hms(rows.selectExpr(*out.rows), out.durations)
    ordered = per_row.orderBy("summary_date", "tenant", "company", "agent")
    totals = [F.expr(f"cast({e} AS bigint) AS {n}" if is_secs else f"{e} AS {n}")
              for n, e, is_secs in out.totals]
    done = with_grand_totals(ordered, _grand_totals(), outputs=totals, source=totalled,
                             durations=[n for n, _, is_secs in out.totals if is_secs])
    return done.select(*out.order)


def _default_logout(day: Column) -> Column:
    """``<day> 18:29:59 UTC`` (23:59:59 in UTC+05:30), the original's fallback logout."""
    return F.make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day),
                                F.lit(18), F.lit(29), F.lit(59))


def agent_productivity(daily: DataFrame, status: DataFrame, from_ts, to_ts,
                       resource_id: str | None = None, tz: str | None = None,
                       b_unit: str | None = None, company: int = 1,
                       tenant: int = 1, logins: LastEvents | None = None) -> DataFrame:
    """R3: per summary date and agent of one company and tenant, 85 columns.

    ``resource_id`` limits to one agent, ``b_unit`` (unless NULL or
    ``'ALL'``) to one business unit. ``login_time`` is the agent's first
    Register of that UTC day, else the latest Register before ``from_ts``
    (in the unit, when one is given). ``full_*`` columns are totals over
    all output rows. ``logins`` are stored boundaries of earlier logins, without
    which all older status rows are read. ``tz`` is accepted for signature compatibility; the
    summaries are already per day.
    """
    first, last = date_bounds(from_ts, to_ts)
    cond = (c("summary_date").between(F.lit(first), F.lit(last))
            & (c("company") == str(company)) & (c("tenant") == str(tenant)))
    if resource_id is not None:
        cond &= c("param1") == str(resource_id)
    unit_filter = b_unit is not None and b_unit != "ALL"
    if unit_filter:
        cond &= c("business_unit") == b_unit
    keys = ["summary_date", "tenant", "company", "param1"]
    agg = _shared(window_rollup(daily.filter(cond), keys, BASE_WINDOWS, weighted_avg_time=False), unit=False)
    rows = mask_null_keys(agg, keys, BASE_WINDOWS).filter(c("_driver_rows") > 0)

    scope = (c("company_id") == company) & (c("tenant_id") == tenant)
    same_day = first_last_per_day(status, ["tenant_id", "company_id", "resource_id"], first, last,
                                  extra=scope)
    fb_scope = scope & (c("business_unit") == b_unit) if unit_filter else scope
    fallback = earlier_logins(status, from_ts, logins, fb_scope)
    return _finish(attach_login(rows, same_day, fallback, unit=False), rows, False, None)


def earlier_logins(status: DataFrame, from_ts, logins: LastEvents | None, extra: Column | None = None) -> DataFrame:
    """(resource_id, fallback_at): each agent's latest Register before the report's range."""
    if logins is None:
        return last_before(status, "Register", from_ts, extra=extra, name="fallback_at")
    return logins.last_before(status, from_ts, extra=extra, name="fallback_at")


def _shared(agg: DataFrame, unit: bool) -> DataFrame:
    """Agent-day rows that report, day totals and grand totals read from one exchange, dealt for the login join."""
    numbered = agg.select("*", *[F.expr(f"cast({x} AS int)").alias(f"_{x}") for x in ("tenant", "company", "param1")])
    return one_exchange(numbered, ["summary_date", "_tenant", "_company", "_param1"] + (["business_unit"] if unit else []))


def attach_login(rows: DataFrame, same_day: DataFrame, fallback: DataFrame,
                  unit: bool) -> DataFrame:
    """Left-join first login / last logout of the day, then the earlier-login fallback.

    The report's text keys are integers in the join, as in the original:
    ``_tenant``, ``_company``, ``_param1``. Both lookups are aggregates keyed like the rows (one
    row per agent-day, one per agent), so neither join multiplies rows.
    """
    sd = same_day.select(*[c(x).alias("sd_" + x) for x in same_day.columns])
    on = [c("summary_date") == c("sd_day"), c("_tenant") == c("sd_tenant_id"),
          c("_company") == c("sd_company_id"), c("_param1") == c("sd_resource_id")]
    if unit:
        on.append(c("business_unit") == c("sd_business_unit"))
    on_all = on[0]
    for cond in on[1:]:
        on_all = on_all & cond
    j = rows.join(sd, on_all, "left")
    fb = fallback.select(c("resource_id").alias("fb_resource_id"), "fallback_at")
    j = j.join(fb, c("_param1") == c("fb_resource_id"), "left")
    return j.select(*[c(x) for x in rows.columns],
                    F.coalesce(c("sd_first_at"), c("fallback_at")).alias("login_time"),
                    F.coalesce(c("sd_last_at"), _default_logout(c("summary_date"))).alias("logout_time"))


def _agent_productivity_all(daily: DataFrame, status: DataFrame, from_ts, to_ts,
                            by_unit: bool, logins: LastEvents | None) -> DataFrame:
    first, last = date_bounds(from_ts, to_ts)
    keys = ["summary_date", "tenant", "company"] + (["business_unit"] if by_unit else []) + ["param1"]
    day_keys = keys[:-1]
    agg = _shared(window_rollup(daily.filter(c("summary_date").between(F.lit(first), F.lit(last))),
                                keys, ALL_WINDOWS, weighted_avg_time=True), by_unit)
    # day totals of connected calls count every agent row of the day, NULL agent included
    agg = group_totals(agg, day_keys, {"day_in_conn_n": c("in_conn_n"),
                                       "day_out_conn_n": c("out_conn_n")})
    rows = mask_null_keys(agg, keys, ALL_WINDOWS).filter(c("_driver_rows") > 0)
    status_keys = ["tenant_id", "company_id"] + (["business_unit"] if by_unit else []) + ["resource_id"]
    same_day = first_last_per_day(status, status_keys, first, last)
    fallback = earlier_logins(status, from_ts, logins)
    return _finish(attach_login(rows, same_day, fallback, unit=by_unit), rows, True,
                   "business_unit" if by_unit else "'ALL'")


def agent_productivity_all(daily: DataFrame, status: DataFrame, from_ts, to_ts,
                           logins: LastEvents | None = None) -> DataFrame:
    """R4: R3 for every tenant and company (``bu = 'ALL'``) plus dialed calls and logout.

    Window time averages are weighted (``sum(time) div sum(count)``); idle
    outbound also deducts dialed time; idle offline is login minus
    inbound and outbound time; ``full_total_connected_*_calls`` are the
    day's totals for the tenant and company; ``logout_time`` is the last
    UnRegister of the UTC day, else 18:29:59 UTC of the summary date.
    """
    return _agent_productivity_all(daily, status, from_ts, to_ts, by_unit=False, logins=logins)


def agent_productivity_bu(daily: DataFrame, status: DataFrame, from_ts, to_ts,
                          logins: LastEvents | None = None) -> DataFrame:
    """R5: R4 with the business unit as part of every key (first login/logout per unit)."""
    return _agent_productivity_all(daily, status, from_ts, to_ts, by_unit=True, logins=logins)


__all__ = ["agent_productivity", "agent_productivity_all", "agent_productivity_bu"]
