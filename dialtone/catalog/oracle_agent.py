"""Oracle SQL for the agent productivity reports from daily summaries (R3-R5), from their definition.

The summaries are unpivoted to (window, statistic) values of an agent-day with
FILTER aggregates; the report is a projection of that one relation, its grand
totals a second aggregate of it.
"""

from __future__ import annotations

from dialtone.catalog import sqlfx as q

# Written out here on purpose, not imported: which summary rows make up each window.
_WINDOWS = {
    "li": "window_name = 'LOGIN'",
    "ib": "window_name = 'INBOUND'",
    "ob": "window_name = 'OUTBOUND'",
    "ci": "(window_name, param2) = ('CONNECTED', 'CALLinbound')",
    "co": "(window_name, param2) = ('CONNECTED', 'CALLoutbound')",
    "hi": "(window_name, param2) = ('AGENTHOLD', 'inbound')",
    "ho": "(window_name, param2) = ('AGENTHOLD', 'outbound')",
    "ai": "(window_name, param2) = ('AFTERWORK', 'AfterWorkCALLinbound')",
    "ao": "(window_name, param2) = ('AFTERWORK', 'AfterWorkCALLoutbound')",
    "br": "window_name = 'BREAK'",
    "di": "(window_name, param2) = ('DIALED', 'DialedOutbound')",
}


def _statistics(all_tenants: bool, whole_key: str) -> str:
    """max, count, time, mean count and mean time of every window, NULL where a key is."""
    out = []
    for w, rows in _WINDOWS.items():
        f = f"FILTER (WHERE {rows})"
        mean = (f"CAST(sum(total_time) {f} // coalesce(nullif(sum(total_count) {f}, 0), 1) AS DOUBLE)"
                if all_tenants else f"avg(total_time) {f}")
        for name, e in (("m", f"max(max_time) {f}"), ("n", f"sum(total_count) {f}"), ("t", f"sum(total_time) {f}"),
                        ("an", f"avg(total_count) {f}"), ("at", mean)):
            out.append(f"{e} AS {w}_{name}" if w == "li" else f"CASE WHEN {whole_key} THEN {e} END AS {w}_{name}")
    return ",\n    ".join(out)


def _columns(all_tenants: bool, unit: bool) -> dict[str, str]:
    n = lambda w: f"coalesce({w}_n, 0)"
    t = lambda w: f"coalesce({w}_t, 0)"
    m = lambda w: f"coalesce({w}_m, 0)"
    whole = lambda e: f"CAST({e} AS BIGINT)"
    mean = lambda e: f"round(CAST(coalesce({e}, 0) AS DOUBLE), 4)"
    each = lambda e, w: q.hms(f"(({e}) // coalesce(nullif({w}_n, 0), 1))")
    out = {"summary_date": "agent_day.summary_date", "tenant": "CAST(agent_day.tenant AS INTEGER)", "company": "CAST(agent_day.company AS INTEGER)",
           "agent": "CAST(param1 AS INTEGER)", "login_time": "coalesce(first_in, earlier_in)"}
    if all_tenants:
        out["bu"] = "agent_day.business_unit" if unit else "'ALL'"
        out["logout_time"] = "coalesce(last_out, agent_day.summary_date + INTERVAL '18 hours 29 minutes 59 seconds')"
        out["outbound_dialed_total_time"] = q.hms(t("di"))
        out["avg_outbound_dialed_time"] = each(t("di"), "di")
        out["outbound_dialed_total_count"] = whole(n("di"))
    for w, name in (("li", "login"), ("ib", "inbound"), ("ob", "outbound"), ("hi", "inbound_hold"), ("ho", "outbound_hold"),
                    ("ai", "inbound_acw"), ("ao", "outbound_acw")):
        out[f"{name}_max_time"] = m(w)
        out[f"{name}_total_count"] = whole(n(w))
        out[f"{name}_total_time"] = q.hms(t(w))
    for a, b, name in (("ib", "ob", "total_call"), ("hi", "ho", "total_hold_total"), ("ai", "ao", "total_acw_total")):
        out[f"{name}_count"] = whole(f"{n(a)} + {n(b)}")
        out[f"{name}_time"] = whole(f"{t(a)} + {t(b)}")
    for way, total, talk, hold, acw in (("inbound", "ib", "ci", "hi", "ai"), ("outbound", "ob", "co", "ho", "ao")):
        out[f"avg_{way}_call_count"] = mean(f"{total}_an")
        out[f"avg_{way}_call_time"] = mean(f"{total}_at")
        out[f"{way}_talk_max_time"] = f"{m(talk)} - {m(hold)}"
        out[f"{way}_connected_total_count"] = whole(n(talk))
        out[f"{way}_talk_total_time"] = q.hms(f"({t(talk)} - {t(hold)})")
        out[f"avg_{way}_talk_time"] = each(f"{t(talk)} - {t(hold)}" if all_tenants else t(talk), talk)
        out[f"avg_{way}_handling_time"] = each(f"{t(talk)} + {t(acw)}", talk)
        out[f"avg_{way}_hold_count"] = mean(f"{hold}_an")
        out[f"avg_{way}_hold_time"] = q.hms(q.trunc_secs(f"coalesce({hold}_at, 0)"))
        out[f"avg_{way}_acw_count"] = mean(f"{acw}_an")
        out[f"avg_{way}_acw_time"] = mean(f"{acw}_at")
    out["connected_total_count"] = whole(f"{n('ci')} + {n('co')}")
    out["total_talk_total_time"] = whole(f"{t('ci')} - {t('hi')} + {t('co')} - {t('ho')}")
    out["idle_time_inbound"] = q.hms("idle_i")
    out["idle_time_outbound"] = q.hms(f"(idle_o - {t('di')})" if all_tenants else "idle_o")
    out["idle_time_offline"] = q.hms(f"({t('li')} - {t('ib')} - {t('ob')})" if all_tenants else "idle_x")
    out["total_break_time"] = q.hms(t("br"))
    for name in ("login", "inbound", "outbound", "inbound_idle", "outbound_idle", "offline_idle", "inbound_acw", "outbound_acw",
                 "inbound_talk", "outbound_talk", "inbound_hold", "outbound_hold", "break"):
        out[f"full_total_{name}_time"] = q.hms(f"g_{name}")
    for name in ("inbound_hold_count", "outbound_hold_count", "inbound_calls", "outbound_calls"):
        out[f"full_total_{name}"] = whole(f"g_{name}")
    for way in ("inbound", "outbound"):
        out[f"full_total_connected_{way}_calls"] = whole(
            f"coalesce(day_{way}, 0)" if all_tenants else f"g_connected_{way}")
        out[f"full_avg_{way}_handling_time"] = q.hms(f"(g_handled_{way} // coalesce(nullif(g_one_{way}, 0), 1))")
        out[f"full_avg_{way}_talk_time"] = q.hms(f"CAST(round(g_mean_talk_{way}) AS BIGINT)")
        out[f"full_avg_{way}_hold_time"] = q.hms(f"CAST(round(g_mean_hold_{way}) AS BIGINT)")
    return out


def _grand() -> str:
    z = lambda x: f"coalesce({x}, 0)"
    sums = {"login": z("li_t"), "inbound": z("ib_t"), "outbound": z("ob_t"), "inbound_idle": "idle_i", "outbound_idle": "idle_o",
            "offline_idle": "idle_x", "inbound_acw": z("ai_t"), "outbound_acw": z("ao_t"),
            "inbound_talk": f"{z('ci_t')} - {z('hi_t')}", "outbound_talk": f"{z('co_t')} - {z('ho_t')}",
            "inbound_hold": z("hi_t"), "outbound_hold": z("ho_t"), "break": z("br_t"),
            "inbound_hold_count": z("hi_n"), "outbound_hold_count": z("ho_n"), "inbound_calls": z("ib_n"),
            "outbound_calls": z("ob_n"), "connected_inbound": z("ci_n"), "connected_outbound": z("co_n"),
            "handled_inbound": f"{z('ci_t')} + {z('ai_t')}", "handled_outbound": f"{z('co_t')} + {z('ao_t')}",
            "one_inbound": "coalesce(ci_n, 1)", "one_outbound": "coalesce(co_n, 1)"}
    means = {"talk_inbound": f"{z('ci_t')} - {z('hi_t')}", "talk_outbound": f"{z('co_t')} - {z('ho_t')}",
             "hold_inbound": z("hi_t"), "hold_outbound": z("ho_t")}
    return ",\n    ".join([f"CAST(sum({e}) AS BIGINT) AS g_{k}" for k, e in sums.items()]
                          + [f"avg({e}) AS g_mean_{k}" for k, e in means.items()])


def agent_sql(from_ts: str, to_ts: str, *, variant: str, resource_id=None, b_unit=None,
              company: int = 1, tenant: int = 1) -> str:
    """variant: 'base' (R3), 'all' (R4) or 'bu' (R5)."""
    every, unit = variant != "base", variant == "bu"
    where = [f"summary_date BETWEEN CAST({q.ts(from_ts)} AS DATE) AND CAST({q.ts(to_ts)} AS DATE)"]
    scope, earlier = "true", "true"
    if not every:
        where += [f"company = '{company}'", f"tenant = '{tenant}'"]
        where += [f"param1 = '{resource_id}'"] if resource_id is not None else []
        scope = earlier = f"company_id = {company} AND tenant_id = {tenant}"
        if b_unit not in (None, "ALL"):
            where.append(f"business_unit = '{b_unit}'")
            earlier += f" AND business_unit = '{b_unit}'"
    day = ["summary_date", "tenant", "company"] + (["business_unit"] if unit else [])
    key = ", ".join([*day, "param1"])
    not_null = " AND ".join(f"{k} IS NOT NULL" for k in [*day, "param1"])
    day_not_null = " AND ".join(f"{k} IS NOT NULL" for k in day)
    s_unit = ", business_unit" if unit else ""
    p_unit = " AND p.business_unit = agent_day.business_unit" if unit else ""
    z = lambda x: f"coalesce({x}, 0)"
    shown = ",\n  ".join(f"{e} AS {name}" for name, e in _columns(every, unit).items())
    return q.ctes("daily", "status").rstrip("\n") + f""",
every_agent AS (
  SELECT {key}, count(*) FILTER (WHERE {_WINDOWS['li']}) AS logins,
    {_statistics(every, not_null)},
    sum(total_count) FILTER (WHERE {_WINDOWS['ci']}) AS raw_ci, sum(total_count) FILTER (WHERE {_WINDOWS['co']}) AS raw_co
  FROM daily WHERE {' AND '.join(where)} GROUP BY {key}
), agent_day AS (
  SELECT *, {z('ib_t')} - {z('ai_t')} - {z('ci_t')} AS idle_i, {z('ob_t')} - {z('ao_t')} - {z('co_t')} AS idle_o,
    {z('li_t')} - ({z('ib_t')} - {z('ai_t')} - {z('ci_t')}) - ({z('ob_t')} - {z('ao_t')} - {z('co_t')}) AS idle_x
  FROM every_agent WHERE logins > 0
), day_calls AS (
  SELECT {', '.join(day)}, sum(raw_ci) AS day_inbound, sum(raw_co) AS day_outbound
  FROM every_agent WHERE {day_not_null} GROUP BY {', '.join(day)}
), grand AS (
  SELECT {_grand()}
  FROM agent_day
), presence AS (
  SELECT CAST(created_at AS DATE) AS summary_date, tenant_id, company_id{s_unit}, resource_id,
    min(created_at) FILTER (WHERE reason = 'Register') AS first_in, max(created_at) FILTER (WHERE reason = 'UnRegister') AS last_out
  FROM status WHERE {scope} GROUP BY ALL
), before AS (
  SELECT resource_id, max(created_at) AS earlier_in FROM status
  WHERE reason = 'Register' AND created_at < {q.ts(from_ts)} AND {earlier} GROUP BY ALL
)
SELECT {shown}
FROM agent_day CROSS JOIN grand LEFT JOIN day_calls USING ({', '.join(day)})
LEFT JOIN presence p ON p.summary_date = agent_day.summary_date AND p.tenant_id = CAST(agent_day.tenant AS INTEGER)
  AND p.company_id = CAST(agent_day.company AS INTEGER) AND p.resource_id = CAST(param1 AS INTEGER){p_unit}
LEFT JOIN before b ON b.resource_id = CAST(param1 AS INTEGER)"""
