"""Operator-level queries: each building block of the reports on its own.

Every entry reads the derived call-centre tables over their whole range
and pairs a Spark builder with the DuckDB SQL computing the same result.
Keys follow the operator inventory (scans, filters, joins, aggregates,
windows, sessionisation, scalar functions, data checks, counters).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialtone import schemas
from dialtone.catalog import params as P
from dialtone.catalog import sqlfx as q
from dialtone.functions.fmt import format_hms, hms, int_div, pct_int
from dialtone.functions.timefx import date_bounds, local_date, local_hour, utc_date
from dialtone.operators import bitmaps as bm
from dialtone.operators import cdr as co
from dialtone.operators import checks as ck
from dialtone.operators import counters as cn
from dialtone.operators import daily as dy
from dialtone.operators import sessions as ss
from dialtone.operators.spine import hour_spine
from dialtone.operators.totals import with_grand_totals
from dialtone.plans import agent_daily
from dialtone.plans.call_performance import call_metrics, staff_metrics
from dialtone.session import apply_conf, shared_folder
from dialtone.sources import dims, facts
from dialtone.sources.facts import write_legs_by_uuid
from dialtone.sources.fixtures import Tables, tables
from dialtone.sources.snapshots import LastEvents
from dialtone.sources.tables import read_evolving

c = F.col
Builder = Callable[[SparkSession, Tables], DataFrame]

_SPARK: dict[str, Builder] = {}
_SQL: dict[str, str] = {}


def op(name: str, sql: str | None):
    """Register a Spark builder ``(spark, tables) -> DataFrame`` and its oracle SQL."""
    def deco(fn: Builder) -> Builder:
        _SPARK[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


FROM, TO = q.ts(P.FROM_TS), q.ts(P.TO_TS)
FIRST_DAY, LAST_DAY = date_bounds(P.FROM_TS, P.TO_TS)
LD, LH = q.local_date("created_time"), q.local_hour("created_time")
SKILLS_IN = "('skill0', 'skill1', 'skill2')"
INBOUND_SCOPE = (f"direction = 'inbound' AND obj_type = 'HTTAPI' AND company_id = {P.COMPANY} "
                 f"AND tenant_id = {P.TENANT}")


def _inbound_scope(cdr: DataFrame, skills: bool = False) -> DataFrame:
    return co.filter_calls(cdr, P.FROM_TS, P.TO_TS, inclusive_end=False, company=P.COMPANY,
                           tenant=P.TENANT, direction="inbound", obj_type="HTTAPI",
                           skills=P.SKILLS if skills else None)


# --- scans, sources ---------------------------------------------------------
@op("scan_cdr_range", q.ctes("cdr") + f"""
SELECT uuid, created_time, tenant_id, company_id, direction, agent_skill FROM cdr
WHERE created_time >= {FROM} AND created_time < {TO}""")
def _scan_cdr(spark, t):
    return co.filter_calls(t.cdr, P.FROM_TS, P.TO_TS, inclusive_end=False).select(
        "uuid", "created_time", "tenant_id", "company_id", "direction", "agent_skill")


@op("scan_daily_range", q.ctes("daily") + f"""
SELECT summary_date, tenant, company, param1, window_name, param2, total_time FROM daily
WHERE summary_date >= DATE '{FIRST_DAY}' AND summary_date <= DATE '{LAST_DAY}'""")
def _scan_daily(spark, t):
    return t.daily.filter(c("summary_date").between(F.lit(FIRST_DAY), F.lit(LAST_DAY))).select(
        "summary_date", "tenant", "company", "param1", "window_name", "param2", "total_time")


@op("scan_status_range", q.ctes("status") + f"""
SELECT resource_id, created_at, reason FROM status
WHERE reason IN ('Register', 'UnRegister') AND created_at >= {FROM} AND created_at <= {TO}""")
def _scan_status(spark, t):
    return t.status.filter(c("reason").isin("Register", "UnRegister")
                           & co.in_range("created_at", P.FROM_TS, P.TO_TS, True)) \
        .select("resource_id", "created_at", "reason")


@op("dim_business_units", q.ctes("business_units") + "SELECT * FROM business_units")
def _dim_bu(spark, t):
    return t.business_units


@op("dim_user_groups", q.ctes("user_groups") + "SELECT * FROM user_groups")
def _dim_ug(spark, t):
    return t.user_groups


@op("dim_contact_numbers", q.ctes("contact_numbers") + "SELECT * FROM contact_numbers")
def _dim_cn(spark, t):
    return t.contact_numbers


def _folder(spark, t: Tables, name: str) -> str:
    """Where a query that writes tables keeps them: one folder for its input, taken again at every call."""
    return f"{shared_folder(spark)}/dialtone/{name}-{crc32(t.sf_dir.encode()):08x}"


@op("evolve_schema", q.ctes("cdr") + """
SELECT uuid, created_time, direction, CASE WHEN tenant_id = 2 THEN queue_sec % 3 END AS queue_priority FROM cdr""")
def _evolve(spark, t):
    """Files of tenant 2 have a column that the older files of the others lack."""
    from pyspark.sql import types as T
    folder = _folder(spark, t, "evolve")
    narrow = t.cdr.select("uuid", "created_time", "direction", "tenant_id", "queue_sec")
    old = narrow.filter((c("tenant_id") != 2) | c("tenant_id").isNull())
    old.select("uuid", "created_time", "direction").write.mode("overwrite").parquet(f"{folder}/v1")
    new = narrow.filter(c("tenant_id") == 2).withColumn("queue_priority", c("queue_sec") % 3)
    new.select("uuid", "created_time", "direction", "queue_priority").write.mode("overwrite").parquet(f"{folder}/v2")
    wanted = T.StructType([schemas.CDR[x] for x in ("uuid", "created_time", "direction", "queue_priority")])
    return read_evolving(spark, [f"{folder}/v1", f"{folder}/v2"], wanted)


# --- filters ------------------------------------------------------------------
@op("filter_inbound", q.ctes("cdr") + f"""
SELECT uuid, created_time, agent_skill FROM cdr
WHERE created_time >= {FROM} AND created_time < {TO} AND {INBOUND_SCOPE}""")
def _filter_inbound(spark, t):
    return _inbound_scope(t.cdr).select("uuid", "created_time", "agent_skill")


_SPACED = "skill0,skill1, skill2"  # the item ' skill2' keeps its space: no match


@op("filter_skills", q.ctes("cdr") + f"""
SELECT uuid, agent_skill FROM cdr WHERE agent_skill IN {"('skill0', 'skill1', ' skill2')"}""")
def _filter_skills(spark, t):
    return t.cdr.filter(c("agent_skill").isin(co.skill_list(_SPACED))).select("uuid", "agent_skill")


@op("abandoned_vs_dropped", q.ctes("cdr") + f"""
SELECT tenant_id, company_id,
  count(*) FILTER (WHERE is_queued AND NOT agent_answered AND queue_sec > 5) AS abandoned,
  count(*) FILTER (WHERE is_queued AND NOT agent_answered AND queue_sec <= 5) AS dropped,
  count(*) FILTER (WHERE is_queued AND NOT agent_answered) AS queued_unanswered
FROM cdr WHERE direction = 'inbound' AND obj_type = 'HTTAPI' GROUP BY tenant_id, company_id""")
def _abandoned(spark, t):
    legs = t.cdr.filter((c("direction") == "inbound") & (c("obj_type") == "HTTAPI"))
    return legs.groupBy("tenant_id", "company_id").agg(
        co.count_where(co.abandoned()).alias("abandoned"),
        co.count_where(co.dropped()).alias("dropped"),
        co.count_where(c("is_queued") & ~c("agent_answered")).alias("queued_unanswered"))


@op("hold_avg_nonzero", q.ctes("cdr") + """
SELECT tenant_id, company_id, direction, round(avg(CASE WHEN hold_sec > 0 THEN hold_sec END), 4) AS hold_avg,
  count(*) FILTER (WHERE hold_sec > 0) AS held_calls
FROM cdr GROUP BY tenant_id, company_id, direction""")
def _hold_avg(spark, t):
    return t.cdr.groupBy("tenant_id", "company_id", "direction").agg(
        F.round(F.avg(F.when(c("hold_sec") > 0, c("hold_sec"))), 4).alias("hold_avg"),
        co.count_where(c("hold_sec") > 0).alias("held_calls"))


@op("filter_hour_band", q.ctes("cdr") + f"""
SELECT {LH} AS local_hour, count(*) AS calls FROM cdr
WHERE direction = 'inbound' AND {LH} >= {P.FROM_HOUR} AND {LH} <= {P.TO_HOUR} GROUP BY 1""")
def _hour_band(spark, t):
    legs = t.cdr.filter(c("direction") == "inbound").withColumn("local_hour",
                                                                local_hour("created_time", P.TZ))
    return (legs.filter(c("local_hour").between(P.FROM_HOUR, P.TO_HOUR))
            .groupBy("local_hour").agg(F.count(F.lit(1)).alias("calls")))


@op("break_time_by_day", q.ctes("breaks") + f"""
SELECT resource_id, CAST(date_trunc('day', created_at) AS DATE) AS day, {q.hms('SUM(duration)')} AS break_time
FROM breaks WHERE status_type = 'ResourceStatus' AND status = 'NotAvailable'
  AND created_at BETWEEN {FROM} AND {TO}
GROUP BY 2, resource_id""")
def _breaks(spark, t):
    b = t.breaks.filter((c("status_type") == "ResourceStatus") & (c("status") == "NotAvailable")
                        & co.in_range("created_at", P.FROM_TS, P.TO_TS, True))
    agg = b.groupBy("resource_id", utc_date("created_at").alias("day")) \
        .agg(F.sum("duration").alias("break_time"))
    return format_hms(agg, ["break_time"])


# --- joins --------------------------------------------------------------------
# A leg plays two parts, for the agent that received it and for the one that dialled; the parts of an agent's day are counted.
@op("cdr_agent_join", q.ctes("cdr", "resources").rstrip("\n") + f""",
part AS (
  SELECT {q.local_date('created_time')} AS day, tenant_id, company_id, 'in' AS way, received_by AS agent,
    direction = 'inbound' AS counts, agent_answered AS spoken, false AS missed
  FROM cdr WHERE created_time BETWEEN {FROM} AND {TO}
  UNION ALL
  SELECT {q.local_date('created_time')}, tenant_id, company_id, 'out', sip_from_user, direction = 'outbound', is_answered, NOT is_answered
  FROM cdr WHERE created_time BETWEEN {FROM} AND {TO}
)
SELECT part.day, part.tenant_id, part.company_id, resources.resource_id,
  {', '.join(f"CASE WHEN count(*) FILTER (WHERE way = '{w}') > 0 THEN count(*) FILTER (WHERE way = '{w}' AND counts{extra}) END AS {name}"
             for w, extra, name in (('in', '', 'in_total'), ('in', ' AND spoken', 'in_conn_n'), ('out', '', 'out_total'),
                                    ('out', ' AND spoken', 'out_conn_n'), ('out', ' AND missed', 'out_dial_n')))}
FROM part JOIN resources ON resources.resource_name = part.agent GROUP BY ALL""")
def _cdr_agent(spark, t):
    legs = co.legs_per_agent(t.cdr, t.resources, P.FROM_TS, P.TO_TS, P.TZ, by_unit=False)
    return legs.select("day", "tenant_id", "company_id", "resource_id", "in_total", "in_conn_n",
                       "out_total", "out_conn_n", c("out_dial_n"))


def _hour_counts_sql(where: str, skill: bool) -> str:
    sk = "agent_skill, " if skill else ""
    return (f"SELECT {LD} AS c_date, {LH} AS c_hour, {sk}count(*) AS n FROM cdr "
            f"WHERE created_time >= {FROM} AND created_time < {TO} AND {where} GROUP BY 1, 2"
            + (", agent_skill" if skill else ""))


@op("hourly_gap_fill", q.ctes("cdr") + f"""
SELECT series.s_date, series.s_hour, a.n AS ivrcount
FROM (SELECT CAST(dd AS DATE) AS s_date, CAST(hour(dd) AS INTEGER) AS s_hour
      FROM generate_series(date_trunc('hour', {q.local(FROM)}), date_trunc('hour', {q.local(TO)}), INTERVAL 1 HOUR) t(dd)) series
LEFT OUTER JOIN ({_hour_counts_sql(INBOUND_SCOPE, False)}) a ON series.s_date = a.c_date AND series.s_hour = a.c_hour""")
def _gap_fill(spark, t):
    legs = _inbound_scope(t.cdr)
    counts = legs.groupBy(local_date("created_time", P.TZ).alias("c_date"),
                          local_hour("created_time", P.TZ).alias("c_hour")) \
        .agg(F.count(F.lit(1)).alias("ivrcount"))
    spine = hour_spine(spark, P.FROM_TS, P.TO_TS, P.TZ)
    j = spine.join(counts, (spine.s_date == counts.c_date) & (spine.s_hour == counts.c_hour), "left")
    return j.select("s_date", "s_hour", "ivrcount")


@op("outbound_fanout_join", q.ctes("cdr") + f"""
SELECT a.c_date, a.c_hour, a.agent_skill, a.n AS ivrcount, m.n AS outboundcallcount
FROM ({_hour_counts_sql(INBOUND_SCOPE + ' AND agent_skill IN ' + SKILLS_IN, True)}) a
LEFT OUTER JOIN ({_hour_counts_sql("direction = 'outbound' AND obj_type = 'GATEWAY' AND company_id = 1 AND tenant_id = 1", False)}) m
ON a.c_date = m.c_date AND a.c_hour = m.c_hour""")
def _fanout(spark, t):
    inbound = _inbound_scope(t.cdr, skills=True).groupBy(
        local_date("created_time", P.TZ).alias("c_date"),
        local_hour("created_time", P.TZ).alias("c_hour"), "agent_skill") \
        .agg(F.count(F.lit(1)).alias("ivrcount"))
    outbound = co.filter_calls(t.cdr, P.FROM_TS, P.TO_TS, inclusive_end=False, company=P.COMPANY,
                               tenant=P.TENANT, direction="outbound", obj_type="GATEWAY") \
        .groupBy(local_date("created_time", P.TZ).alias("c_date"),
                 local_hour("created_time", P.TZ).alias("c_hour")) \
        .agg(F.count(F.lit(1)).alias("outboundcallcount"))
    return inbound.join(outbound, ["c_date", "c_hour"], "left")


_DAILY_RANGE = f"summary_date >= DATE '{FIRST_DAY}' AND summary_date <= DATE '{LAST_DAY}'"


@op("day_totals_join", q.ctes("daily").rstrip("\n") + f""",
agent_day AS (
  SELECT summary_date, tenant, company, param1, bool_or(window_name = 'LOGIN') AS logged_in,
    sum(total_count) FILTER (WHERE window_name = 'CONNECTED' AND param2 = 'CALLinbound') AS n
  FROM daily WHERE {_DAILY_RANGE} GROUP BY ALL
)
SELECT summary_date, tenant, company, param1, CAST(CASE WHEN param1 IS NOT NULL THEN n END AS BIGINT) AS in_conn_n,
  CAST(coalesce(sum(n) OVER (PARTITION BY summary_date, tenant, company), 0) AS BIGINT) AS day_in_conn_n
FROM agent_day QUALIFY logged_in""")
def _day_totals(spark, t):
    keys = ["summary_date", "tenant", "company", "param1"]
    d = t.daily.filter(c("summary_date").between(F.lit(FIRST_DAY), F.lit(LAST_DAY)))
    agg = dy.window_rollup(d, keys, ["login", "in_conn"], weighted_avg_time=True)
    agg = dy.group_totals(agg, keys[:3], {"day_in_conn_n": c("in_conn_n")})
    rows = dy.mask_null_keys(agg, keys, ["login", "in_conn"]).filter(c("_driver_rows") > 0)
    return rows.select(*keys, c("in_conn_n"),
                       F.coalesce(c("day_in_conn_n"), F.lit(0)).cast("bigint").alias("day_in_conn_n"))


@op("acw_by_direction", q.ctes("acw", "cdr") + f"""
SELECT acw.resource_id,
  CAST(SUM(CASE WHEN cdr.direction = 'inbound' THEN acw.duration ELSE 0 END) AS BIGINT) AS acw_in,
  CAST(SUM(CASE WHEN cdr.direction = 'outbound' THEN acw.duration ELSE 0 END) AS BIGINT) AS acw_out
FROM acw INNER JOIN cdr ON acw.session_id = cdr.uuid
WHERE acw.created_at >= {FROM} AND acw.created_at <= {TO} GROUP BY acw.resource_id""")
def _acw(spark, t):
    return co.acw_by_direction(t.acw, t.cdr, P.FROM_TS, P.TO_TS)


_LAST_LOGIN_SQL = q.ctes("status") + f"""
SELECT resource_id, created_at AS last_at FROM status
WHERE reason = 'Register' AND resource_id IS NOT NULL AND created_at < {q.ts(P.MID_FROM_TS)}
QUALIFY row_number() OVER (PARTITION BY resource_id ORDER BY created_at DESC) = 1"""


@op("last_login_before", q.ctes("status") + f"""
SELECT DISTINCT s.resource_id,
  (SELECT created_at FROM status x WHERE x.reason = 'Register' AND x.created_at < {q.ts(P.MID_FROM_TS)}
     AND x.resource_id = s.resource_id ORDER BY created_at DESC LIMIT 1) AS last_at
FROM status s WHERE s.reason = 'Register' AND s.created_at < {q.ts(P.MID_FROM_TS)}""")
def _last_login(spark, t):
    return ss.last_before(t.status, "Register", P.MID_FROM_TS, keep_null=True)


@op("last_login_from_boundary", _LAST_LOGIN_SQL)
def _last_login_boundary(spark, t):
    """The same from day boundaries, each made from the one before it and the days in between."""
    stored = LastEvents(spark, _folder(spark, t, "logins"))
    for day in (date(2024, 1, 4), date(2024, 1, 8)):
        stored.advance(t.status, day)
    stored.clean(keep=1)
    return stored.last_before(t.status, P.MID_FROM_TS)


@op("acw_from_bucketed_legs", q.ctes("acw", "cdr").rstrip("\n") + f""",
legs AS (SELECT uuid, count(*) FILTER (WHERE direction = 'inbound') AS i, count(*) FILTER (WHERE direction = 'outbound') AS o
  FROM cdr GROUP BY uuid)
SELECT acw.resource_id, CAST(sum(acw.duration * legs.i) AS BIGINT) AS acw_in, CAST(sum(acw.duration * legs.o) AS BIGINT) AS acw_out
FROM acw JOIN legs ON legs.uuid = acw.session_id
WHERE acw.created_at BETWEEN {FROM} AND {TO} GROUP BY acw.resource_id""")
def _acw_bucketed(spark, t):
    """After-call work with legs that lie in buckets by uuid: they are not shuffled."""
    folder = _folder(spark, t, "legs")
    name = "dialtone_" + folder.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    write_legs_by_uuid(t.cdr, name, folder, buckets=8, mode="overwrite")
    return co.acw_by_direction(t.acw, spark.table(name), P.FROM_TS, P.TO_TS)


# --- aggregates -----------------------------------------------------------------
_HOURLY_SCOPE = f"created_time >= {FROM} AND created_time < {TO} AND {INBOUND_SCOPE} AND agent_skill IN {SKILLS_IN}"


@op("hourly_ivr_count", q.ctes("cdr") + f"""
SELECT count(*) AS ivrcount, {LD} AS c_date, {LH} AS c_hour, agent_skill, company_id, tenant_id
FROM cdr WHERE {_HOURLY_SCOPE} GROUP BY 2, 3, agent_skill, company_id, tenant_id""")
def _ivr(spark, t):
    return _inbound_scope(t.cdr, skills=True).groupBy(
        local_date("created_time", P.TZ).alias("c_date"),
        local_hour("created_time", P.TZ).alias("c_hour"), "agent_skill", "company_id", "tenant_id") \
        .agg(F.count(F.lit(1)).alias("ivrcount"))


_PERF_KEYS_SQL = f"{LD} AS date, tenant_id AS tenant, company_id AS company, business_unit AS bu"
_PERF_FROM = f"FROM cdr WHERE created_time >= {FROM} AND created_time <= {TO} GROUP BY 1, 2, 3, 4"


def _metrics(t, cols):
    return call_metrics(t.cdr, P.FROM_TS, P.TO_TS, P.TZ).select("date", "tenant", "company", "bu", *cols)


@op("cdr_filtered_counts", q.ctes("cdr") + f"""
SELECT {_PERF_KEYS_SQL}, CAST(sum(CASE direction WHEN 'inbound' THEN 1 ELSE 0 END) AS BIGINT) AS total_inbound,
  CAST(sum(CASE direction WHEN 'outbound' THEN 1 ELSE 0 END) AS BIGINT) AS total_outbound,
  CAST(coalesce(sum(is_queued::INTEGER), 0) AS BIGINT) AS total_queued,
  CAST(coalesce(sum(is_queued::INTEGER * (1 - agent_answered::INTEGER)), 0) AS BIGINT) AS total_queue_dropped
{_PERF_FROM}""")
def _filtered_counts(spark, t):
    return _metrics(t, ["total_inbound", "total_outbound", "total_queued", "total_queue_dropped"])


# spoken legs by way; a day without any stays
_SPOKEN_SQL = q.ctes("cdr").rstrip("\n") + f""",
spoken AS (
  SELECT {_PERF_KEYS_SQL}, bill_sec, hold_sec,
    CASE WHEN direction = 'inbound' AND agent_answered THEN 'in' WHEN direction = 'outbound' AND is_answered THEN 'out' END AS way
  FROM cdr WHERE created_time BETWEEN {FROM} AND {TO}
)"""


@op("cdr_talk_totals", _SPOKEN_SQL + """
SELECT date, tenant, company, bu, """ + ", ".join(
    f"CAST(coalesce(sum({v}_sec) FILTER (WHERE way = '{w}'), 0) AS BIGINT) AS {name}_{w}"
    for w in ("in", "out") for v, name in (("bill", "talk"), ("hold", "hold"))) + " FROM spoken GROUP BY ALL")
def _talk_totals(spark, t):
    return _metrics(t, ["talk_in", "hold_in", "talk_out", "hold_out"])


@op("cdr_talk_avgs", _SPOKEN_SQL + """
SELECT date, tenant, company, bu, """ + ", ".join(
    f"round(avg(bill_sec) FILTER (WHERE way = '{w}'), 4) AS avg_talk_{w}" for w in ("in", "out")) + " FROM spoken GROUP BY ALL")
def _talk_avgs(spark, t):
    m = _metrics(t, ["talk_in_sum", "talk_in_n", "talk_out_sum", "talk_out_n"])
    return m.select("date", "tenant", "company", "bu",
                    F.round(c("talk_in_sum") / F.nullif(c("talk_in_n"), F.lit(0)), 4).alias("avg_talk_in"),
                    F.round(c("talk_out_sum") / F.nullif(c("talk_out_n"), F.lit(0)), 4).alias("avg_talk_out"))


# each answering agent once a day and way, beside a row without agent that keeps every day
_ANSWERING = f"""answering AS (
  SELECT DISTINCT {_PERF_KEYS_SQL}, direction AS way, CASE direction WHEN 'inbound' THEN received_by ELSE sip_from_user END AS agent
  FROM cdr WHERE created_time BETWEEN {FROM} AND {TO} AND is_answered
    AND (direction = 'inbound' AND obj_type = 'HTTAPI' OR direction = 'outbound' AND obj_type <> 'PRIVATE_USER')
)"""


@op("active_agents", q.ctes("cdr").rstrip("\n") + f""", {_ANSWERING},
seen AS (FROM answering UNION ALL SELECT DISTINCT {_PERF_KEYS_SQL}, NULL, NULL FROM cdr WHERE created_time BETWEEN {FROM} AND {TO})
SELECT date, tenant, company, bu, count(agent) FILTER (WHERE way = 'inbound') AS in_agents,
  count(agent) FILTER (WHERE way = 'outbound') AS out_agents
FROM seen GROUP BY ALL""")
def _active_agents(spark, t):
    return _metrics(t, ["in_agents", "out_agents"])


@op("active_agents_by_week", q.ctes("cdr").rstrip("\n") + f""", {_ANSWERING}
SELECT CAST(date_trunc('week', date) AS DATE) AS week, tenant, CAST(count(DISTINCT agent) FILTER (WHERE way = 'inbound') AS BIGINT) AS in_agents,
  CAST(count(DISTINCT agent) FILTER (WHERE way = 'outbound') AS BIGINT) AS out_agents
FROM answering WHERE agent IS NOT NULL GROUP BY ALL""")
def _active_by_week(spark, t):
    """Distinct agents of weeks over all companies and units, from the bitmaps of their days."""
    roles = bm.agent_roles(t.cdr, P.FROM_TS, P.TO_TS, P.TZ)
    days = bm.agent_bitmaps(roles, bm.agent_numbers(roles))
    week = F.to_date(F.date_trunc("week", c("date"))).alias("week")
    return bm.count_agents(days, [week, "tenant"])


_ROLLUP_WINDOWS = {"login": "window_name = 'LOGIN'", "in_conn": "window_name = 'CONNECTED' AND param2 = 'CALLinbound'",
                   "in_hold": "window_name = 'AGENTHOLD' AND param2 = 'inbound'", "brk": "window_name = 'BREAK'"}


def _rollup_sql(w: str) -> str:
    rows = f"FILTER (WHERE {_ROLLUP_WINDOWS[w]})"
    return (f"max(max_time) {rows} AS {w}_m, CAST(sum(total_count) {rows} AS BIGINT) AS {w}_n, "
            f"CAST(sum(total_time) {rows} AS BIGINT) AS {w}_t, round(avg(total_time) {rows}, 4) AS {w}_avg_t")


_ROLLUP_W = list(_ROLLUP_WINDOWS)


@op("daily_window_rollup", q.ctes("daily") + f"""
SELECT summary_date, tenant, company, param1, {', '.join(_rollup_sql(w) for w in _ROLLUP_W)}
FROM daily WHERE {_DAILY_RANGE} AND window_name IN ('AGENTHOLD', 'BREAK', 'CONNECTED', 'LOGIN')
GROUP BY summary_date, tenant, company, param1""")
def _rollup(spark, t):
    keys = ["summary_date", "tenant", "company", "param1"]
    d = t.daily.filter(c("summary_date").between(F.lit(FIRST_DAY), F.lit(LAST_DAY)))
    agg = dy.window_rollup(d, keys, _ROLLUP_W, weighted_avg_time=False)
    cols = []
    for w in _ROLLUP_W:
        cols += [c(f"{w}_m"), c(f"{w}_n"), c(f"{w}_t"), F.round(c(f"{w}_avg_t"), 4).alias(f"{w}_avg_t")]
    return agg.select(*keys, *cols)


@op("weighted_avg_time", q.ctes("daily") + f"""
SELECT summary_date, tenant, company, param1, window_name,
  CAST(sum(total_time) // COALESCE(NULLIF(sum(total_count), 0), 1) AS BIGINT) AS avg_time
FROM daily WHERE {_DAILY_RANGE} GROUP BY 1, 2, 3, 4, 5""")
def _weighted(spark, t):
    d = t.daily.filter(c("summary_date").between(F.lit(FIRST_DAY), F.lit(LAST_DAY)))
    return d.groupBy("summary_date", "tenant", "company", "param1", "window_name").agg(
        int_div(F.sum("total_time"), F.coalesce(F.nullif(F.sum("total_count"), F.lit(0)), F.lit(1)))
        .alias("avg_time"))


@op("login_logout_by_day", q.ctes("status") + f"""
SELECT CAST(created_at AS DATE) AS day, tenant_id, company_id, resource_id,
  min(CASE WHEN reason = 'Register' THEN created_at END) AS first_at,
  max(CASE WHEN reason = 'UnRegister' THEN created_at END) AS last_at
FROM status WHERE reason IN ('Register', 'UnRegister')
  AND CAST(created_at AS DATE) BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}'
GROUP BY 1, 2, 3, 4""")
def _login_logout(spark, t):
    return ss.first_last_per_day(t.status, ["tenant_id", "company_id", "resource_id"],
                                 FIRST_DAY, LAST_DAY)


def _ranked_sql(reasons: tuple[str, str]) -> str:
    return (f"SELECT resource_id, created_at, reason, "
            f"LEAD(created_at) OVER (PARTITION BY resource_id ORDER BY created_at) AS next_at, "
            f"LEAD(reason) OVER (PARTITION BY resource_id ORDER BY created_at) AS next_reason "
            f"FROM status WHERE reason IN ('{reasons[0]}', '{reasons[1]}') "
            f"AND created_at >= {FROM} AND created_at <= {TO}")


_SPAN_US = "epoch_us(next_at) - epoch_us(created_at)"


@op("session_totals", q.ctes("status") + f"""
SELECT COALESCE(l.resource_id, i.resource_id, o.resource_id) AS resource_id,
  CAST(l.us AS BIGINT) AS login_us, CAST(i.us AS BIGINT) AS inbound_us, CAST(o.us AS BIGINT) AS outbound_us,
  {q.hms('l.us // 1000000')} AS login_total_time
FROM (SELECT resource_id, sum({_SPAN_US}) AS us FROM ({_ranked_sql(('Register', 'UnRegister'))}) r
      WHERE reason = 'Register' AND next_reason = 'UnRegister' GROUP BY 1) l
FULL OUTER JOIN (SELECT resource_id, sum({_SPAN_US}) AS us FROM ({_ranked_sql(('Inbound', 'endInbound'))}) r
      WHERE reason = 'Inbound' GROUP BY 1) i ON l.resource_id IS NOT DISTINCT FROM i.resource_id
FULL OUTER JOIN (SELECT resource_id, sum({_SPAN_US}) AS us FROM ({_ranked_sql(('Outbound', 'endOutbound'))}) r
      WHERE reason = 'Outbound' GROUP BY 1) o ON COALESCE(l.resource_id, i.resource_id) IS NOT DISTINCT FROM o.resource_id
WHERE COALESCE(l.us, i.us, o.us) IS NOT NULL""")
def _session_totals(spark, t):
    s = ss.span_totals(t.status, P.FROM_TS, P.TO_TS)
    s = s.filter(c("login_us").isNotNull() | c("inbound_us").isNotNull() | c("outbound_us").isNotNull())
    out = s.select("resource_id", "login_us", "inbound_us", "outbound_us",
                   F.call_function("div", c("login_us"), F.lit(1000000)).alias("login_total_time"))
    return format_hms(out, ["login_total_time"])


@op("staff_rollup", q.ctes("daily").rstrip("\n") + f""",
part AS (
  SELECT summary_date, tenant, company, business_unit, window_name, count(*) AS n, sum(total_time) AS t
  FROM daily WHERE {_DAILY_RANGE} GROUP BY ALL
)
SELECT summary_date AS date, tenant::INTEGER AS tenant, company::INTEGER AS company, business_unit AS bu,
  coalesce(any_value(n) FILTER (WHERE window_name = 'LOGIN'), 0)::BIGINT AS staff_count,
  {', '.join(f"coalesce(any_value(t) FILTER (WHERE window_name = '{w}'), 0)::BIGINT AS {name}"
             for w, name in (('LOGIN', 'staff_time'), ('AFTERWORK', 'acw_time'), ('BREAK', 'break_time')))}
FROM part GROUP BY ALL""")
def _staff(spark, t):
    return staff_metrics(t.daily, P.FROM_TS, P.TO_TS)


# --- windows, sessionisation ------------------------------------------------------
_REG = ("Register", "UnRegister")


def _reg_events(t) -> DataFrame:
    return t.status.filter(c("reason").isin(*_REG)
                           & co.in_range("created_at", P.FROM_TS, P.TO_TS, True)) \
        .select("resource_id", "created_at", "reason")


@op("event_rank", q.ctes("status") + f"""
SELECT resource_id, created_at, reason,
  ROW_NUMBER() OVER (PARTITION BY resource_id ORDER BY created_at) AS rn
FROM status WHERE reason IN ('Register', 'UnRegister') AND created_at >= {FROM} AND created_at <= {TO}""")
def _rank(spark, t):
    return ss.running_count(_reg_events(t), ["resource_id"], F.lit(True), "rn")


@op("event_lead", q.ctes("status") + _ranked_sql(_REG))
def _lead(spark, t):
    return ss.lead_in_time(_reg_events(t), ["resource_id"])


@op("running_close_count", q.ctes("status") + f"""
SELECT resource_id, created_at, reason,
  CAST(SUM(CASE WHEN reason = 'endInbound' THEN 1 ELSE 0 END) OVER (PARTITION BY resource_id ORDER BY created_at
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS close_count
FROM status WHERE reason IN ('Inbound', 'endInbound') AND created_at >= {FROM} AND created_at <= {TO}""")
def _running(spark, t):
    ev = t.status.filter(c("reason").isin("Inbound", "endInbound")
                         & co.in_range("created_at", P.FROM_TS, P.TO_TS, True)) \
        .select("resource_id", "created_at", "reason")
    return ss.running_count(ev, ["resource_id"], c("reason") == "endInbound", "close_count")


@op("grand_totals", q.ctes("daily") + f"""
SELECT summary_date, tenant, company, param1, login_t,
  CAST(SUM(login_t) OVER () AS BIGINT) AS full_login_t, CAST(COUNT(*) OVER () AS BIGINT) AS n_rows,
  CAST(round(AVG(login_t) OVER ()) AS BIGINT) AS avg_login_t
FROM (SELECT summary_date, tenant, company, param1, CAST(sum(total_time) AS BIGINT) AS login_t FROM daily
      WHERE window_name = 'LOGIN' AND {_DAILY_RANGE} GROUP BY 1, 2, 3, 4) x""")
def _grand(spark, t):
    d = t.daily.filter((c("window_name") == "LOGIN")
                       & c("summary_date").between(F.lit(FIRST_DAY), F.lit(LAST_DAY)))
    rows = d.groupBy("summary_date", "tenant", "company", "param1").agg(
        F.sum("total_time").alias("login_t"))
    totals = {"full_login_t": F.sum("login_t").cast("bigint"),
              "n_rows": F.count(F.lit(1)).cast("bigint"),
              "avg_login_t": F.expr(agent_daily.round_avg_sql("login_t"))}
    return with_grand_totals(rows, totals, by=["summary_date", "tenant", "company", "param1"])


def _spans_sql(reasons: tuple[str, str], require_next: bool) -> str:
    cond = f" AND next_reason = '{reasons[1]}'" if require_next else ""
    return q.ctes("status") + f"""
SELECT resource_id, tenant_id, company_id, business_unit, created_at AS start_at, next_at AS end_at,
  epoch_us(next_at) - epoch_us(created_at) AS span_us
FROM (SELECT *, LEAD(created_at) OVER (PARTITION BY resource_id ORDER BY created_at) AS next_at,
        LEAD(reason) OVER (PARTITION BY resource_id ORDER BY created_at) AS next_reason
      FROM status WHERE reason IN ('{reasons[0]}', '{reasons[1]}') AND created_at >= {FROM} AND created_at <= {TO}) r
WHERE reason = '{reasons[0]}'{cond}"""


@op("login_sessions", _spans_sql(_REG, True))
def _login_sessions(spark, t):
    return ss.spans(t.status, "Register", "UnRegister", P.FROM_TS, P.TO_TS, require_next="UnRegister")


@op("inbound_spans", _spans_sql(("Inbound", "endInbound"), False))
def _inbound_spans(spark, t):
    return ss.spans(t.status, "Inbound", "endInbound", P.FROM_TS, P.TO_TS)


@op("outbound_spans", _spans_sql(("Outbound", "endOutbound"), False))
def _outbound_spans(spark, t):
    return ss.spans(t.status, "Outbound", "endOutbound", P.FROM_TS, P.TO_TS)


# --- scalar functions -----------------------------------------------------------
@op("local_bucket", q.ctes("cdr") + f"""
SELECT {LD} AS local_date, {LH} AS local_hour, CAST(created_time AS DATE) AS utc_date, count(*) AS calls
FROM cdr GROUP BY 1, 2, 3""")
def _local_bucket(spark, t):
    return t.cdr.groupBy(local_date("created_time", P.TZ).alias("local_date"),
                         local_hour("created_time", P.TZ).alias("local_hour"),
                         utc_date("created_time").alias("utc_date")) \
        .agg(F.count(F.lit(1)).alias("calls"))


@op("format_hms", q.ctes("cdr") + f"""
SELECT uuid, {q.hms('bill_sec - 300')} AS talk_less_5min, {q.hms('bill_sec * 151')} AS long_total,
  ' ' || {q.hms('queue_sec - 3661')} || ' ' AS padded
FROM cdr""")
def _format(spark, t):
    out = t.cdr.select("uuid", (c("bill_sec") - 300).alias("a"), (c("bill_sec") * 151).alias("b"),
                       (c("queue_sec") - 3661).alias("p"))
    return out.select("uuid", hms(c("a")).alias("talk_less_5min"), hms(c("b")).alias("long_total"),
                      F.concat(F.lit(" "), hms(c("p")), F.lit(" ")).alias("padded"))


@op("hourly_percentages", q.ctes("cdr") + f"""
SELECT {LD} AS c_date, {LH} AS c_hour, count(*) FILTER (WHERE is_queued) AS queued,
  count(*) FILTER (WHERE is_queued AND NOT agent_answered AND queue_sec > 5) * 100
    // NULLIF(count(*) FILTER (WHERE is_queued), 0) AS abandonedpercent,
  count(*) FILTER (WHERE is_queued AND NOT agent_answered AND queue_sec <= 5) * 100
    // NULLIF(count(*) FILTER (WHERE is_queued), 0) AS droppedpercent,
  count(*) FILTER (WHERE agent_answered) * 100 // NULLIF(count(*) FILTER (WHERE is_queued), 0) AS answeredpercent
FROM cdr WHERE {_HOURLY_SCOPE} GROUP BY 1, 2""")
def _pct(spark, t):
    agg = _inbound_scope(t.cdr, skills=True).groupBy(
        local_date("created_time", P.TZ).alias("c_date"),
        local_hour("created_time", P.TZ).alias("c_hour")).agg(
        co.nonzero_count(c("is_queued")).alias("q"), co.count_where(c("is_queued")).alias("queued"),
        co.count_where(co.abandoned()).alias("ab"), co.count_where(co.dropped()).alias("dr"),
        co.count_where(c("agent_answered")).alias("an"))
    return agg.select("c_date", "c_hour", "queued", pct_int(c("ab"), c("q")).alias("abandonedpercent"),
                      pct_int(c("dr"), c("q")).alias("droppedpercent"),
                      pct_int(c("an"), c("q")).alias("answeredpercent"))


# tenths rounded half up in whole numbers: floor((20 calls + agents) / 2 agents)
@op("calls_per_agent", q.ctes("cdr").rstrip("\n") + f""",
by_agent AS (
  SELECT {LD} AS date, received_by AS agent, count(*) FILTER (WHERE direction = 'inbound' AND is_answered AND obj_type = 'HTTAPI') AS n
  FROM cdr WHERE created_time BETWEEN {FROM} AND {TO} GROUP BY ALL
), by_day AS (
  SELECT date, sum(n) AS calls, count(agent) FILTER (WHERE n > 0) AS agents FROM by_agent GROUP BY date
)
SELECT date, CASE WHEN agents > 0 THEN ((20 * calls + agents) // (2 * agents))::DOUBLE / 10 END AS average_inbound_call_per_agent
FROM by_day""")
def _calls_per_agent(spark, t):
    from dialtone.plans.call_performance import ratio_1dp
    leg = (c("direction") == "inbound") & c("is_answered") & (c("obj_type") == "HTTAPI")
    agg = co.filter_calls(t.cdr, P.FROM_TS, P.TO_TS, inclusive_end=True).groupBy(
        local_date("created_time", P.TZ).alias("date")).agg(
        co.count_where(leg).alias("answers"),
        F.count_distinct(F.when(leg, c("received_by"))).alias("agents"))
    return agg.select("date", F.when(c("agents") != 0, ratio_1dp(c("answers"), c("agents")))
                      .alias("average_inbound_call_per_agent"))


@op("default_logout", q.ctes("daily", "status").rstrip("\n") + f""",
worked AS (SELECT DISTINCT summary_date, tenant, company, param1 FROM daily WHERE window_name = 'LOGIN' AND {_DAILY_RANGE}),
marks AS (
  SELECT summary_date, tenant, company, param1, summary_date + TIME '18:29:59' AS moment, 0 AS grade FROM worked
  UNION ALL
  SELECT w.summary_date, w.tenant, w.company, w.param1, s.created_at, 1 FROM worked w JOIN status s
    ON s.reason = 'UnRegister' AND s.created_at::DATE = w.summary_date AND s.resource_id = w.param1::INTEGER
   AND s.tenant_id = w.tenant::INTEGER AND s.company_id = w.company::INTEGER
)
SELECT summary_date, tenant, company, param1, max_by(moment, row(grade, moment)) AS logout_time FROM marks GROUP BY ALL""")
def _default_logout(spark, t):
    d = t.daily.filter((c("window_name") == "LOGIN")
                       & c("summary_date").between(F.lit(FIRST_DAY), F.lit(LAST_DAY)))
    rows = d.select("summary_date", "tenant", "company", "param1").distinct().select(
        "*", *[c(x).cast("int").alias(f"_{x}") for x in ("tenant", "company", "param1")])
    sd = ss.first_last_per_day(t.status, ["tenant_id", "company_id", "resource_id"],
                               FIRST_DAY, LAST_DAY)
    j = agent_daily.attach_login(rows, sd, ss.last_before(t.status, "Register", P.FROM_TS,
                                                           name="fallback_at"), unit=False)
    return j.select("summary_date", "tenant", "company", "param1", "logout_time")


# --- data checks ------------------------------------------------------------------
@op("check_unique", q.ctes("business_units") + """
SELECT bu_id, attribute_id, count(*) AS n_rows FROM business_units
WHERE bu_id IS NOT NULL AND attribute_id IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1""")
def _unique(spark, t):
    return ck.duplicate_keys(t.business_units, ["bu_id", "attribute_id"])


@op("check_unique_groups", q.ctes("user_groups") + """
SELECT group_id, attribute_id, count(*) AS n_rows FROM user_groups
WHERE group_id IS NOT NULL AND attribute_id IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1""")
def _unique_groups(spark, t):
    return ck.duplicate_keys(t.user_groups, ["group_id", "attribute_id"])


_CONTACT_KEY = ["campaign_id", "tenant_id", "company_id", "external_user_id", "cam_schedule_id"]


@op("check_unique_contact", q.ctes("contact_numbers") + f"""
SELECT {', '.join(_CONTACT_KEY)}, count(*) AS n_rows FROM contact_numbers
WHERE {' AND '.join(k + ' IS NOT NULL' for k in _CONTACT_KEY)}
GROUP BY {', '.join(_CONTACT_KEY)} HAVING count(*) > 1""")
def _unique_contact(spark, t):
    return ck.duplicate_keys(t.contact_numbers, _CONTACT_KEY)


_KEYS = (("business_units", "attribute_id", "attributes"), ("business_units", "attribute_group_id", "attribute_groups"),
         ("user_groups", "attribute_id", "attributes"), ("user_groups", "attribute_group_id", "attribute_groups"),
         ("contact_numbers", "campaign_id", "campaigns"))


def _orphan_sql(child: str, key: str, parent: str) -> str:
    return q.ctes(child, parent) + f"""
SELECT k.* FROM {child} k WHERE k.{key} IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = k.{key})"""


def _orphan_query(child: str, key: str, parent: str):
    def run(spark, t):
        return ck.orphans(getattr(t, child), getattr(t, parent), key, key)
    return run


for _child, _key, _parent in _KEYS:
    op(f"check_orphans_{_child}_{_key}", _orphan_sql(_child, _key, _parent))(_orphan_query(_child, _key, _parent))


@op("check_orphans", _orphan_sql(*_KEYS[0]))
def _orphans(spark, t):
    return ck.orphans(t.business_units, t.attributes, "attribute_id", "attribute_id")


@op("apply_cascade", q.ctes("business_units", "attributes") + """
SELECT * FROM business_units b WHERE b.attribute_id IS NULL OR b.attribute_id NOT IN
  (SELECT attribute_id FROM attributes WHERE attribute_name = 'AMERICA' AND attribute_id IS NOT NULL)""")
def _cascade(spark, t):
    deleted = t.attributes.filter(c("attribute_name") == "AMERICA")
    return ck.apply_cascade(t.business_units, deleted, "attribute_id", "attribute_id")


@op("apply_set_null", q.ctes("contact_numbers", "campaigns") + """
SELECT k.* REPLACE (CASE WHEN p.campaign_id IS NULL THEN k.campaign_id END AS campaign_id)
FROM contact_numbers k LEFT JOIN (SELECT campaign_id FROM campaigns WHERE campaign_id >= 2) p USING (campaign_id)""")
def _set_null(spark, t):
    deleted = t.campaigns.filter(c("campaign_id") >= 2)
    return ck.apply_set_null(t.contact_numbers, deleted, "campaign_id", "campaign_id")


_KEY_TABLES = ("business_units", "user_groups", "contact_numbers")


@op("check_primary_keys", q.ctes(*_KEY_TABLES) + " UNION ALL ".join(f"""
SELECT '{name}' AS table_name, count(*) AS rows, count(*) - count(k) AS nulls,
  count(k) FILTER (WHERE n > 1) AS repeated
FROM (SELECT {key} AS k, count(*) OVER (PARTITION BY {key}) AS n FROM {name}) t""" for name, key in zip(
    _KEY_TABLES, ("id", "id", "contact_number_id"))))
def _primary_keys(spark, t):
    rows = [ck.primary_key_faults(getattr(t, n), schemas.PRIMARY_KEYS[n]).select(F.lit(n).alias("table_name"), "*")
            for n in _KEY_TABLES]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


# what becomes of the three tables that refer to others: AMERICA and campaign 2 vanish, some keys change
@op("propagate_keys", q.ctes(*_KEY_TABLES, "attributes", "campaigns") + " UNION ALL ".join([f"""
SELECT '{name}' AS table_name, id::BIGINT AS id, CASE attribute_id WHEN 2 THEN 102 ELSE attribute_id END::INTEGER AS key1,
  CASE attribute_group_id WHEN 1 THEN 11 WHEN 4 THEN 14 ELSE attribute_group_id END::INTEGER AS key2
FROM {name} WHERE attribute_id IS DISTINCT FROM (SELECT attribute_id FROM attributes WHERE attribute_name = 'AMERICA')"""
    for name in ("business_units", "user_groups")]) + """ UNION ALL
SELECT 'contact_numbers', contact_number_id, CASE WHEN campaign_id = 1 THEN 31 WHEN campaign_id = 2 THEN NULL ELSE campaign_id END::INTEGER, NULL::INTEGER
FROM contact_numbers""")
def _propagate(spark, t):
    """Deletions and changed keys of the parents, carried along every foreign key at once."""
    tables_ = {n: getattr(t, n) for n in (*_KEY_TABLES, "attributes", "attribute_groups", "campaigns")}
    deleted = {"attributes": t.attributes.filter(c("attribute_name") == "AMERICA").select("attribute_id"),
               "campaigns": t.campaigns.filter(c("campaign_id") == 2).select("campaign_id")}
    renamed = lambda df, key, by: df.select(key, (c(key) + by).alias("new"))
    changed = {"attributes": renamed(t.attributes.filter(c("attribute_id") == 2), "attribute_id", 100),
               "attribute_groups": renamed(t.attribute_groups.filter(c("attribute_group_id").isin(1, 4)), "attribute_group_id", 10),
               "campaigns": renamed(t.campaigns.filter(c("campaign_id").isin(1, 2)), "campaign_id", 30)}
    done = ck.propagate(tables_, schemas.FOREIGN_KEYS, schemas.PRIMARY_KEYS, deleted, changed)
    units = [done[n].select(F.lit(n).alias("table_name"), c("id").cast("bigint").alias("id"), c("attribute_id").alias("key1"),
                            c("attribute_group_id").alias("key2")) for n in ("business_units", "user_groups")]
    numbers = done["contact_numbers"].select(F.lit("contact_numbers").alias("table_name"), c("contact_number_id").alias("id"),
                                             c("campaign_id").alias("key1"), F.lit(None).cast("int").alias("key2"))
    return units[0].unionByName(units[1]).unionByName(numbers)


_DECLARED = {"business_units": ("id", "created_at", "updated_at"), "user_groups": ("id", "created_at", "updated_at"),
             "contact_numbers": ("contact_number_id", "created_at", "updated_at")}


def _not_null_sql(name: str) -> str:
    counted = ", ".join(f"count(*) - count({k}) AS nulls_{k}" for k in _DECLARED[name])
    return q.ctes(name) + f"SELECT count(*) AS rows, {counted} FROM {name}"


@op("check_not_null", _not_null_sql("contact_numbers"))
def _not_null(spark, t):
    return ck.null_counts(t.contact_numbers, list(schemas.NOT_NULL["contact_numbers"]))


@op("check_not_null_units", _not_null_sql("business_units"))
def _not_null_units(spark, t):
    return ck.null_counts(t.business_units, list(schemas.NOT_NULL["business_units"]))


@op("check_not_null_groups", _not_null_sql("user_groups"))
def _not_null_groups(spark, t):
    return ck.null_counts(t.user_groups, list(schemas.NOT_NULL["user_groups"]))


# --- dashboard counters ---------------------------------------------------------
# Fixed values, written out so that the oracle shares nothing with the code: rules and published counters.
_RULES = """rules(event_class, event_type, event_category, window_name, count) AS (VALUES
  ('DIALER', 'CAMPAIGN', 'DIALING', 'CAMPAIGNDIALING', 1),
  ('DIALER', 'CAMPAIGN', 'DISCONNECTING', 'CAMPAIGNDIALING', -1),
  ('DIALER', 'CAMPAIGN', 'DISCONNECTED', 'CAMPAIGNCONNECTED', -1),
  ('DIALER', 'CAMPAIGN', 'CONNECTED', 'CAMPAIGNCONNECTED', 1),
  ('DIALER', 'CAMPAIGN', 'NUMBERADDED', 'CAMPAIGNNUMBERSTAKEN', 1),
  ('DIALER', 'CAMPAIGN', 'REJECTED', 'CAMPAIGNREJECTED', 1)
), publish(window_name, event_name) AS (VALUES
  ('CAMPAIGNCONNECTED', 'TotalCount'), ('CAMPAIGNDIALING', 'TotalCount'), ('CAMPAIGNNUMBERSTAKEN', 'TotalCount'),
  ('CAMPAIGNCONNECTED', 'CurrentCount'), ('CAMPAIGNDIALING', 'CurrentCount'), ('CAMPAIGNREJECTED', 'TotalCount'))"""


def _rules_sql() -> str:
    return _RULES


@op("event_counters", q.ctes("counter_events").rstrip("\n") + ",\n" + _rules_sql() + """
SELECT t.window_name, p.event_name,
  CASE WHEN p.event_name = 'TotalCount' THEN t.total_count WHEN p.event_name = 'CurrentCount' THEN t.current_count END AS value
FROM (SELECT r.window_name, CAST(sum(CASE WHEN r.count > 0 THEN r.count ELSE 0 END) AS BIGINT) AS total_count,
        CAST(sum(r.count) AS BIGINT) AS current_count
      FROM counter_events e JOIN rules r ON e.event_class = r.event_class AND e.event_type = r.event_type
        AND e.event_category = r.event_category GROUP BY r.window_name) t
JOIN publish p ON p.window_name = t.window_name""")
def _counters(spark, t):
    return cn.event_counters(t.counter_events, dims.counter_rules(spark), dims.publish_meta(spark))


@op("event_counters_by_day", q.ctes("counter_events").rstrip("\n") + ",\n" + _rules_sql() + """
SELECT CAST(e.ts AS DATE) AS day, r.window_name,
  CAST(sum(CASE WHEN r.count > 0 THEN r.count ELSE 0 END) AS BIGINT) AS total_count,
  CAST(sum(r.count) AS BIGINT) AS current_count
FROM counter_events e JOIN rules r ON e.event_class = r.event_class AND e.event_type = r.event_type
  AND e.event_category = r.event_category GROUP BY 1, 2""")
def _counters_day(spark, t):
    deltas = cn.counter_deltas(t.counter_events, dims.counter_rules(spark)) \
        .withColumn("day", utc_date("ts"))
    return cn.counter_totals(deltas, ["day"])


# --- reports over tables stored by day ------------------------------------------
_WEEK = ("2024-01-08 00:00:00", "2024-01-14 12:00:00")


def _week_sql() -> str:
    from dialtone.catalog.oracle_perf import call_performance_sql
    return call_performance_sql(*_WEEK)


@op("call_performance_week_by_day", _week_sql())
def _week_by_day(spark, t):
    """One week's report over legs and summaries that are stored by day: the other days' files aren't opened."""
    from dialtone.plans.call_performance import call_performance
    folder = _folder(spark, t, "facts")
    for name in ("cdr", "daily"):
        facts.write_fact(getattr(t, name), folder, name, FIRST_DAY, LAST_DAY)
        facts.fact_table(spark, folder, name).clean(keep=1)
    return call_performance(facts.read_fact(spark, folder, "cdr"), facts.read_fact(spark, folder, "daily"), *_WEEK, P.TZ)


# --- report variants that exercise optional filters ------------------------------
def _optional_filters_sql() -> str:
    from dialtone.catalog.oracle_agent import agent_sql
    return agent_sql(P.FROM_TS, P.TO_TS, variant="base", resource_id=P.AGENT, b_unit=P.B_UNIT,
                     company=P.COMPANY, tenant=P.TENANT)


@op("optional_filters", _optional_filters_sql())
def _optional(spark, t):
    return agent_daily.agent_productivity(t.daily, t.status, P.FROM_TS, P.TO_TS, P.AGENT, P.TZ,
                                          P.B_UNIT, P.COMPANY, P.TENANT)


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(fn):
        def run(spark, sf_dir):
            apply_conf(spark)
            return fn(spark, tables(spark, sf_dir))
        return run
    return {name: wrap(fn) for name, fn in _SPARK.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
