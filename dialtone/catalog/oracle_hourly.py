"""Oracle SQL for the hourly reports, from their definitions.

Legs are labelled once (inbound or outbound, local day and hour), each label
is aggregated with FILTER, and the hours of the range are joined to the result.
Nothing is shared with the plans: skills are split here.
"""

from __future__ import annotations

from dialtone.catalog import sqlfx as q

# value, condition: averages are cut to whole seconds; no matching leg gives NULL
_IN_AVERAGES = {
    "holdsec_avg": ("hold_sec", "agent_answered AND hold_sec > 0"),
    "ivrconnect_avg": ("ivr_connect_sec", "true"),
    "answersec_avg": ("answer_sec", "agent_answered"),
    "billsec_avg": ("bill_sec", "agent_answered"),
    "queuesec_avg": ("queue_sec", "is_queued"),
    "abandonedqueue_avg": ("queue_sec", "waiting AND queue_sec > 5"),
    "answeredqueue_avg": ("queue_sec", "agent_answered"),
}
_IN_COUNTS = {
    "queuedcount": "is_queued",
    "abandonedcount": "waiting AND queue_sec > 5",
    "droppedcount": "waiting AND queue_sec <= 5",
    "answered_count": "agent_answered",
}
_OUT_AVERAGES = {
    "holdsec_avg_outbound": ("hold_sec", "is_answered AND hold_sec > 0"),
    "billsec_avg_outbound": ("bill_sec", "is_answered"),
}


def _averages(spec: dict) -> list[str]:
    return [f"avg({v}) FILTER (WHERE {cond}) AS {name}" for name, (v, cond) in spec.items()]


def hourly_sql(from_ts, to_ts, skills, b_unit, company, tenant, *, band=None, with_outbound=False) -> str:
    upper = "<=" if with_outbound else "<"
    unit = "" if b_unit is None else f" AND business_unit = '{b_unit}'"
    hours = "" if band is None else f" WHERE h BETWEEN {band[0]} AND {band[1]}"
    legs = f"""labelled AS (
  SELECT *, is_queued AND NOT agent_answered AS waiting,
    CASE WHEN direction = 'inbound' AND obj_type = 'HTTAPI' AND agent_skill IN {q.in_list(skills.split(','))} THEN 'in'
         WHEN direction = 'outbound' AND obj_type = 'GATEWAY' THEN 'out' END AS label,
    {q.local_date('created_time')} AS d, {q.local_hour('created_time')} AS h
  FROM cdr WHERE created_time >= {q.ts(from_ts)} AND created_time {upper} {q.ts(to_ts)}
    AND company_id = {company} AND tenant_id = {tenant}{unit}
), legs AS (SELECT * FROM labelled{hours})"""
    counts = [f"nullif(count(*) FILTER (WHERE {cond}), 0) AS {name}" for name, cond in _IN_COUNTS.items()]
    per_skill = ("per_skill AS (SELECT d, h, agent_skill, company_id, tenant_id, count(*) AS ivrcount,\n  "
                 + ",\n  ".join([*counts, *_averages(_IN_AVERAGES)])
                 + "\n  FROM legs WHERE label = 'in' GROUP BY ALL)")
    per_hour = ("per_hour AS (SELECT d, h, company_id, tenant_id, count(*) AS outboundcallcount,\n  "
                "nullif(count(*) FILTER (WHERE is_answered), 0) AS answered_count_outbound,\n  "
                + ",\n  ".join(_averages(_OUT_AVERAGES))
                + "\n  FROM legs WHERE label = 'out' GROUP BY ALL)")
    span = f"""spine AS (
  SELECT CAST(t AS DATE) AS d, CAST(hour(t) AS INTEGER) AS h FROM (SELECT unnest(generate_series(
    date_trunc('hour', {q.local(q.ts(from_ts))}), date_trunc('hour', {q.local(q.ts(to_ts))}), INTERVAL 1 HOUR)) AS t)
), hours AS (SELECT * FROM spine{hours})"""
    shown = ["s.ivrcount"] + [f"s.{n}" for n in _IN_COUNTS]
    shown += [f"s.{n}count * 100 // s.queuedcount AS {n}percent" for n in ("abandoned", "dropped")]
    shown.append("s.answered_count * 100 // s.queuedcount AS answeredpercent")
    shown += [f"{q.hms(q.trunc_secs(f's.{n}'))} AS {n}" for n in _IN_AVERAGES]
    joined = "hours LEFT JOIN per_skill s USING (d, h)"
    ctes = [legs, per_skill, span]
    if with_outbound:
        ctes.append(per_hour)
        shown += ["o.outboundcallcount", "o.answered_count_outbound"]
        shown += [f"{q.hms(q.trunc_secs(f'o.{n}'))} AS {n}" for n in _OUT_AVERAGES]
        joined += (" LEFT JOIN per_hour o ON o.d = s.d AND o.h = s.h AND o.company_id = s.company_id"
                   " AND o.tenant_id = s.tenant_id")
    shown += ["hours.d AS s_date", "hours.h AS s_hour", "s.agent_skill AS agentskill", "s.company_id", "s.tenant_id"]
    return (q.ctes("cdr").rstrip("\n") + ",\n" + ",\n".join(ctes) + "\nSELECT " + ",\n  ".join(shown)
            + f"\nFROM {joined}")
