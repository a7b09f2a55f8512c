"""Oracle SQL for the daily call performance report, from its definition.

Each leg becomes one row of 0/1 marks; days are sums of marks, or of seconds
times marks. Agents are counted from a list of distinct names per day and direction.
"""

from __future__ import annotations

from dialtone.catalog import sqlfx as q

_KEY = "d, tenant_id, company_id, business_unit"


def call_performance_sql(from_ts: str, to_ts: str) -> str:
    mark = lambda cond: f"CASE WHEN {cond} THEN 1 ELSE 0 END"
    ids = "agents.d = day.d AND agents.tenant_id IS NOT DISTINCT FROM day.tenant_id AND agents.company_id IS NOT DISTINCT FROM day.company_id AND agents.business_unit IS NOT DISTINCT FROM day.business_unit"
    return q.ctes("cdr", "daily").rstrip("\n") + f""",
marked AS (
  SELECT {q.local_date('created_time')} AS d, tenant_id, company_id, business_unit, bill_sec, hold_sec,
    {mark("direction = 'inbound'")} AS i, {mark("direction = 'outbound'")} AS o,
    {mark("is_queued")} AS qd, {mark("is_queued AND agent_answered = false")} AS qdrop,
    {mark("direction = 'inbound' AND agent_answered")} AS ia, {mark("direction = 'outbound' AND is_answered")} AS oa,
    {mark("direction = 'inbound' AND is_answered AND obj_type = 'HTTAPI'")} AS il,
    {mark("direction = 'outbound' AND is_answered AND obj_type <> 'PRIVATE_USER'")} AS ol,
    received_by, sip_from_user
  FROM cdr WHERE created_time BETWEEN {q.ts(from_ts)} AND {q.ts(to_ts)}
), day AS (
  SELECT {_KEY}, sum(i) AS n_in, sum(o) AS n_out, sum(qd) AS n_q, sum(qdrop) AS n_qdrop, sum(ia) AS n_ia, sum(oa) AS n_oa,
    sum(il) AS n_il, sum(ol) AS n_ol, coalesce(sum(ia * bill_sec), 0) AS t_in, coalesce(sum(ia * hold_sec), 0) AS h_in,
    coalesce(sum(oa * bill_sec), 0) AS t_out, coalesce(sum(oa * hold_sec), 0) AS h_out,
    sum(ia * bill_sec) / nullif(sum(CASE WHEN bill_sec IS NOT NULL THEN ia END), 0) AS m_in,
    sum(oa * bill_sec) / nullif(sum(CASE WHEN bill_sec IS NOT NULL THEN oa END), 0) AS m_out
  FROM marked GROUP BY ALL
), names AS (
  SELECT DISTINCT {_KEY}, 'in' AS way, received_by AS name FROM marked WHERE il = 1 AND received_by IS NOT NULL
  UNION SELECT DISTINCT {_KEY}, 'out', sip_from_user FROM marked WHERE ol = 1 AND sip_from_user IS NOT NULL
), agents AS (
  SELECT {_KEY}, count(*) FILTER (WHERE way = 'in') AS a_in, count(*) FILTER (WHERE way = 'out') AS a_out FROM names GROUP BY ALL
), staff AS (
  SELECT summary_date AS d, CAST(tenant AS INTEGER) AS tenant_id, CAST(company AS INTEGER) AS company_id, business_unit,
    sum((window_name = 'LOGIN')::INTEGER) AS n, sum((window_name = 'LOGIN')::INTEGER * total_time) AS login_t,
    sum((window_name = 'AFTERWORK')::INTEGER * total_time) AS acw_t, sum((window_name = 'BREAK')::INTEGER * total_time) AS brk_t
  FROM daily WHERE summary_date BETWEEN CAST({q.ts(from_ts)} AS DATE) AND CAST({q.ts(to_ts)} AS DATE) GROUP BY ALL
), full_day AS (
  SELECT day.*, coalesce(a_in, 0) AS a_in, coalesce(a_out, 0) AS a_out, coalesce(n, 0) AS n, coalesce(login_t, 0) AS login_t,
    coalesce(acw_t, 0) AS acw_t, coalesce(brk_t, 0) AS brk_t
  FROM day LEFT JOIN agents ON {ids}
  LEFT JOIN staff ON staff.d = day.d AND staff.tenant_id = day.tenant_id AND staff.company_id = day.company_id
    AND staff.business_unit = day.business_unit
)
SELECT CAST(row_number() OVER (ORDER BY d, tenant_id NULLS LAST, company_id NULLS LAST, business_unit NULLS LAST) AS INTEGER) AS id,
  d AS date, tenant_id AS tenant, company_id AS company, business_unit AS bu,
  n_in::BIGINT AS total_inbound, n_out::BIGINT AS total_outbound, n_q::BIGINT AS total_queued,
  n_qdrop::BIGINT AS total_queue_dropped, n_ia::BIGINT AS total_queue_answered, n_oa::BIGINT AS total_outbound_answered,
  t_in::BIGINT AS total_talktime_inbound, coalesce(round(m_in), 0)::BIGINT AS avg_talktime_inbound, h_in::BIGINT AS holdtime_inbound,
  t_out::BIGINT AS total_talktime_outbound, coalesce(round(m_out), 0)::BIGINT AS avg_talktime_outbound,
  h_out::BIGINT AS holdtime_outbound, n::BIGINT AS total_staff_count, login_t::BIGINT AS total_staff_time,
  (CASE WHEN n > 0 THEN login_t // n ELSE 0 END)::BIGINT AS average_staff_time, acw_t::BIGINT AS total_acw_time,
  (CASE WHEN n > 0 THEN acw_t // n ELSE 0 END)::BIGINT AS average_acw_time, brk_t::BIGINT AS total_break_time,
  CASE WHEN a_in > 0 THEN floor((20 * n_il + a_in) / (2.0::DOUBLE * a_in)) / 10 END AS average_inbound_call_per_agent,
  CASE WHEN a_out > 0 THEN floor((20 * n_ol + a_out) / (2.0::DOUBLE * a_out)) / 10 END AS average_outbound_call_per_agent,
  (login_t - acw_t - t_in - t_out - brk_t - h_in - h_out)::BIGINT AS total_idle_time
FROM full_day"""
