"""Registered Spark queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dialtone.catalog import params as P
from dialtone.plans import agent_daily, agent_events
from dialtone.plans import call_performance as perf
from dialtone.plans import hourly
from dialtone.session import apply_conf
from dialtone.sources.fixtures import tables

Query = Callable[[SparkSession, str], DataFrame]


def _hourly(b_unit):
    def run(spark, sf_dir):
        apply_conf(spark)
        t = tables(spark, sf_dir)
        return hourly.hourly_call_summary(spark, t.cdr, P.FROM_TS, P.TO_TS, P.SKILLS, P.TZ,
                                          b_unit, P.COMPANY, P.TENANT)
    return run


def _hourly_w_hour(b_unit):
    def run(spark, sf_dir):
        apply_conf(spark)
        t = tables(spark, sf_dir)
        return hourly.hourly_call_summary_w_hour(spark, t.cdr, P.FROM_TS, P.TO_TS, P.FROM_HOUR,
                                                 P.TO_HOUR, P.SKILLS, P.TZ, b_unit, P.COMPANY,
                                                 P.TENANT)
    return run


def _call_performance(from_ts, to_ts):
    def run(spark, sf_dir):
        apply_conf(spark)
        t = tables(spark, sf_dir)
        return perf.call_performance(t.cdr, t.daily, from_ts, to_ts, P.TZ)
    return run


def _agent(from_ts, to_ts, resource_id=None, b_unit=None):
    def run(spark, sf_dir):
        apply_conf(spark)
        t = tables(spark, sf_dir)
        return agent_daily.agent_productivity(t.daily, t.status, from_ts, to_ts, resource_id,
                                              P.TZ, b_unit, P.COMPANY, P.TENANT)
    return run


def _agent_all(from_ts, to_ts, by_unit):
    def run(spark, sf_dir):
        apply_conf(spark)
        t = tables(spark, sf_dir)
        f = agent_daily.agent_productivity_bu if by_unit else agent_daily.agent_productivity_all
        return f(t.daily, t.status, from_ts, to_ts)
    return run


def _events(from_ts, to_ts, by_unit):
    def run(spark, sf_dir):
        apply_conf(spark)
        t = tables(spark, sf_dir)
        f = agent_events.agent_events_bu if by_unit else agent_events.agent_events_all
        return f(t.status, t.cdr, t.resources, t.acw, t.breaks, from_ts, to_ts, P.TZ)
    return run


def queries() -> dict[str, Query]:
    from dialtone.catalog.op_queries import spark_queries
    return {**_reports(), **spark_queries()}


def _reports() -> dict[str, Query]:
    return {
        "hourly_call_summary": _hourly(None),
        "hourly_call_summary_bu": _hourly(P.B_UNIT),
        "hourly_call_summary_w_hour": _hourly_w_hour(None),
        "hourly_call_summary_w_hour_bu": _hourly_w_hour(P.B_UNIT),
        "call_performance": _call_performance(P.FROM_TS, P.TO_TS),
        "call_performance_mid": _call_performance(P.MID_FROM_TS, P.MID_TO_TS),
        "agent_productivity": _agent(P.FROM_TS, P.TO_TS),
        "agent_productivity_mid_bu": _agent(P.MID_FROM_TS, P.MID_TO_TS, b_unit=P.B_UNIT),
        "agent_productivity_agent": _agent(P.FROM_TS, P.TO_TS, resource_id=P.AGENT),
        "agent_productivity_all": _agent_all(P.FROM_TS, P.TO_TS, False),
        "agent_productivity_all_mid": _agent_all(P.MID_FROM_TS, P.MID_TO_TS, False),
        "agent_productivity_bu": _agent_all(P.FROM_TS, P.TO_TS, True),
        "agent_productivity_bu_mid": _agent_all(P.MID_FROM_TS, P.MID_TO_TS, True),
        "agent_events_all": _events(P.FROM_TS, P.TO_TS, False),
        "agent_events_all_mid": _events(P.MID_FROM_TS, P.MID_TO_TS, False),
        "agent_events_bu": _events(P.FROM_TS, P.TO_TS, True),
        "agent_events_bu_mid": _events(P.MID_FROM_TS, P.MID_TO_TS, True),
    }
