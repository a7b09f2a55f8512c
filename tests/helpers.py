"""Hand-made rows for edge-case tests."""

import datetime as dt

from dialtone import schemas

T0 = dt.datetime(2024, 1, 5, 0, 0)


def cdr_row(**kw):
    base = dict(uuid="u1", created_time=T0 + dt.timedelta(hours=3, minutes=5), tenant_id=1,
                company_id=1, business_unit="BU1", direction="inbound", obj_type="HTTAPI",
                agent_skill="skill0", is_queued=True, agent_answered=True, is_answered=True,
                queue_sec=10, hold_sec=0, bill_sec=100, answer_sec=5, ivr_connect_sec=3,
                received_by="Supplier#000000001", sip_from_user="Supplier#000000002", queue_priority=None)
    base.update(kw)
    return tuple(base[f.name] for f in schemas.CDR.fields)


def cdr(spark, rows):
    return spark.createDataFrame(rows, schemas.CDR)


def status_row(resource_id, at, reason, tenant=1, company=1, unit="BU1"):
    return (resource_id, at, reason, tenant, company, unit)


def status(spark, rows):
    return spark.createDataFrame(rows, schemas.STATUS)


def daily_row(day, window, param2, total_count, total_time, max_time=0, tenant="1", company="1",
              unit="BU1", agent="6"):
    return (day, tenant, company, unit, window, agent, param2, total_count, total_time, max_time)


def daily(spark, rows):
    return spark.createDataFrame(rows, schemas.DAILY)
