"""Declared schemas of the tables the reports read and write.

Timestamps are ``timestamp_ntz`` holding UTC wall-clock time; local days
and hours are derived with an explicit zone (see ``functions.timefx``).
"""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType(),
    "timestamp": T.TimestampType(), "double": T.DoubleType(),
}


def _schema(spec: str) -> T.StructType:
    """``"name type, name type"`` -> StructType (built without a Spark session)."""
    fields = []
    for item in spec.split(","):
        name, type_name = item.split()
        fields.append(T.StructField(name, _TYPES[type_name], True))
    return T.StructType(fields)


# finished call legs (one row per leg)
CDR = _schema(
    "uuid string, created_time timestamp_ntz, tenant_id int, company_id int, business_unit string, "
    "direction string, obj_type string, agent_skill string, is_queued boolean, agent_answered boolean, "
    "is_answered boolean, queue_sec int, hold_sec int, bill_sec int, answer_sec int, ivr_connect_sec int, "
    "received_by string, sip_from_user string, queue_priority int")

# agents
RESOURCES = _schema("resource_id int, resource_name string, tenant_id int, company_id int")

# agent state changes
STATUS = _schema(
    "resource_id int, created_at timestamp_ntz, reason string, tenant_id int, company_id int, "
    "business_unit string")

# pre-aggregated daily agent activity; tenant/company/param1 are text in the source
DAILY = _schema(
    "summary_date date, tenant string, company string, business_unit string, window_name string, "
    "param1 string, param2 string, total_count int, total_time int, max_time int")

# after-call work and status durations
ACW = _schema("resource_id int, session_id string, created_at timestamp_ntz, duration int")
BREAKS = _schema(
    "resource_id int, created_at timestamp_ntz, status_type string, status string, duration int")

# dimensions used by the data checks
BUSINESS_UNITS = _schema(
    "id int, bu_id string, unit_name string, attribute_id int, attribute_group_id int, tenant_id int, "
    "company_id int, created_at timestamp_ntz, updated_at timestamp_ntz")
USER_GROUPS = _schema(
    "id int, group_id string, group_name string, attribute_id int, attribute_group_id int, company_id int, "
    "tenant_id int, created_at timestamp_ntz, updated_at timestamp_ntz")
ATTRIBUTES = _schema("attribute_id int, attribute_name string")
ATTRIBUTE_GROUPS = _schema("attribute_group_id int")
CAMPAIGNS = _schema("campaign_id int, campaign_name string")
CONTACT_NUMBERS = _schema(
    "contact_number_id bigint, external_user_id string, campaign_id int, status boolean, tenant_id int, "
    "company_id int, batch_no string, preview_data string, dialer_status string, created_at timestamp_ntz, "
    "updated_at timestamp_ntz, cam_schedule_id int")

# columns declared NOT NULL, and foreign keys as (child, column, parent, column, on delete)
NOT_NULL = {
    "business_units": ("id", "created_at", "updated_at"),
    "user_groups": ("id", "created_at", "updated_at"),
    "contact_numbers": ("contact_number_id", "created_at", "updated_at"),
}
FOREIGN_KEYS = (
    ("business_units", "attribute_id", "attributes", "attribute_id", "cascade"),
    ("business_units", "attribute_group_id", "attribute_groups", "attribute_group_id", "cascade"),
    ("user_groups", "attribute_id", "attributes", "attribute_id", "cascade"),
    ("user_groups", "attribute_group_id", "attribute_groups", "attribute_group_id", "cascade"),
    ("contact_numbers", "campaign_id", "campaigns", "campaign_id", "set null"),
)

# primary keys, which are never NULL and never repeat
PRIMARY_KEYS = {
    "business_units": "id", "user_groups": "id", "contact_numbers": "contact_number_id",
    "attributes": "attribute_id", "attribute_groups": "attribute_group_id", "campaigns": "campaign_id",
}

# columns that tables got after their first files were written
ADDED_COLUMNS = {
    "cdr": _schema("queue_priority int"),
    "contact_numbers": _schema("cam_schedule_id int"),
    "campaign_configurations": _schema("number_loading_method string, duplicate_num_timeout int"),
}

# the last event of an agent before a day boundary (sources.snapshots)
LAST_EVENTS = _schema(
    "resource_id int, tenant_id int, company_id int, business_unit string, last_at timestamp_ntz, as_of date")

# live dashboard counters (streaming.counters)
COUNTERS = _schema("day date, window_name string, total_count bigint, current_count bigint")

# stored agent productivity summary (fixed values: the column names and their order). The original stores averages
# as numeric and the login time with a zone; here averages are doubles of 4 decimals and times are UTC wall-clock
AGENT_SUMMARY = _schema(
    "summary_date date, tenant int, company int, bu string, agent int, login_max_time int, "
    "login_total_count bigint, login_total_time string, login_time timestamp_ntz, inbound_max_time int, "
    "inbound_total_count bigint, inbound_total_time string, outbound_max_time int, outbound_total_count bigint, "
    "outbound_total_time string, total_call_count bigint, total_call_time bigint, "
    "avg_inbound_call_count double, avg_outbound_call_count double, avg_inbound_call_time double, "
    "avg_outbound_call_time double, inbound_talk_max_time int, inbound_connected_total_count bigint, "
    "inbound_talk_total_time string, outbound_talk_max_time int, outbound_connected_total_count bigint, "
    "outbound_talk_total_time string, connected_total_count bigint, total_talk_total_time bigint, "
    "avg_inbound_talk_time string, avg_outbound_talk_time string, avg_inbound_handling_time string, "
    "avg_outbound_handling_time string, inbound_hold_max_time int, inbound_hold_total_count bigint, "
    "inbound_hold_total_time string, outbound_hold_max_time int, outbound_hold_total_count bigint, "
    "outbound_hold_total_time string, total_hold_total_count bigint, total_hold_total_time bigint, "
    "avg_inbound_hold_count double, avg_outbound_hold_count double, avg_inbound_hold_time string, "
    "avg_outbound_hold_time string, inbound_acw_max_time int, inbound_acw_total_count bigint, "
    "inbound_acw_total_time string, outbound_acw_max_time int, outbound_acw_total_count bigint, "
    "outbound_acw_total_time string, total_acw_total_count bigint, total_acw_total_time bigint, "
    "avg_inbound_acw_count double, avg_outbound_acw_count double, avg_inbound_acw_time double, "
    "avg_outbound_acw_time double, idle_time_inbound string, idle_time_outbound string, "
    "idle_time_offline string, total_break_time string, full_total_login_time string, "
    "full_total_inbound_time string, full_total_outbound_time string, full_total_inbound_idle_time string, "
    "full_total_outbound_idle_time string, full_total_offline_idle_time string, "
    "full_total_inbound_acw_time string, full_total_outbound_acw_time string, "
    "full_total_inbound_talk_time string, full_total_outbound_talk_time string, "
    "full_total_inbound_hold_time string, full_total_outbound_hold_time string, "
    "full_total_inbound_hold_count bigint, full_total_outbound_hold_count bigint, full_total_break_time string, "
    "full_total_connected_inbound_calls bigint, full_total_connected_outbound_calls bigint, "
    "full_total_inbound_calls bigint, full_total_outbound_calls bigint, full_avg_inbound_handling_time string, "
    "full_avg_outbound_handling_time string, full_avg_inbound_talk_time string, "
    "full_avg_outbound_talk_time string, full_avg_inbound_hold_time string, full_avg_outbound_hold_time string")

# dialer events feeding the dashboard counters
COUNTER_EVENTS = _schema(
    "event_id bigint, ts timestamp_ntz, event_class string, event_type string, event_category string")

HANGUP_CAUSES = _schema("itut_q850_code int, sip_equiv int, enumeration string, cause string")
# a user's own table also describes each cause
HANGUP_CAUSE_TABLE = T.StructType(
    [*HANGUP_CAUSES.fields, T.StructField("description", T.StringType())])

COUNTER_RULES = _schema(
    "event_class string, event_type string, event_category string, window_name string, count int, "
    "flush_enable boolean, use_session boolean, persist_session boolean, threshold_enable boolean, "
    "threshold_value int")

PUBLISH_META = _schema("window_name string, event_name string")

ALL = {
    "cdr": CDR, "resources": RESOURCES, "status": STATUS, "daily": DAILY, "acw": ACW,
    "breaks": BREAKS, "business_units": BUSINESS_UNITS, "user_groups": USER_GROUPS,
    "attributes": ATTRIBUTES, "attribute_groups": ATTRIBUTE_GROUPS, "campaigns": CAMPAIGNS,
    "contact_numbers": CONTACT_NUMBERS,
    "counter_events": COUNTER_EVENTS,
}
