"""Call-centre tables derived from the generic test tables.

The test data has no call tables, so each one is derived from ``events``,
``supplier``, ``nation``, ``region``, ``customer`` and ``part`` with integer
arithmetic. The SQL text below is shared verbatim with the DuckDB oracle
(``catalog.oracle``), so both engines see identical inputs. Only
``daily`` differs in form: Spark expands the eleven summary windows with
an ``inline`` generator instead of joining a constant table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from dialtone import schemas
from dialtone.sources.tables import conform, read_table

RAW_TABLES = ("events", "supplier", "nation", "region", "customer", "part")

FIXTURE_SQL: dict[str, str] = {
    "cdr": """
select 'u' || cast(event_id as string) as uuid, ts as created_time,
  cast(1 + user_id % 2 as int) as tenant_id, cast(1 + user_id % 3 as int) as company_id,
  case when user_id % 10 = 9 then null else 'BU' || cast(user_id % 4 as string) end as business_unit,
  case when event_id % 3 = 0 then 'outbound' else 'inbound' end as direction,
  case when event_id % 11 = 0 then 'PRIVATE_USER' when event_id % 3 = 0 then 'GATEWAY' else 'HTTAPI' end as obj_type,
  'skill' || cast(event_id % 4 as string) as agent_skill,
  (event_id % 3 <> 0 and event_type <> 'error') as is_queued,
  (event_id % 3 <> 0 and event_type in ('click', 'purchase')) as agent_answered,
  (event_type in ('click', 'purchase', 'signup')) as is_answered,
  cast((event_id * 7) % 40 as int) as queue_sec,
  cast(case when event_id % 4 = 0 then (event_id * 13) % 90 else 0 end as int) as hold_sec,
  cast((event_id * 31) % 600 as int) as bill_sec,
  cast((event_id * 17) % 45 as int) as answer_sec,
  cast((event_id * 19) % 60 as int) as ivr_connect_sec,
  'Supplier#' || lpad(cast(user_id as string), 9, '0') as received_by,
  'Supplier#' || lpad(cast((user_id * 7) % 150 as string), 9, '0') as sip_from_user
from events""",
    "resources": """
select cast(s_suppkey as int) as resource_id, s_name as resource_name, 1 as tenant_id,
  cast(1 + s_suppkey % 2 as int) as company_id from supplier""",
    "status": """
select case when event_id % 97 <> 13 then cast(user_id % 50 as int) end as resource_id, ts as created_at,
  case event_type when 'signup' then 'Register' when 'error' then 'UnRegister' when 'click' then 'Inbound' when 'view' then 'endInbound'
    else case when event_id % 2 = 0 then 'Outbound' else 'endOutbound' end end as reason,
  cast(1 + user_id % 2 as int) as tenant_id, cast(1 + (user_id % 50) % 3 as int) as company_id,
  'BU' || cast(user_id % 4 as string) as business_unit
from events""",
    "daily": """
select cast(ts as date) as summary_date, cast(1 + user_id % 2 as string) as tenant, cast(1 + user_id % 3 as string) as company,
  'BU' || cast(user_id % 4 as string) as business_unit, w.window_name, cast(user_id % 50 as string) as param1, w.param2,
  cast(1 + (event_id * w.k) % 5 as int) as total_count,
  cast((event_id * w.k * 37) % 3600 + case when w.window_name = 'LOGIN' then 20000 else 0 end as int) as total_time,
  cast((event_id * w.k * 37) % 900 as int) as max_time
from events cross join (values ('LOGIN', 'Register', 1), ('INBOUND', 'Inbound', 2), ('OUTBOUND', 'Outbound', 3),
  ('CONNECTED', 'CALLinbound', 5), ('CONNECTED', 'CALLoutbound', 7), ('AGENTHOLD', 'inbound', 11), ('AGENTHOLD', 'outbound', 13),
  ('AFTERWORK', 'AfterWorkCALLinbound', 17), ('AFTERWORK', 'AfterWorkCALLoutbound', 19), ('BREAK', 'Break', 23),
  ('DIALED', 'DialedOutbound', 29)) as w(window_name, param2, k)
where w.window_name = 'LOGIN' or (event_id + w.k) % 3 <> 0""",
    "acw": """
select cast(user_id % 50 as int) as resource_id, 'u' || cast(event_id as string) as session_id, ts as created_at,
  cast((event_id * 23) % 120 as int) as duration from events where event_id % 2 = 0""",
    "breaks": """
select cast(user_id % 50 as int) as resource_id, ts as created_at,
  case when event_id % 5 = 0 then 'ResourceStatus' else 'SlotStatus' end as status_type,
  case when event_id % 2 = 0 then 'NotAvailable' else 'Available' end as status,
  cast((event_id * 29) % 1800 as int) as duration from events""",
    "business_units": """
select n_nationkey as id, 'BU' || cast(n_nationkey % 4 as string) as bu_id, n_name as unit_name, n_regionkey as attribute_id, n_nationkey % 7 as attribute_group_id,
  cast(1 + n_nationkey % 2 as int) as tenant_id, cast(1 + n_nationkey % 3 as int) as company_id, case when n_nationkey % 11 = 3 then null else timestamp '2024-01-01 00:00:00' end as created_at, timestamp '2024-01-02 00:00:00' as updated_at from nation""",
    "user_groups": """
select n_nationkey as id, 'G' || cast(n_nationkey % 6 as string) as group_id, n_name as group_name, n_regionkey as attribute_id, n_nationkey % 7 as attribute_group_id,
  cast(1 + n_nationkey % 3 as int) as company_id, cast(1 + n_nationkey % 2 as int) as tenant_id, case when n_nationkey % 11 = 3 then null else timestamp '2024-01-01 00:00:00' end as created_at, timestamp '2024-01-02 00:00:00' as updated_at from nation""",
    "attributes": """
select r_regionkey as attribute_id, r_name as attribute_name from region where r_regionkey < 4""",
    "attribute_groups": """
select distinct n_regionkey + 1 as attribute_group_id from nation""",
    "campaigns": """
select cast(p_partkey as int) as campaign_id, p_type as campaign_name from part where p_partkey < 4""",
    "contact_numbers": """
select c_custkey as contact_number_id, 'ext' || cast(c_custkey % 40 as string) as external_user_id, cast(c_custkey % 5 as int) as campaign_id,
  c_custkey % 2 = 0 as status, cast(1 + c_nationkey % 2 as int) as tenant_id, cast(1 + c_nationkey % 3 as int) as company_id,
  'batch' || cast(c_custkey % 12 as string) as batch_no, c_mktsegment as preview_data,
  case c_custkey % 3 when 0 then 'added' when 1 then 'dialing' else 'completed' end as dialer_status,
  timestamp '2024-01-01 00:00:00' as created_at,
  case when c_custkey % 13 = 5 then null else timestamp '2024-01-02 00:00:00' end as updated_at,
  case when c_custkey % 9 = 0 then null else cast(c_custkey % 3 as int) end as cam_schedule_id from customer""",
    "counter_events": """
select event_id, ts, 'DIALER' as event_class, 'CAMPAIGN' as event_type,
  case event_type when 'view' then 'DIALING' when 'click' then 'DISCONNECTING' when 'signup' then 'CONNECTED' when 'error' then 'DISCONNECTED'
    else case when event_id % 2 = 0 then 'NUMBERADDED' else 'REJECTED' end end as event_category from events""",
}

# The daily fixture for Spark: the same rows as FIXTURE_SQL["daily"], with the
# eleven (window, param2, k) triples expanded per event by a generator.
_DAILY_SPARK = """
select cast(ts as date) as summary_date, cast(1 + user_id % 2 as string) as tenant, cast(1 + user_id % 3 as string) as company,
  'BU' || cast(user_id % 4 as string) as business_unit, w.window_name, cast(user_id % 50 as string) as param1, w.param2,
  cast(1 + (event_id * w.k) % 5 as int) as total_count,
  cast((event_id * w.k * 37) % 3600 + case when w.window_name = 'LOGIN' then 20000 else 0 end as int) as total_time,
  cast((event_id * w.k * 37) % 900 as int) as max_time
from (
  select event_id, ts, user_id, inline(array(
    named_struct('window_name', 'LOGIN', 'param2', 'Register', 'k', 1),
    named_struct('window_name', 'INBOUND', 'param2', 'Inbound', 'k', 2),
    named_struct('window_name', 'OUTBOUND', 'param2', 'Outbound', 'k', 3),
    named_struct('window_name', 'CONNECTED', 'param2', 'CALLinbound', 'k', 5),
    named_struct('window_name', 'CONNECTED', 'param2', 'CALLoutbound', 'k', 7),
    named_struct('window_name', 'AGENTHOLD', 'param2', 'inbound', 'k', 11),
    named_struct('window_name', 'AGENTHOLD', 'param2', 'outbound', 'k', 13),
    named_struct('window_name', 'AFTERWORK', 'param2', 'AfterWorkCALLinbound', 'k', 17),
    named_struct('window_name', 'AFTERWORK', 'param2', 'AfterWorkCALLoutbound', 'k', 19),
    named_struct('window_name', 'BREAK', 'param2', 'Break', 'k', 23),
    named_struct('window_name', 'DIALED', 'param2', 'DialedOutbound', 'k', 29)))
  from {events}
) w
where w.window_name = 'LOGIN' or (event_id + w.k) % 3 <> 0"""

# which raw tables each fixture reads
_SOURCES = {
    "cdr": ("events",), "status": ("events",), "daily": ("events",), "acw": ("events",),
    "breaks": ("events",), "counter_events": ("events",), "resources": ("supplier",),
    "business_units": ("nation",), "user_groups": ("nation",), "attributes": ("region",),
    "attribute_groups": ("nation",), "campaigns": ("part",),
    "contact_numbers": ("customer",),
}


def fixture(spark: SparkSession, sf_dir: str, name: str,
            raw_tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """One derived table as a lazy DataFrame conforming to ``schemas.ALL[name]``."""
    raw_tables = raw_tables if raw_tables is not None else {}
    for t in _SOURCES[name]:
        if t not in raw_tables:
            raw_tables[t] = read_table(spark, sf_dir, t)
    raw = {t: raw_tables[t] for t in _SOURCES[name]}
    if name == "daily":
        df = spark.sql(_DAILY_SPARK, events=raw["events"])
    else:
        text = FIXTURE_SQL[name]
        for t in raw:
            text = text.replace(f"from {t}", "from {" + t + "}")
        df = spark.sql(text, **raw)
    return conform(df, schemas.ALL[name])


def dialer_event_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of ``counter_events`` derived from parquet files of ``events`` that arrive under ``path``."""
    reader = spark.readStream.schema(
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string").format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    text = FIXTURE_SQL["counter_events"].replace("from events", "from {events}")
    return conform(spark.sql(text, events=reader.load(path)), schemas.COUNTER_EVENTS)


@dataclass
class Tables:
    """The call-centre tables of one data directory, as lazy DataFrames.

    Each table is defined once per ``Tables`` object and the same
    DataFrame is reused wherever a report reads it (no re-parsing); the
    raw tables they derive from are read once, so every derived table of
    one report shares a single scan of ``events``.
    """

    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict)
    _raw: dict = field(default_factory=dict)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in _SOURCES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = fixture(self.spark, self.sf_dir, name, self._raw)
        return self._cache[name]


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)
