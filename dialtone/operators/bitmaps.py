"""Distinct agents as bitmaps, exact and mergeable over days, units and tenants.

Distinct counts of days can't be added up to those of a week; their bitmaps can
be joined. Agents get dense numbers from a dictionary that only grows. A bitmap
holds 32,768 numbers in 4 KB, so that a row is never larger, whatever the number
of agents: more agents make more rows, told apart by ``bucket``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialtone.functions.timefx import DEFAULT_TZ, local_date
from dialtone.operators.cdr import within
from dialtone.operators.index import ordered_index

c = F.col
DAY_KEYS = ["date", "tenant", "company", "bu"]


def agent_roles(cdr: DataFrame, from_ts, to_ts, tz: str = DEFAULT_TZ) -> DataFrame:
    """DAY_KEYS, ``way`` (in, out) and ``agent``: who answered calls on each local day, each once."""
    legs = within(cdr, "created_time", from_ts, to_ts, inclusive_end=True).filter(c("is_answered"))
    inbound = (c("direction") == "inbound") & (c("obj_type") == "HTTAPI")
    outbound = (c("direction") == "outbound") & (c("obj_type") != "PRIVATE_USER")
    named = legs.filter(inbound | outbound).select(
        local_date("created_time", tz).alias("date"), c("tenant_id").alias("tenant"), c("company_id").alias("company"),
        c("business_unit").alias("bu"), F.when(inbound, "in").otherwise("out").alias("way"),
        F.when(inbound, c("received_by")).otherwise(c("sip_from_user")).alias("agent"))
    return named.filter(c("agent").isNotNull()).distinct()


def agent_numbers(roles: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(agent, number): numbers 1, 2, ... of all agents; those of ``known`` keep theirs."""
    names = roles.select("agent").distinct()
    if known is None:
        return ordered_index(names, ["agent"], "number").select("agent", "number")
    top = known.agg(F.coalesce(F.max("number"), F.lit(0)).alias("top")).scalar()
    fresh = ordered_index(names.join(known, "agent", "left_anti"), ["agent"], "number")
    return known.select("agent", "number").unionByName(fresh.select("agent", (c("number") + top).cast("int").alias("number")))


def agent_bitmaps(roles: DataFrame, numbers: DataFrame) -> DataFrame:
    """DAY_KEYS, ``way``, ``bucket``, ``agents``: a bitmap of the agents' numbers."""
    number = c("number").cast("long")
    return (roles.join(numbers, "agent").groupBy(*DAY_KEYS, "way", F.bitmap_bucket_number(number).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("agents")))


def merge_bitmaps(bitmaps: DataFrame, keys: list) -> DataFrame:
    """Bitmaps of larger groups: ``keys`` (names or columns), ``way``, ``bucket``, ``agents``."""
    return bitmaps.groupBy(*keys, "way", "bucket").agg(F.bitmap_or_agg("agents").alias("agents"))


def count_agents(bitmaps: DataFrame, keys: list) -> DataFrame:
    """``keys``, ``in_agents``, ``out_agents``: distinct agents of each group and way."""
    merged = merge_bitmaps(bitmaps, keys)
    names = [x for x in merged.columns if x not in ("way", "bucket", "agents")]
    n = F.bitmap_count("agents")
    return merged.groupBy(*names).agg(*[
        F.coalesce(F.sum(F.when(c("way") == w, n)), F.lit(0)).cast("bigint").alias(f"{w}_agents") for w in ("in", "out")])
