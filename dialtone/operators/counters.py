"""Dashboard event counters: rules map events to +1/-1 on a counter window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MATCH = ["event_class", "event_type", "event_category"]


def counter_deltas(events: DataFrame, rules: DataFrame) -> DataFrame:
    """Each event matched to its rule(s): ``window_name`` and ``count`` (+1/-1).

    Spark broadcasts the rule table if its size allows; events without a
    rule are dropped (inner join).
    """
    r = rules.select(*_MATCH, "window_name", "count")
    return events.join(r, on=_MATCH, how="inner")


def counter_totals(deltas: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per window: ``total_count`` (events that add) and ``current_count`` (net sum)."""
    keys = (keys or []) + ["window_name"]
    return deltas.groupBy(*keys).agg(
        F.sum(F.when(F.col("count") > 0, F.col("count")).otherwise(0)).cast("bigint")
        .alias("total_count"),
        F.sum("count").cast("bigint").alias("current_count"))


def published(totals: DataFrame, publish: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The values each window publishes: (window_name, event_name, value)."""
    keys = keys or []
    j = totals.join(publish, on="window_name", how="inner")
    value = F.when(F.col("event_name") == "TotalCount", F.col("total_count")) \
        .when(F.col("event_name") == "CurrentCount", F.col("current_count"))
    return j.select(*keys, "window_name", "event_name", value.alias("value"))


def event_counters(events: DataFrame, rules: DataFrame, publish: DataFrame) -> DataFrame:
    """Batch form of the live counters: published value per window and event name."""
    return published(counter_totals(counter_deltas(events, rules)), publish)
