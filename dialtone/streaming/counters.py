"""Live dashboard counters with Structured Streaming.

Dialer events come from any streaming source with the ``counter_events``
columns. Each event is matched to its counter rule in a stream-static join and
added to its window's counters per UTC day. Counters are emitted in update mode,
so the current day shows as it grows; the watermark bounds the state, a day's
counters being final once events are more than ``lateness`` past it.

The counters are kept in a table stored by day (``sources.days``). Every batch
merges the counters that changed into their days and commits these days at once,
with its number and the stream's identity:

* a batch that runs again is known by its number and changes nothing;
* a stream with a new checkpoint counts from its source's beginning. It has an
  identity of its own, whatever its batch numbers are; its counters replace the
  older ones as they come, and a stream that has been replaced can't write any more;
* replaced folders are deleted every ``clean_every`` batches.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dialtone import schemas
from dialtone.operators.counters import counter_deltas, published
from dialtone.sources import dims, files
from dialtone.sources.days import DayTable


def live_counters(events: DataFrame, rules: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Per UTC day and counter window: ``total_count`` and ``current_count``.

    ``ts`` is a UTC wall-clock ``timestamp_ntz``; watermarks need an
    instant, so ``event_time`` reads it as UTC (the session zone is pinned
    to UTC). The day window is a tumbling ``window(event_time, '1 day')``
    so the watermark can retire old days.
    """
    timed = events.withColumn("event_time", F.col("ts").cast("timestamp"))
    deltas = counter_deltas(timed.withWatermark("event_time", lateness), rules)
    agg = deltas.groupBy(F.window("event_time", "1 day").alias("w"), "window_name").agg(
        F.sum(F.when(F.col("count") > 0, F.col("count")).otherwise(0)).cast("bigint").alias("total_count"),
        F.sum("count").cast("bigint").alias("current_count"))
    return agg.select(F.to_date(F.col("w.start")).alias("day"), "window_name", "total_count",
                      "current_count")


def counter_table(spark: SparkSession, path: str) -> DayTable:
    return DayTable(spark, path, schemas.COUNTERS, "day")


def stream_identity(spark: SparkSession, checkpoint_location: str) -> str:
    """The identity of the stream that this checkpoint belongs to, made when it is first asked for."""
    marker = f"{checkpoint_location}/counters-identity"
    if not files.matches(spark, marker):
        files.create_text(spark, marker, uuid4().hex)
    return files.read_text(spark, marker)


def merge_counters(table: DayTable, changed: DataFrame, stream: str, batch: int) -> bool:
    """Put the changed counters in the place of older ones; False if this batch was merged before.

    ``changed`` has a row for each day and window at most. Days that it doesn't
    name aren't read or written.
    """
    note = table.note()
    streams = note.get("streams", [])
    if stream in streams[:-1]:
        raise RuntimeError("a stream with a newer checkpoint keeps these counters")
    if streams[-1:] == [stream] and batch <= note["batch"]:
        return False
    days = sorted(r["day"] for r in changed.select("day").distinct().collect())  # days of one batch
    note = {"streams": streams if streams[-1:] == [stream] else [*streams, stream], "batch": batch}
    if days:
        kept = table.read_days(days).join(changed.select("day", "window_name"), ["day", "window_name"], "left_anti")
        table.replace_days(kept.unionByName(changed.select(*kept.columns)), days, note)
    return True


def start_counters(events: DataFrame, path: str, checkpoint_location: str, available_now: bool = True,
                   lateness: str = "1 hour", clean_every: int = 50) -> StreamingQuery:
    """Keep the counter table at ``path`` up to date with the stream ``events``.

    ``checkpoint_location`` is this stream's own folder in a store that every
    driver that may run it can reach; a restart goes on from there.
    """
    spark = events.sparkSession
    out = live_counters(events, dims.counter_rules(spark), lateness)
    table, stream = counter_table(spark, path), stream_identity(spark, checkpoint_location)

    def write(changed: DataFrame, batch: int) -> None:
        changed = changed.persist()
        try:
            if merge_counters(table, changed, stream, batch) and batch % clean_every == clean_every - 1:
                table.clean()
        finally:
            changed.unpersist()

    writer = out.writeStream.outputMode("update").option("checkpointLocation", checkpoint_location).foreachBatch(write)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def current_counters(spark: SparkSession, path: str) -> DataFrame:
    """The counters of each day and window."""
    return counter_table(spark, path).read()


def dashboard(spark: SparkSession, path: str) -> DataFrame:
    """The values that each window publishes, per day: (day, window_name, event_name, value)."""
    return published(current_counters(spark, path), dims.publish_meta(spark), ["day"])
