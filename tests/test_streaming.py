import datetime as dt

import pytest
from pyspark.sql import functions as F

from dialtone.catalog.queries import queries
from dialtone.operators.counters import published
from dialtone.sources import dims
from dialtone.sources.fixtures import dialer_event_stream
from dialtone.streaming.counters import (counter_table, current_counters, dashboard, merge_counters, start_counters)
from conftest import SMOKE_DIR

COLUMNS = ["day", "window_name", "total_count", "current_count"]


def _rows(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def _run(spark, src, sink, ckpt, lateness="10000 days", **options):
    query = start_counters(dialer_event_stream(spark, src, **options.pop("source", {})), sink, ckpt, lateness=lateness, **options)
    query.awaitTermination(300)
    if query.exception():
        raise query.exception()


def test_all_days_and_restart(spark, tmp_path):
    events = spark.read.parquet(f"{SMOKE_DIR}/events.parquet")
    halfway = events.agg(F.percentile_approx("event_id", 0.5)).first()[0]
    src, sink, ckpt = (str(tmp_path / x) for x in ("events", "counters", "checkpoint"))
    events.filter(F.col("event_id") <= halfway).coalesce(1).write.parquet(src)
    _run(spark, src, sink, ckpt)
    first = _rows(current_counters(spark, sink))
    # restarted without new events: nothing changes
    _run(spark, src, sink, ckpt)
    assert _rows(current_counters(spark, sink)) == first
    # the rest arrives, late days among it; a new driver goes on from the checkpoint
    events.filter(F.col("event_id") > halfway).coalesce(1).write.mode("append").parquet(src)
    _run(spark, src, sink, ckpt)
    batch = queries()["event_counters_by_day"](spark, SMOKE_DIR)
    assert _rows(current_counters(spark, sink)) == _rows(batch) != first
    want = published(batch, dims.publish_meta(spark), ["day"])
    assert sorted(map(tuple, dashboard(spark, sink).collect())) == sorted(map(tuple, want.collect()))
    # a new checkpoint starts again with batch 0 and counts from the beginning: the same counters, not older ones
    _run(spark, src, sink, str(tmp_path / "checkpoint2"))
    assert _rows(current_counters(spark, sink)) == _rows(batch)
    # the stream that it replaced can't write any more
    events.limit(1).write.mode("append").parquet(src)
    with pytest.raises(Exception, match="newer checkpoint"):
        _run(spark, src, sink, ckpt)


def _write_events(spark, src, hours, first_id):
    rows = [(first_id + k, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), 1, "view") for k, h in enumerate(hours)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string").withColumns(
        {"value": F.lit(0.0), "props": F.lit("")}).coalesce(1).write.mode("append").parquet(src)


def test_late_events_count_until_the_watermark_has_passed(spark, tmp_path):
    src, sink, ckpt = (str(tmp_path / x) for x in ("events", "counters", "checkpoint"))

    def total(day):
        return {(r.day.day): r.total_count for r in current_counters(spark, sink).collect()}.get(day)

    _write_events(spark, src, [1, 2, 30], 0)  # two events of the 1st, one of the 2nd
    _run(spark, src, sink, ckpt, lateness="12 hours")
    assert (total(1), total(2)) == (2, 1)
    _write_events(spark, src, [3, 35], 10)  # the 1st is open: 06:00 of the 2nd less 12 hours lies within it
    _run(spark, src, sink, ckpt, lateness="12 hours")
    assert (total(1), total(2)) == (3, 2)
    _write_events(spark, src, [90], 20)  # the 4th: the 1st to 3rd are closed now
    _run(spark, src, sink, ckpt, lateness="12 hours")
    _write_events(spark, src, [4, 31, 91], 30)
    _run(spark, src, sink, ckpt, lateness="12 hours")
    assert (total(1), total(2), total(4)) == (3, 2, 2)  # kept as they were closed, though their state is gone


def test_batches_merge_once_and_folders_are_cleaned(spark, tmp_path):
    table = counter_table(spark, str(tmp_path))
    day = [dt.date(2024, 1, k) for k in (1, 2, 9)]
    frame = lambda rows: spark.createDataFrame(rows, "day date, window_name string, total_count long, current_count long")
    assert merge_counters(table, frame([(day[0], "A", 1, 1), (day[0], "B", 1, 1), (day[1], "A", 5, 5)]), "s", 0)
    assert merge_counters(table, frame([(day[0], "A", 2, 0), (day[2], "A", 1, 1)]), "s", 1)
    want = [(day[0], "A", 2, 0), (day[0], "B", 1, 1), (day[1], "A", 5, 5), (day[2], "A", 1, 1)]
    assert _rows(table.read()) == want
    assert not merge_counters(table, frame([(day[0], "A", 99, 99)]), "s", 1)  # the batch runs again
    assert merge_counters(table, frame([]), "s", 2)
    assert _rows(table.read()) == want
    for k in range(3, 8):
        merge_counters(table, frame([(day[1], "A", k, k)]), "s", k)
    folders = len(list(tmp_path.glob("data/day=*/write=*")))
    assert table.clean(keep=1) == folders - 3 and len(list(tmp_path.glob("data/day=*/write=*"))) == 3
    assert len(list(tmp_path.glob("commits/*.json"))) == 1
    assert _rows(table.read())[2] == (day[1], "A", 7, 7)
    assert merge_counters(table, frame([(day[0], "A", 1, 1)]), "t", 0)  # a new stream's batch 0 counts
    assert _rows(table.read())[0] == (day[0], "A", 1, 1)


def test_stream_cleans_as_it_goes(spark, tmp_path):
    src, sink, ckpt = (str(tmp_path / x) for x in ("events", "counters", "checkpoint"))
    for k in range(4):
        _write_events(spark, src, [k, k + 24], 10 * k)
    _run(spark, src, sink, ckpt, clean_every=2, source={"max_files_per_trigger": 1})
    assert _rows(current_counters(spark, sink)) == [(dt.date(2024, 1, d), "CAMPAIGNDIALING", 4, 4) for d in (1, 2)]
    assert len(list((tmp_path / "counters").glob("data/day=*/write=*"))) <= 8
