"""The last event of each agent at day boundaries, kept so that no run reads all history.

"Latest Register before a time" reads every status row ever written. A snapshot
holds, for a day boundary, the last event before it of each agent, tenant, company
and unit: one row each, however long the history. A later boundary is computed
from the one before and the days in between; a lookup reads one boundary and the
rows between it and the time asked for.

Boundaries should be taken of days that are closed: an event that arrives later
for a day before a boundary isn't in it. ``check`` compares a boundary with the
whole history.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialtone import schemas
from dialtone.functions.timefx import parse_ts
from dialtone.operators import sessions
from dialtone.operators.cdr import within
from dialtone.sources.days import DayTable

KEYS = ["resource_id", "tenant_id", "company_id", "business_unit"]


def _midnight(day: dt.date) -> dt.datetime:
    return dt.datetime.combine(day, dt.time(0))


def _latest(events: DataFrame) -> DataFrame:
    return events.groupBy(*KEYS).agg(F.max("last_at").alias("last_at"))


@dataclass(frozen=True)
class LastEvents:
    """Boundaries of the last ``reason`` events under ``path``."""

    spark: SparkSession
    path: str
    reason: str = "Register"

    def _table(self) -> DayTable:
        return DayTable(self.spark, self.path, schemas.LAST_EVENTS, "as_of")

    def _events(self, status: DataFrame, start: dt.date | None, end) -> DataFrame:
        """``reason`` events from the midnight of ``start`` (or ever) to just before ``end``."""
        rows = status.filter((F.col("reason") == self.reason) & F.col("resource_id").isNotNull())
        if start is None:
            rows = rows.filter(F.col("created_at") < F.lit(parse_ts(end).isoformat(sep=" ")).cast("timestamp_ntz"))
        else:
            rows = within(rows, "created_at", _midnight(start), end, inclusive_end=False)
        return rows.select(*KEYS, F.col("created_at").alias("last_at"))

    def boundaries(self) -> list[dt.date]:
        return self._table().days()

    def advance(self, status: DataFrame, day: dt.date) -> None:
        """Store the boundary at the beginning of ``day``, from the boundary before it."""
        table = self._table()
        known = [d for d in table.days() if d < day]
        events = self._events(status, known[-1] if known else None, _midnight(day))
        if known:
            events = table.read(known[-1], known[-1]).select(*KEYS, "last_at").unionByName(events)
        table.replace(_latest(events).withColumn("as_of", F.lit(day)), day, day)

    def last_before(self, status: DataFrame, before, extra: Column | None = None, name: str = "last_at") -> DataFrame:
        """(resource_id, ``name``): the latest event strictly before ``before``, as ``sessions.last_before``."""
        known = [d for d in self.boundaries() if _midnight(d) <= parse_ts(before)]
        if not known:
            return sessions.last_before(status, self.reason, before, extra=extra, name=name)
        stored = self._table().read().filter(F.col("as_of") == F.lit(known[-1])).select(*KEYS, "last_at")
        found = stored.unionByName(self._events(status, known[-1], before))
        if extra is not None:
            found = found.filter(extra)
        return found.groupBy("resource_id").agg(F.max("last_at").alias(name))

    def clean(self, keep: int = 2) -> int:
        """Delete replaced boundaries, as ``DayTable.clean``."""
        return self._table().clean(keep)

    def check(self, status: DataFrame, day: dt.date) -> DataFrame:
        """Rows of the boundary ``day`` that differ from the whole history: KEYS, ``stored_at``, ``last_at``."""
        stored = self._table().read(day, day).select(*KEYS, F.col("last_at").alias("stored_at"))
        real = _latest(self._events(status, None, _midnight(day)))
        both = stored.alias("s").join(real.alias("r"), [F.col(f"s.{k}").eqNullSafe(F.col(f"r.{k}")) for k in KEYS], "full")
        return both.filter(~F.col("stored_at").eqNullSafe(F.col("last_at"))).select(
            *[F.coalesce(f"s.{k}", f"r.{k}").alias(k) for k in KEYS], "stored_at", "last_at")
