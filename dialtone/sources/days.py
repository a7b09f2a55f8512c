"""Tables stored by day, of which a range of days is replaced at once.

Every write puts its rows into folders of its own, ``<day>=../write=<id>``, that
no reader looks into yet. A commit is a small file that names, for every day, the
write that holds it; readers follow the latest whole commit. So a write that
fails halfway leaves the table as it was, days that have no rows any more vanish
at the same moment as new ones appear, and the rows are computed once: which days
were written is read from the folders. Readers open the folders of the days that
they need, and a filter on the day prunes the rest.

One writer at a time: of two that commit the same number the second fails.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialtone.sources import files


@dataclass(frozen=True)
class DayTable:
    """A table under ``path`` with ``schema``, of which ``day`` is the date column that it is stored by."""

    spark: SparkSession
    path: str
    schema: T.StructType
    day: str

    def _commits(self) -> list[str]:
        return [x for x in files.names(self.spark, f"{self.path}/commits") if x.endswith(".json")]

    def _state(self) -> dict:
        """The latest whole commit: days (text -> write) and the writer's note."""
        for name in reversed(self._commits()):
            try:
                return json.loads(files.read_text(self.spark, f"{self.path}/commits/{name}"))
            except ValueError:  # its writer broke off
                continue
        return {"days": {}, "note": {}}

    def days(self) -> list[dt.date]:
        return sorted(dt.date.fromisoformat(x) for x in self._state()["days"])

    def note(self) -> dict:
        """What the writer of the latest commit noted."""
        return self._state()["note"]

    def read(self, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """The rows of the days ``first`` .. ``last``, by default of all days."""
        return self._rows({d: w for d, w in self._state()["days"].items()
                           if (first is None or d >= first.isoformat()) and (last is None or d <= last.isoformat())})

    def read_days(self, days: list[dt.date]) -> DataFrame:
        wanted = {d.isoformat() for d in days}
        return self._rows({d: w for d, w in self._state()["days"].items() if d in wanted})

    def _rows(self, chosen: dict) -> DataFrame:
        if not chosen:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.path}/data/{self.day}={d}/write={w}" for d, w in sorted(chosen.items())]
        whole = T.StructType([*self.schema.fields, T.StructField("write", T.StringType())])
        return (self.spark.read.schema(whole).option("basePath", f"{self.path}/data").parquet(*paths)
                .select(*self.schema.fieldNames()))

    def replace(self, rows: DataFrame, first: dt.date, last: dt.date, note: dict | None = None) -> list[dt.date]:
        """Let ``rows`` be the table's rows of ``first`` .. ``last``; returns the days that have any.

        Rows of other days, or of none, are left out. Rows are rebalanced by day:
        small days share a task, and Spark splits a large one over several.
        """
        inside = rows.filter(F.col(self.day).between(F.lit(first), F.lit(last)))
        return self._replace(inside, lambda d: first.isoformat() <= d <= last.isoformat(), note)

    def replace_days(self, rows: DataFrame, days: list[dt.date], note: dict | None = None) -> list[dt.date]:
        """As :meth:`replace`, for single days."""
        wanted = {d.isoformat() for d in days}
        return self._replace(rows.filter(F.col(self.day).isin(list(days))), lambda d: d in wanted, note)

    def _replace(self, rows: DataFrame, replaced, note: dict | None) -> list[dt.date]:
        write = uuid4().hex
        (rows.select(*self.schema.fieldNames()).hint("rebalance", self.day).withColumn("write", F.lit(write))
         .write.mode("append").partitionBy(self.day, "write").parquet(f"{self.path}/data"))
        found = files.matches(self.spark, f"{self.path}/data/{self.day}=*/write={write}")
        written = [x.split(f"/{self.day}=")[-1].split("/")[0] for x in found]
        state = self._state()
        kept = {d: w for d, w in state["days"].items() if not replaced(d)}
        self._commit({**kept, **{d: write for d in written}}, state["note"] if note is None else note)
        return [dt.date.fromisoformat(d) for d in sorted(written)]

    def _commit(self, days: dict, note: dict) -> None:
        last = self._commits()
        number = int(last[-1].split(".")[0]) + 1 if last else 0
        files.create_text(self.spark, f"{self.path}/commits/{number:012d}.json",
                          json.dumps({"days": days, "note": note}, sort_keys=True))

    def clean(self, keep: int = 2) -> int:
        """Delete what none of the last ``keep`` commits names; returns the number of folders that went.

        Don't run it beside a writer, nor while a reader still uses an older commit.
        """
        commits = self._commits()
        live = set()
        for name in commits[-keep:]:
            try:
                live.update(json.loads(files.read_text(self.spark, f"{self.path}/commits/{name}"))["days"].items())
            except ValueError:
                continue
        gone = 0
        for folder in files.matches(self.spark, f"{self.path}/data/{self.day}=*/write=*"):
            day, write = folder.rsplit("/", 2)[1].split("=")[1], folder.rsplit("=", 1)[1]
            if (day, write) not in live:
                files.remove(self.spark, folder)
                gone += 1
        for name in commits[:-keep]:
            files.remove(self.spark, f"{self.path}/commits/{name}")
        return gone
