"""Column expressions shared by the reports (all JVM-side, no UDFs)."""

from dialtone.functions.fmt import hms, int_div, pct_int, round_avg_to_long
from dialtone.functions.timefx import (
    DEFAULT_TZ, local_date, local_hour, local_ts, ts_literal, utc_date, date_bounds,
)

__all__ = [
    "hms", "int_div", "pct_int", "round_avg_to_long", "DEFAULT_TZ", "local_date", "local_hour",
    "local_ts", "ts_literal", "utc_date", "date_bounds",
]
