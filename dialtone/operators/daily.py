"""Rollups of the daily agent summaries (``daily``), one pass for all windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


c = F.col

# Summary windows read by the agent reports, as
# short name -> (WindowName, Param2 or None when Param2 is not tested).
WINDOWS: dict[str, tuple[str, str | None]] = {
    "login": ("LOGIN", None),
    "inbound": ("INBOUND", None),
    "outbound": ("OUTBOUND", None),
    "in_conn": ("CONNECTED", "CALLinbound"),
    "out_conn": ("CONNECTED", "CALLoutbound"),
    "in_hold": ("AGENTHOLD", "inbound"),
    "out_hold": ("AGENTHOLD", "outbound"),
    "in_acw": ("AFTERWORK", "AfterWorkCALLinbound"),
    "out_acw": ("AFTERWORK", "AfterWorkCALLoutbound"),
    "brk": ("BREAK", None),
    "dialed": ("DIALED", "DialedOutbound"),
}


def _match_sql(name: str) -> str:
    window_name, param2 = WINDOWS[name]
    cond = f"window_name = '{window_name}'"
    if param2 is not None:
        cond += f" AND param2 = '{param2}'"
    return f"({cond})"


def window_index(windows: list[str]) -> str:
    """SQL: the position of the row's window in ``windows`` (windows are disjoint), else NULL."""
    whens = " ".join(f"WHEN {_match_sql(w)} THEN {i}" for i, w in enumerate(windows))
    return f"CASE {whens} END"


def window_rollup(daily: DataFrame, keys: list[str], windows: list[str], *,
                  weighted_avg_time: bool, driver: str = "login") -> DataFrame:
    """Per key group and window: ``{w}_m`` max, ``{w}_n`` count sum, ``{w}_t`` time sum,
    ``{w}_avg_n`` mean count, ``{w}_avg_t`` mean time.

    This is the pivot of one ``groupBy``: every window is a conditional
    aggregate, so ``daily`` is scanned and shuffled once (with map-side
    partial aggregation) instead of once per window. Each row's window is
    classified once (``_w``, a small integer); the aggregates then keep
    only max/sum/count buffers, and means are derived as sum / count. A
    window with no rows in a group is NULL in all five columns, as an
    unmatched left join. ``{w}_avg_t`` is ``avg(total_time)`` or, with
    ``weighted_avg_time``, ``sum(time) div coalesce(nullif(sum(count), 0), 1)``.

    ``_driver_rows`` counts the rows of the ``driver`` window. In the join
    form other windows attach to the driver rows by equality of every key,
    so a NULL key never matches: ``mask_null_keys`` applies that rule.
    """
    wanted = sorted({WINDOWS[w][0] for w in windows})
    rows = (daily.filter(c("window_name").isin(wanted))
            .selectExpr(*keys, f"{window_index(windows)} AS _w", "max_time", "total_count",
                        "total_time"))
    di = windows.index(driver)
    aggs = [F.expr(f"count_if(_w = {di}) AS _driver_rows")]
    for i, w in enumerate(windows):
        aggs += [F.expr(f"max(if(_w = {i}, max_time, NULL)) AS {w}_m"),
                 F.expr(f"sum(if(_w = {i}, total_count, NULL)) AS {w}_n"),
                 F.expr(f"sum(if(_w = {i}, total_time, NULL)) AS {w}_t"),
                 F.expr(f"count(if(_w = {i}, total_count, NULL)) AS {w}_cn")]
        if not weighted_avg_time:
            aggs.append(F.expr(f"count(if(_w = {i}, total_time, NULL)) AS {w}_ct"))
    out = rows.groupBy(*keys).agg(*aggs)
    derived = []
    for w in windows:
        derived.append(f"CAST({w}_n AS double) / nullif({w}_cn, 0) AS {w}_avg_n")
        if weighted_avg_time:
            derived.append(f"CASE WHEN {w}_t IS NOT NULL THEN {w}_t div coalesce(nullif({w}_n, 0), 1) "
                           f"END AS {w}_avg_t")
        else:
            derived.append(f"CAST({w}_t AS double) / nullif({w}_ct, 0) AS {w}_avg_t")
    drop = {f"{w}_cn" for w in windows} | {f"{w}_ct" for w in windows}
    return out.selectExpr(*[x for x in out.columns if x not in drop], *derived)


def mask_null_keys(df: DataFrame, keys: list[str], windows: list[str], driver: str = "login",
                   suffixes=("m", "n", "t", "avg_n", "avg_t")) -> DataFrame:
    """NULL the non-driver window columns of groups that have a NULL key."""
    ok = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    masked = {f"{w}_{s}" for w in windows if w != driver for s in suffixes}
    return df.selectExpr(*[f"CASE WHEN {ok} THEN `{n}` END AS `{n}`" if n in masked else f"`{n}`"
                           for n in df.columns])


def group_totals(df: DataFrame, keys: list[str], totals: dict[str, Column]) -> DataFrame:
    """Add per-group totals on every row, by an aggregate and a left join.

    A group with a NULL key gets NULL, as equality never matches it. The
    aggregate is combined before its shuffle, so a large group is not one task.
    """
    per = df.groupBy(*keys).agg(*[F.sum(e).alias(n) for n, e in totals.items()])
    return df.join(per, keys, "left").select(*df.columns, *totals)
