"""SQL-text helpers for the DuckDB oracles."""

from __future__ import annotations

from dialtone.catalog.params import TZ_OFFSET_MINUTES
from dialtone.sources.fixtures import FIXTURE_SQL


def ctes(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    parts = [f"{n} AS ({FIXTURE_SQL[n].strip()})" for n in names]
    parts += [f"{n} AS ({body.strip()})" for n, body in (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n"


def ts(value: str) -> str:
    return f"TIMESTAMP '{value}'"


def local(expr: str) -> str:
    return f"({expr} + INTERVAL {TZ_OFFSET_MINUTES} MINUTE)"


def local_date(expr: str) -> str:
    return f"CAST({local(expr)} AS DATE)"


def local_hour(expr: str) -> str:
    return f"CAST(hour({local(expr)}) AS INTEGER)"


def _part(e: str) -> str:
    return f"(CASE WHEN ({e}) < 0 THEN '-' ELSE '' END || printf('%02d', abs({e})))"


def idiv(a: str, b: str) -> str:
    """Integer division truncating toward zero."""
    return f"(({a}) // ({b}))"


def hms(expr: str) -> str:
    e = f"CAST({expr} AS BIGINT)"
    return (f"(CASE WHEN {e} IS NULL THEN NULL ELSE {_part(idiv(e, '3600'))} || ':' || "
            f"{_part(idiv(f'{e} % 3600', '60'))} || ':' || {_part(f'{e} % 60')} END)")


def trunc_secs(expr: str) -> str:
    """numeric seconds -> whole seconds toward zero (what HH24:MI:SS shows)."""
    return f"CAST(trunc({expr}) AS BIGINT)"


def in_list(values: list[str]) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"
