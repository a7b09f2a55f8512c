"""Chat formatting with a loss mask, from a declarative template.

A conversation's turns go through a finite-state machine over roles, given as
a transition table; the output is one text per conversation and its segments,
each with a loss flag. All steps are DataFrame functions.

Escaping is reversible. In a text, an escape character is appended to every
escape character and to the first character of every mark, so no mark of the
template occurs inside an escaped text. In a role, the escape character and
the first characters of the marks become the escape character and a digit.

Defined cases: a null text is empty; a null role is empty and leads to the
``invalid`` state; rows without a conversation id are left out (they belong to
no conversation); turns with equal or null numbers are ordered by role, then
text, null numbers first; repeated rows are turns of their own; a conversation
that breaks the turn order is formatted all the same, with ``valid`` false. An
empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Marks around a turn, the roles whose text is learned, and the allowed turn order."""

    start: str = "<|im_start|>"
    role_end: str = "\n"
    end: str = "<|im_end|>"
    turn_end: str = "\n"
    escape: str = "\\"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: state -> {role: next state}; a role without an entry leads to "invalid".
    transitions: dict[str, dict[str, str]] = field(default_factory=lambda: {
        "begin": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user", "tool": "tool"},
        "tool": {"assistant": "assistant", "tool": "tool"},
    })
    accepting: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        marks = (self.start, self.end)
        if len(self.escape) != 1 or self.escape in self.start + self.end + self.role_end:
            raise ValueError("escape must be one character that no mark holds")
        if not self.role_end or min(map(len, marks)) < 2:
            raise ValueError("role_end can't be empty; start and end need two characters")
        for a in marks:
            for b in marks:
                if any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)) + (a != b))):
                    raise ValueError("a mark must not end with the beginning of a mark")

    def role_codes(self) -> list[tuple[str, str]]:
        """What stands for the characters that a role can't hold as they are."""
        first = dict.fromkeys([self.escape, self.role_end[0], self.start[0], self.end[0]])
        return [(c, f"{self.escape}{k}") for k, c in enumerate(first)]


def escape(text: Column, t: Template) -> Column:
    """Append the escape character to itself and to the first character of every mark."""
    marks = "|".join(_quoted(m) for m in (t.escape, t.start, t.end))
    return F.regexp_replace(text, F.lit(f"(?s)((?={marks}).)"),
                            F.lit("$1" + _quoted_replacement(t.escape)))


def unescape(text: Column, t: Template) -> Column:
    e = _quoted(t.escape)
    return F.regexp_replace(text, F.lit(f"{e}({e}?)"), F.lit("$1"))


def escape_role(role: Column, t: Template) -> Column:
    for c, code in t.role_codes():
        role = F.replace(role, F.lit(c), F.lit(code))
    return role


def unescape_role(role: Column, t: Template) -> Column:
    for c, code in reversed(t.role_codes()):
        role = F.replace(role, F.lit(code), F.lit(c))
    return role


def _quoted(literal: str) -> str:
    return "".join(c if c.isalnum() or c == "\n" else "\\" + c for c in literal)


def _quoted_replacement(literal: str) -> str:
    return re.sub(r"([\\$])", r"\\\1", literal)


def _next_state(t: Template, state: Column, role: Column) -> Column:
    out = None
    for name, moves in t.transitions.items():
        for by, to in moves.items():
            hit = (state == F.lit(name)) & (role == F.lit(by))
            out = F.when(hit, F.lit(to)) if out is None else out.when(hit, F.lit(to))
    return F.lit("invalid") if out is None else out.otherwise(F.lit("invalid"))


def format_chats(turns: DataFrame, t: Template = Template(), conv: str = "conv_id",
                 turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: (conv, formatted, segments, valid, final_state).

    ``segments`` is array<struct<text, loss>>; joined they are ``formatted``.
    """
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                   F.coalesce(F.col(text), F.lit("")).alias("text"))
    chats = (turns.where(F.col(conv).isNotNull()).select(F.col(conv).alias("conv"), one.alias("one"))
             .groupBy("conv").agg(F.sort_array(F.collect_list("one")).alias("turns")))
    state = F.aggregate("turns", F.lit("begin"), lambda s, x: _next_state(t, s, x["role"]))

    def segments(x):
        loss = x["role"].isin(*t.loss_roles) if t.loss_roles else F.lit(False)
        head = F.concat(F.lit(t.start), escape_role(x["role"], t), F.lit(t.role_end))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(x["text"], t).alias("text"), loss.alias("loss")),
            F.struct(F.lit(t.end + t.turn_end).alias("text"), F.lit(False).alias("loss")))

    parts = chats.select("conv", state.alias("final_state"),
                         F.flatten(F.transform("turns", segments)).alias("segments"))
    return parts.select(
        F.col("conv").alias(conv),
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments", F.col("final_state").isin(*t.accepting).alias("valid"), "final_state")


def read_chats(formatted: Column, t: Template = Template()) -> Column:
    """The turns in a formatted text, array<struct<role, text, loss>>, unescaped."""
    found = F.split(formatted, _quoted(t.start), -1)
    turns = F.slice(found, F.lit(2), F.greatest(F.size(found) - 1, F.lit(0)))
    tail = len(t.end + t.turn_end)

    def split(x):
        head = F.substring_index(x, t.role_end, 1)
        at = F.char_length(head) + F.lit(len(t.role_end))
        text = F.substring(x, at + 1, F.char_length(x) - at - F.lit(tail))
        role = unescape_role(head, t)
        loss = role.isin(*t.loss_roles) if t.loss_roles else F.lit(False)
        return F.struct(role.alias("role"), unescape(text, t).alias("text"), loss.alias("loss"))

    return F.transform(turns, split)
