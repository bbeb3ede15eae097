"""Ordered rules over text, and values dealt by a key, as columns and as SQL for the twins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(value) -> str:
    """A SQL literal."""
    return "NULL" if value is None else repr(value) if not isinstance(value, str) else "'" + value.replace("'", "''") + "'"


def first_match(text: Column, rules: Sequence[tuple], default=None, value: int = 1) -> Column:
    """The value of the first rule whose pattern the text has."""
    out = F.lit(default)
    for rule in reversed(rules):
        out = F.when(F.rlike(text, F.lit(rule[0])), F.lit(rule[value])).otherwise(out)
    return out


def sql_first_match(text: str, rules: Sequence[tuple], default=None, value: int = 1) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({text}, {quoted(r[0])}) THEN {quoted(r[value])}" for r in rules) + f" ELSE {quoted(default)} END"


def matched_sum(text: Column, rules: Sequence[tuple[str, int]]) -> Column:
    """The sum of the values of all rules whose pattern the text has."""
    total = F.lit(0)
    for pattern, value in rules:
        total = total + F.when(F.rlike(text, F.lit(pattern)), value).otherwise(0)
    return total


def sql_matched_sum(text: str, rules: Sequence[tuple[str, int]]) -> str:
    return "(" + " + ".join(f"CASE WHEN regexp_matches({text}, {quoted(p)}) THEN {v} ELSE 0 END" for p, v in rules) + ")"


def dealt(key: Column, values: Sequence, step: int = 1) -> Column:
    """One of the values, by the key."""
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(F.floor(key / step).cast("bigint"), F.lit(len(values))) + 1).cast("int"))


def sql_dealt(key: str, values: Sequence, step: int = 1) -> str:
    return f"([{', '.join(map(quoted, values))}])[(({key})::BIGINT // {step}) % {len(values)} + 1]"


def slug(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(text)), r"[_\s]+", "-")


def sql_slug(text: str) -> str:
    return f"regexp_replace(lower(trim({text})), '[_\\s]+', '-', 'g')"
