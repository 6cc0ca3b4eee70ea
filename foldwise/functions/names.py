"""Column references that survive spaces, dots, brackets and back-ticks in names."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from math import isfinite

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def q(name: str) -> Column:
    return F.col(quoted(name))


def qs(names: Iterable[str]) -> list[Column]:
    return [q(n) for n in names]


def number(value: float) -> str:
    """SQL literal of a double."""
    value = float(value)
    return f"({value!r}D)" if isfinite(value) else f"CAST('{value}' AS DOUBLE)"


def text_literal(value: str) -> str:
    """SQL literal of a string."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def total_sql(terms: Sequence[str]) -> str:
    """Sum of SQL terms as a balanced tree, so wide sums stay shallow."""
    level = list(terms) or ["0D"]
    while len(level) > 1:
        paired = [f"({a} + {b})" for a, b in zip(level[::2], level[1::2])]
        level = paired + level[len(paired) * 2:]
    return level[0]
