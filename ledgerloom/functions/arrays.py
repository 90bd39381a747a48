"""Arithmetic on array columns as SQL expression text, all of it running inside the JVM.

Text rather than Column calls: these expressions are deep, and one parsed string is built far faster than
hundreds of calls through the gateway. The arrays hold one series, so the calendar bounds them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def total(a: str) -> str:
    return f"aggregate({a}, 0D, (_s, _v) -> _s + _v)"


def steps(first, last) -> str:
    """The whole numbers from first to last; empty where last lies before first."""
    return f"if({last} >= {first}, sequence({first}, {last}), cast(array() as array<int>))"


def number(x: float) -> str:
    """A double literal; a bare 0.1 would be a decimal."""
    return f"{float(x)!r}D"


def compute(df: DataFrame, columns: dict[str, Column | str]) -> DataFrame:
    """Add columns that are costly to compute, so that they are computed once.

    They leave a generator over a one-element array. The optimizer neither copies an expression through a
    generator into the expressions that read it, nor pushes a filter on its output below it; from a plain
    projection it does both, and a recursion would then run again inside every step that reads its result.
    """
    made = [(F.expr(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
    return df.select("*", F.inline(F.array(F.struct(*made))))
