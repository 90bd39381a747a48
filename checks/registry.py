"""Queries and the SQL they are held against.

A query is a Spark function and an SQL view of the same name. One column list gives both sides their
names, types and rounding: `d` date, `s` text, `i` whole number, `b` boolean, a digit = decimals kept.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs
from ledgerloom.functions.numeric import finite

VIEWS: dict[str, str] = dict(inputs.VIEWS)
QUERIES: dict[str, "Query"] = {}
_SQL_TYPES = {"d": "DATE", "s": "VARCHAR", "i": "BIGINT", "b": "BOOLEAN"}
_SPARK_TYPES = {"d": "date", "s": "string", "i": "bigint", "b": "boolean"}


class Tables:
    """The inputs of one run, built once per query."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def ledger(self):
        return inputs.ledger(self.spark, self.sf_dir)

    @cached_property
    def lines(self):
        return inputs.transactions(self.spark, self.sf_dir)

    @cached_property
    def ledger_nation(self):
        return inputs.ledger(self.spark, self.sf_dir, "n_name")

    @cached_property
    def dirty(self):
        return inputs.ledger_dirty(self.spark, self.sf_dir)

    @cached_property
    def raw_text(self):
        return inputs.raw_text(self.spark, self.sf_dir)

    @cached_property
    def daily(self):
        return inputs.events_daily(self.spark, self.sf_dir)


@dataclass(frozen=True)
class Query:
    name: str
    columns: tuple[tuple[str, str], ...]
    build: Callable[[Tables], DataFrame]
    has_oracle: bool

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(Tables(spark, sf_dir))
        return df.select(*[self._spark(c, t).alias(c) for c, t in self.columns])

    @staticmethod
    def _spark(c, t):
        if t in _SPARK_TYPES:
            return F.col(c).cast(_SPARK_TYPES[t])
        scale = float(10 ** int(t))
        return F.floor(finite(F.col(c).cast("double")) * scale + 0.5) / scale

    @staticmethod
    def _sql(c, t):
        if t in _SQL_TYPES:
            return f'CAST("{c}" AS {_SQL_TYPES[t]}) AS "{c}"'
        scale = f"{10 ** int(t)}.0::DOUBLE"
        value = f'CAST("{c}" AS DOUBLE)'
        return f'CASE WHEN isfinite({value}) THEN floor({value} * {scale} + 0.5) / {scale} END AS "{c}"'

    def oracle(self) -> str:
        picked = ", ".join(self._sql(c, t) for c, t in self.columns)
        ctes = ",\n".join(f"{v} AS MATERIALIZED ({VIEWS[v]})" for v in _needed(self.name))
        return f"WITH RECURSIVE {ctes}\nSELECT {picked} FROM {self.name}"


def _needed(name: str, seen: list[str] | None = None) -> list[str]:
    seen = [] if seen is None else seen
    if name not in seen:
        for other in VIEWS:
            if other != name and other not in seen and re.search(rf"\b(?:FROM|JOIN)\s+{other}\b", VIEWS[name]):
                _needed(other, seen)
        seen.append(name)
    return seen


def view(name: str, sql: str) -> None:
    VIEWS[name] = sql


def query(name: str, columns: str, build, sql: str | None = None) -> None:
    pairs = tuple((p.split(":")[0], p.split(":")[1] if ":" in p else "s") for p in columns.split())
    QUERIES[name] = Query(name, pairs, build, sql is not None)
    if sql is not None:
        view(name, sql)
