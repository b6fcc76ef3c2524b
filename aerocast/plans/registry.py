"""Registry of named queries (Spark) and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` and, if any, its oracle."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def finish(df: DataFrame, round6: Iterable[str] = ()) -> DataFrame:
    """Output convention shared with the oracles: UTC wall-clock
    ``timestamp_ntz`` and averages rounded to 6 places (sums of doubles
    depend on order)."""
    r = set(round6)
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        if f.name in r:
            c = F.round(c, 6)
        cols.append(c.alias(f.name))
    return df.select(*cols)
