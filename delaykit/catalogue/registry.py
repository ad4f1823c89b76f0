"""Registered queries: name -> (callable, SQL counterpart or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delaykit.sources.readers import table

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without SQL it gets a rows-only check and a brute-force test."""

    def keep(run: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Entry(run, sql)
        return run

    return keep


def tables(spark: SparkSession, sf: str, *names: str) -> list[DataFrame]:
    return [table(spark, sf, n) for n in names]


def r9(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 9)
