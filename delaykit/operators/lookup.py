"""Joins against small tables, with the size measured before anything is broadcast."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaykit.session import cut_lineage

BROADCAST_BYTES = 64 * 1024 * 1024


def _row_bytes(df: DataFrame) -> Column:
    """Estimated bytes of one row: text by its length, other values by a flat width."""
    flat = 16
    texts = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.StringType):
            flat += 16
        else:
            texts.append(F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)))
    return reduce(lambda a, b: a + b, texts, F.lit(flat)).cast("long")


def sized_lookup(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Materialise an aggregated lookup once and hint a broadcast only if it fits.

    The optimiser sees an aggregate of a huge table as huge, so it would shuffle the huge
    side to join it. The lookup is written to the checkpoint folder, its bytes are summed
    there, and the hint is given below ``max_bytes``. Above that the join stays an ordinary
    shuffle join, which adaptive execution splits where a key is hot.
    """
    saved = cut_lineage(df)
    return F.broadcast(saved) if fits_broadcast(saved, max_bytes) else saved


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measured size against the limit; ``df`` should be cheap to read (checkpointed)."""
    size = df.agg(F.sum(_row_bytes(df)).alias("b")).first()["b"] or 0
    return size <= max_bytes


def plain_key(*columns: str) -> Column:
    """One non-null text key for a column tuple, nulls included.

    Windows and joins on it share one partitioning, which a null-safe condition would not.
    """
    parts = []
    for c in columns:
        text = F.col(f"`{c}`").cast("string")
        parts.append(
            F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))
        )
    return F.concat_ws("|", *parts)


def null_safe_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi join on same-named columns in which null equals null; keys appear once."""
    renamed = right.select(
        *[F.col(f"`{c}`").alias(f"__r_{c}") if c in on else F.col(f"`{c}`") for c in right.columns]
    )
    condition = reduce(
        lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"`__r_{c}`")) for c in on]
    )
    return left.join(renamed, condition, how).drop(*[f"__r_{c}" for c in on])


def keep_listed(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``. The list is kept once and measured: a short one is
    broadcast, so the rows are not shuffled for it."""
    return df.join(sized_lookup(keys.select(*on).distinct()), list(on), "left_semi")
