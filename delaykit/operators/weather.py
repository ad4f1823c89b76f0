"""Hourly weather per airport and weather-code flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.config import WEATHER_FLAGS
from delaykit.functions.scalars import code_flags


def rollup(
    observations: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    code: str | None = None,
    code_out: str = "AggHourlyPresentWeatherType",
) -> DataFrame:
    """Mean of every measure and the sorted, '|'-joined codes per key.

    Rows are first summed per (key, code), so the list built for a busy key holds one entry
    per distinct code instead of one per row, and the sums have shrunk before the shuffle.
    Null measures and null codes are left out of their own result only.
    """
    keys = list(keys)
    if code is None:
        return observations.groupBy(*keys).agg(*[F.avg(m).alias(m) for m in measures])

    first = observations.groupBy(*keys, code).agg(
        F.count(F.lit(1)).cast("int").alias("__rows"),
        *[F.sum(m).alias(f"__s_{m}") for m in measures],
        *[F.count(m).alias(f"__n_{m}") for m in measures],
    )
    entry = F.when(F.col(code).isNotNull(), F.struct(F.col(code).alias("c"), F.col("__rows").alias("n")))
    second = first.groupBy(*keys).agg(
        *[F.try_divide(F.sum(f"__s_{m}"), F.sum(f"__n_{m}")).alias(m) for m in measures],
        F.array_sort(F.collect_list(entry)).alias("__codes"),
    )
    spelled = F.flatten(F.transform("__codes", lambda e: F.array_repeat(e["c"], e["n"])))
    return second.withColumn(code_out, F.concat_ws("|", spelled)).drop("__codes")


def weather_flags(
    df: DataFrame,
    codes: str = "AggHourlyPresentWeatherType",
    flags: Mapping[str, str] = WEATHER_FLAGS,
) -> DataFrame:
    """0/1 column per weather kind by substring, so freezing rain is rain as well."""
    return df.withColumns(code_flags(codes, flags))
