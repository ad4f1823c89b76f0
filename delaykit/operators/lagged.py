"""Features taken from the prior period, so that a row never sees its own future."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.config import TIER_HIGH_DELAY, TIER_LOW_DELAY, TIER_MIDDLE, TIER_QUANTILES
from delaykit.operators.lookup import fits_broadcast, null_safe_join, sized_lookup
from delaykit.operators.ranks import exact_quantiles
from delaykit.session import cut_lineage


def period_rates(df: DataFrame, period: str, group: str, label: str, row_id: str) -> DataFrame:
    """Delayed sum, flight count and delay percentage per (period, group), in one pass."""
    return df.groupBy(period, group).agg(
        F.sum(label).alias("TotalDelay"),
        F.count(row_id).alias("TotalFlight"),
        F.count(F.lit(1)).alias("n_rows"),
    ).withColumn(
        "perc_delay", F.try_divide(F.col("TotalDelay"), F.col("TotalFlight")) * 100
    )


def tiers(rates: DataFrame, period: str, rate: str = "perc_delay") -> DataFrame:
    """Add ``airline_type``: strictly outside the period's quartiles of the group rates.

    Quartiles are exact with linear interpolation, over one row per group, and found by
    place, so that no task holds all groups of a period.
    """
    quartiles = sized_lookup(exact_quantiles(rates, rate, TIER_QUANTILES, keys=[period]))
    marked = null_safe_join(rates, quartiles, [period], "left")
    return marked.withColumn(
        "airline_type",
        F.when(F.col(rate) > F.col("q1"), TIER_HIGH_DELAY)
        .when(F.col(rate) < F.col("q0"), TIER_LOW_DELAY)
        .otherwise(TIER_MIDDLE),
    ).drop("q0", "q1")


def prior_rates(
    rates: DataFrame,
    period: str,
    group: str,
    first_period: int | None = None,
    plain_mean: bool = False,
) -> DataFrame:
    """(period, group) -> perc_delay and airline_type of the prior period, gaps filled.

    The first period uses its own figures. A group without a prior period gets the mean of
    the prior rates over the rows of the current period, so groups weigh by their rows
    (``plain_mean`` weighs them equally), and the middle tier. Null groups have no rate of
    their own: they are filled like new groups, and left out in the first period.
    """
    start = rates.agg(F.min(period)).scalar() if first_period is None else F.lit(first_period)
    known = tiers(rates.filter(F.col(group).isNotNull()), period)

    own = known.filter(F.col(period) == start).select(period, group, "perc_delay", "airline_type")
    prior = known.select(
        (F.col(period) + 1).alias(period), group, "perc_delay", "airline_type"
    )
    later = rates.filter(F.col(period) > start).select(period, group, "n_rows")
    joined = later.join(prior, [period, group], "left")

    weight = F.when(F.col("perc_delay").isNotNull(), F.lit(1) if plain_mean else F.col("n_rows"))
    total, weights = F.sum(F.col("perc_delay") * weight), F.sum(weight)
    means = joined.groupBy(period).agg(F.try_divide(total, weights).alias("__mean"))
    joined = null_safe_join(joined, sized_lookup(means), [period])
    filled = joined.select(
        period,
        group,
        F.coalesce("perc_delay", "__mean").alias("perc_delay"),
        F.coalesce("airline_type", F.lit(TIER_MIDDLE)).alias("airline_type"),
    )
    return own.unionByName(filled)


def carrier_rates(
    df: DataFrame,
    period: str = "YEAR",
    group: str = "OP_UNIQUE_CARRIER",
    label: str = "DEP_DEL15",
    row_id: str = "flight_id",
) -> DataFrame:
    """:func:`period_rates`, kept: one row per (period, group), from one pass over the rows."""
    return cut_lineage(period_rates(df, period, group, label, row_id))


def apply_rates(
    df: DataFrame,
    rates: DataFrame,
    period: str = "YEAR",
    group: str = "OP_UNIQUE_CARRIER",
    first_period: int | None = None,
    plain_mean: bool = False,
) -> DataFrame:
    """Rows with the prior period's figures of their group.

    The table of rates is worked on by the same plan whatever its size; it is broadcast if it
    measures small and joined by shuffle otherwise.
    """
    lookup = prior_rates(rates, period, group, first_period, plain_mean)
    lookup = F.broadcast(lookup) if fits_broadcast(rates) else lookup
    return null_safe_join(df, lookup, [period, group])


def carrier_effect(
    df: DataFrame,
    period: str = "YEAR",
    group: str = "OP_UNIQUE_CARRIER",
    label: str = "DEP_DEL15",
    row_id: str = "flight_id",
    first_period: int | None = None,
    plain_mean: bool = False,
) -> DataFrame:
    """Rows with the prior period's delay rate and tier of their group.

    One pass over the rows yields a table of one row per (period, group); everything else,
    the mean that fills gaps included, follows from that table, which is joined back.
    """
    rates = carrier_rates(df, period, group, label, row_id)
    return apply_rates(df, rates, period, group, first_period, plain_mean)


def prior_period_join(
    df: DataFrame,
    values: DataFrame,
    period: str,
    key: str,
    value_period: str,
    value_key: str,
    columns: Sequence[str],
    lag_out: str = "YEARLAG1",
) -> DataFrame:
    """Inner join against values of the period before; rows without one drop out.

    The values are materialised and measured, since a computed table of ranks looks huge to
    the optimiser and would make it shuffle the rows.
    """
    right = values.select(
        F.col(value_period).cast("int").alias(lag_out),
        F.col(value_key).alias(key),
        *columns,
    ).distinct()
    lagged = df.withColumn(lag_out, (F.col(period) - 1).cast("int"))
    return lagged.join(sized_lookup(right), [lag_out, key])
