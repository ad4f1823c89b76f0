"""Stage 2: engineered features and rebalancing of the joined table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaykit.config import HOLDOUT_YEAR, LABEL
from delaykit.functions.scalars import minute_of_day
from delaykit.operators.lagged import apply_rates, carrier_rates, prior_period_join
from delaykit.operators.pagerank import pagerank, period_edges
from delaykit.operators.sampling import downsample
from delaykit.operators.special_days import special_day_effect
from delaykit.operators.tracker import previous_status
from delaykit.operators.weather import weather_flags


def airport_pagerank(
    joined: DataFrame, periods: Sequence[str] = ("YEAR",), **settings
) -> DataFrame:
    """PageRank of airports per period; edges run from destination to origin."""
    edges = period_edges(joined, list(periods), source="DEST", target="ORIGIN")
    return pagerank(edges, list(periods), **settings)


def engineer_features(
    joined: DataFrame,
    calendar: DataFrame,
    pageranks: DataFrame,
    first_year: int | None = None,
    tie: Sequence[str] = ("flight_id",),
) -> DataFrame:
    """Special days, prior-year carrier figures, previous flight, prior-year PageRank of the
    destination, weather flags. Years without a prior year of PageRank drop out."""
    rates = carrier_rates(joined)
    start = rates.agg(F.min("YEAR")).first()[0] if first_year is None else first_year
    # The tracker reads its rows twice, so it comes first, straight on the stage; rows that
    # the carrier join would drop (no carrier in the first year) must not count before.
    rows = joined.filter(
        (F.col("YEAR") > start)
        | ((F.col("YEAR") == start) & F.col("OP_UNIQUE_CARRIER").isNotNull())
    )
    tracked = previous_status(
        rows,
        LABEL,
        day="FL_DATE",
        unit="TAIL_NUM",
        minutes=minute_of_day("DEP_TIME_CLEANED"),
        out="is_prev_delayed",
        tie=tie,
    )
    dated = special_day_effect(tracked, calendar)
    ranked = prior_period_join(
        apply_rates(dated, rates, first_period=start),
        pageranks.withColumn("pagerank", F.col("pagerank").try_cast("double")),
        period="YEAR",
        key="DEST",
        value_period="YEAR",
        value_key="id",
        columns=["pagerank"],
    )
    return weather_flags(ranked)


def rebalance(
    features: DataFrame,
    keys: Sequence[str] = ("flight_id",),
    is_holdout: Column | None = None,
    count_holdout: bool = False,
) -> DataFrame:
    """Thin the on-time training flights; the holdout year stays whole."""
    hold = F.col("YEAR") == HOLDOUT_YEAR if is_holdout is None else is_holdout
    return downsample(features, LABEL, keys, hold, count_holdout)
