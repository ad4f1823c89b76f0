"""State of the same unit's previous event (the aircraft's previous flight)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaykit.config import MIN_TURNAROUND_MINUTES
from delaykit.functions.scalars import Col, as_col
from delaykit.operators.lookup import plain_key


def previous_status(
    df: DataFrame,
    status: str,
    day: str,
    unit: str,
    minutes: Col,
    out: str,
    tie: Sequence[str] = (),
    min_gap: float = MIN_TURNAROUND_MINUTES,
    chunk_minutes: int = 60,
    keep_helpers: bool = False,
) -> DataFrame:
    """Status of the unit's previous event of the day, if it began at least ``min_gap``
    minutes earlier; else of the event before that one; 0 where there is none.

    The fallback does not look at the gap of the earlier event, and a first event has no
    gap and so takes the (empty) fallback. ``tie`` orders events with equal minutes.

    A unit-day is cut into chunks of the clock, so that no task holds all events of a busy
    unit. Look-backs run inside the chunk; a chunk's first two events take over the last two
    of the chunks before, which are found from one row per chunk. Whole rows are shuffled
    once; finding the chunk ends shuffles key, time and status only.
    """
    keys = ["__unit_day", "__chunk"]
    inside = Window.partitionBy(*keys).orderBy("__at", *tie)
    placed = df.withColumns({"__at": as_col(minutes), "__unit_day": plain_key(day, unit)})
    placed = placed.withColumn(
        "__chunk", F.coalesce(F.floor(F.col("__at") / chunk_minutes), F.lit(-1))
    ).withColumn("__now", F.struct(F.col("__at").alias("at"), F.col(status).alias("s")))
    local = placed.withColumns(
        {
            "__place": F.row_number().over(inside),
            "__one": F.lag("__now", 1).over(inside),
            "__two": F.lag("__now", 2).over(inside),
        }
    )

    ends = local.groupBy(*keys).agg(
        F.max_by(
            F.struct(F.col("__now").alias("last"), F.col("__one").alias("second")), "__place"
        ).alias("e")
    )
    over_chunks = Window.partitionBy("__unit_day").orderBy("__chunk")
    carried = ends.select(
        *keys,
        F.lag("e.last", 1).over(over_chunks).alias("__c_one"),
        F.coalesce(
            F.lag("e.second", 1).over(over_chunks), F.lag("e.last", 2).over(over_chunks)
        ).alias("__c_two"),
    )

    place = F.col("__place")
    one = F.when(place == 1, F.col("__c_one")).otherwise(F.col("__one"))
    two = (
        F.when(place == 1, F.col("__c_two"))
        .when(place == 2, F.col("__c_one"))
        .otherwise(F.col("__two"))
    )
    joined = local.join(carried, keys).withColumns({"__p1": one, "__p2": two})
    gap = F.col("__at") - F.col("__p1.at")
    result = joined.withColumn(
        out,
        F.coalesce(
            F.when(gap >= min_gap, F.col("__p1.s")).otherwise(F.col("__p2.s")),
            F.lit(0).cast(df.schema[status].dataType),
        ),
    )
    if keep_helpers:
        result = result.withColumns(
            {
                f"{out}_lag1": F.col("__p1.s"),
                f"{out}_lag2": F.col("__p2.s"),
                f"{out}_prev_minutes": F.col("__p1.at"),
                f"{out}_gap_minutes": gap,
            }
        )
    helpers = ["__unit_day", "__at", "__now", "__chunk", "__place", "__one", "__two", "__c_one", "__c_two", "__p1", "__p2"]
    return result.drop(*helpers)
