"""Which weather stations speak for which airport."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.config import STATION_PREFIX
from delaykit.functions.scalars import prefixed


def station_shortlist(
    flights: DataFrame,
    stations: DataFrame,
    origin: str = "ORIGIN",
    state: str = "ORIGIN_STATE_ABR",
    prefix: str = STATION_PREFIX,
) -> DataFrame:
    """Nearest, nearest at a non-zero distance, and furthest stations of every airport.

    Ties stay. ``stations`` has neighbor_call, neighbor_state, station_id,
    distance_to_neighbor, neighbor_lat, neighbor_lon. One aggregate yields all three
    distances; the stations at these distances are then found by one join.
    """
    airports = (
        flights.select(origin, state).distinct().withColumn("neighbor_call", prefixed(prefix, origin))
    )
    candidates = airports.join(
        stations.select(
            "neighbor_call",
            F.col("neighbor_state").alias(state),
            F.col("station_id").alias("STATION"),
            "distance_to_neighbor",
            "neighbor_lat",
            "neighbor_lon",
        ).distinct(),
        ["neighbor_call", state],
    ).distinct()

    d = F.col("distance_to_neighbor")
    chosen = (
        candidates.groupBy(origin)
        .agg(
            F.min(d).alias("nearest"),
            F.min(F.when(d != 0, d)).alias("nearest_apart"),
            F.max(d).alias("furthest"),
        )
        .select(
            origin,
            F.explode(
                F.array_distinct(F.array_compact(F.array("nearest", "nearest_apart", "furthest")))
            ).alias("distance_to_neighbor"),
        )
    )
    return candidates.join(chosen, [origin, "distance_to_neighbor"]).drop(state)
