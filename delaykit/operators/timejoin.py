"""Joining flights to observations by hour or by time interval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaykit.functions.scalars import shift_hours


def hour_join(
    flights: DataFrame, hourly: DataFrame, hour: str = "DEP_DATETIME_LAG", place: str = "ORIGIN"
) -> DataFrame:
    """Flights with the roll-up of their hour and place; unmatched flights drop out.

    The roll-up has one row per key, so a busy airport only makes the flight side large,
    which adaptive execution can split.
    """
    return flights.join(hourly, [hour, place])


def _time_bucket(ts: str, width: int) -> Column:
    seconds = (
        F.unix_date(F.to_date(ts)).cast("long") * 86400
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.second(ts)
    )
    return F.floor(seconds / width)


def interval_join(
    probes: DataFrame,
    points: DataFrame,
    place: str,
    probe_time: str,
    point_time: str,
    hours: int = 2,
) -> DataFrame:
    """Every point of the same place with probe_time - hours <= point_time < probe_time.

    Time is cut into buckets as long as the window. A point lies in one bucket and is sought
    by the probes of that bucket and of the next one. The (narrow) points are sent to both,
    the probes to their own only; the exact bounds are checked in the equi join. A busy
    place is spread over its buckets.
    """
    width = hours * 3600
    own = probes.withColumn("__bucket", _time_bucket(probe_time, width))
    home = _time_bucket(point_time, width)
    sent = points.withColumn("__bucket", F.explode(F.array(home, home + 1)))
    return own.join(sent, [place, "__bucket"]).filter(
        (F.col(point_time) >= shift_hours(probe_time, -hours))
        & (F.col(point_time) < F.col(probe_time))
    ).drop("__bucket")
