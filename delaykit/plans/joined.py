"""Stage 1: flights joined to the weather of nearby stations two hours before departure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.config import (
    FLIGHT_ID_PARTS,
    LABEL,
    MAX_WIND_SPEED,
    OBSERVATION_SHIFT_HOURS,
    WEATHER_LEAD_HOURS,
    WEATHER_MEASURES,
)
from delaykit.functions.scalars import (
    composite_id,
    day_of,
    hour_floor,
    hour_text,
    scheduled_hour,
    shift_hours,
    to_utc,
)
from delaykit.operators.cleaning import (
    drop_above,
    drop_null_keys,
    exact_dedup,
    fill_constants,
    first_known,
    numeric_text,
)
from delaykit.operators.lookup import fits_broadcast
from delaykit.operators.stations import station_shortlist
from delaykit.operators.timejoin import hour_join, interval_join
from delaykit.operators.weather import rollup
from delaykit.session import cut_lineage
from delaykit.sources.schemas import FLIGHTS

CODE = "HourlyPresentWeatherType"
STATION_NUMBERS = ["distance_to_neighbor", "neighbor_lat", "neighbor_lon"]
AVERAGED = ["ELEVATION", *WEATHER_MEASURES, *STATION_NUMBERS]


def prepare_flights(flights: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct flights with a tail number, their departure hour and the weather hour.

    ``columns`` are those to keep, all of the published table if unset; a missing one is an error.
    """
    wanted = list(columns or FLIGHTS.fieldNames())
    if missing := [c for c in wanted if c not in flights.columns]:
        raise ValueError(f"flight columns are missing: {missing}")
    rows = drop_null_keys(flights, ["TAIL_NUM"])
    return exact_dedup(rows, wanted).withColumns(
        {
            "DEP_HOUR": hour_text("CRS_DEP_TIME"),
            "DEP_DAY": F.date_format(day_of("FL_DATE"), "yyyy-MM-dd"),
            "DEP_DATETIME": scheduled_hour("FL_DATE", "CRS_DEP_TIME"),
            "DEP_DATETIME_LAG": shift_hours(
                scheduled_hour("FL_DATE", "CRS_DEP_TIME"), -WEATHER_LEAD_HOURS
            ),
        }
    )


def prepare_weather(weather: DataFrame) -> DataFrame:
    """Readable measures, calm outliers removed, the hour the observation serves. Rows of the
    chosen stations come in, so only they are parsed."""
    parsed = drop_above(
        numeric_text(weather, ["ELEVATION", *WEATHER_MEASURES]), "HourlyWindSpeed", MAX_WIND_SPEED
    )
    seen = parsed.withColumn("DATE", F.col("DATE").try_cast("timestamp_ntz"))
    return seen.withColumn(
        "DEP_DATETIME_LAG", shift_hours(hour_floor("DATE"), OBSERVATION_SHIFT_HOURS)
    )


def chosen_stations(flights: DataFrame, stations: DataFrame) -> DataFrame:
    """Station shortlist, kept once; it serves as key list and as join side.

    Its size follows the number of airports; it is broadcast below the measured limit.
    """
    saved = cut_lineage(station_shortlist(flights, stations).drop("neighbor_call"))
    return F.broadcast(saved) if fits_broadcast(saved) else saved


def hourly_weather(weather: DataFrame, shortlist: DataFrame) -> DataFrame:
    """One row per (airport, hour): mean measures and all weather codes."""
    near = prepare_weather(weather.join(shortlist, "STATION"))
    return rollup(near, ["ORIGIN", "DEP_DATETIME_LAG"], AVERAGED, CODE)


def timely_weather(weather: DataFrame, shortlist: DataFrame) -> DataFrame:
    """One row per (airport, observation time), for the interval form of the join."""
    near = prepare_weather(weather.join(shortlist, "STATION"))
    return rollup(near, ["ORIGIN", "DATE"], AVERAGED)


def finish(joined: DataFrame, timezones: DataFrame) -> DataFrame:
    """UTC times, flight id and the null rules; airports without a time zone drop out."""
    zones = timezones.select(F.col("code").alias("ORIGIN"), "time_zone_id")
    timed = joined.join(zones, "ORIGIN").withColumns(
        {
            "UTC_DEP_DATETIME_LAG": to_utc("DEP_DATETIME_LAG", "time_zone_id"),
            "UTC_DEP_DATETIME": to_utc("DEP_DATETIME", "time_zone_id"),
        }
    )
    named = first_known(timed, "DEP_TIME_CLEANED", "DEP_TIME", "CRS_DEP_TIME").withColumn(
        "flight_id", composite_id(*FLIGHT_ID_PARTS)
    )
    return fill_constants(named, {LABEL: 1.0, "HourlyPrecipitation": 0.0})


def build_joined(
    flights: DataFrame, stations: DataFrame, weather: DataFrame, timezones: DataFrame,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The joined table by departure hour."""
    departures = prepare_flights(flights, columns)
    hourly = hourly_weather(weather, chosen_stations(flights, stations))
    return finish(hour_join(departures, hourly), timezones)


def build_joined_by_interval(
    flights: DataFrame, stations: DataFrame, weather: DataFrame, timezones: DataFrame,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The joined table with one row per flight and observation of the two hours before."""
    departures = prepare_flights(flights, columns)
    points = timely_weather(weather, chosen_stations(flights, stations))
    joined = interval_join(
        departures, points, "ORIGIN", "DEP_DATETIME_LAG", "DATE", hours=WEATHER_LEAD_HOURS
    )
    return finish(joined, timezones)
