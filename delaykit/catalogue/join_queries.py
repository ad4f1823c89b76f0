"""Stations, hourly weather, hour and interval joins, UTC times, the joined table."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaykit.catalogue import standins as s
from delaykit.catalogue.registry import query, r9, tables
from delaykit.config import WEATHER_MEASURES
from delaykit.functions.scalars import (
    composite_id,
    hour_floor,
    hour_of,
    hour_text,
    minute_of_day,
    scheduled_hour,
    shift_hours,
    to_utc,
)
from delaykit.operators.cleaning import drop_above, first_known
from delaykit.operators.lookup import keep_listed
from delaykit.operators.stations import station_shortlist
from delaykit.operators.timejoin import hour_join, interval_join
from delaykit.operators.weather import rollup, weather_flags
from delaykit.plans.joined import build_joined, build_joined_by_interval, chosen_stations
from delaykit.sources.schemas import FLIGHTS


@query(
    "station_shortlist",
    f"""WITH {s.EVENT_FLIGHTS_SQL}
SELECT ORIGIN, STATION, distance_to_neighbor, neighbor_lat, neighbor_lon FROM shortlist""",
)
def shortlist(spark, sf):
    chosen = station_shortlist(s.event_flights(spark, sf), s.stations(spark, sf))
    return chosen.drop("neighbor_call")


def _near(spark, sf):
    calm = drop_above(s.observations(spark, sf), "value", 200)
    chosen = chosen_stations(s.event_flights(spark, sf), s.stations(spark, sf))
    return calm.join(chosen.select("ORIGIN", "STATION"), "STATION")


def _hourly(spark, sf):
    rows = _near(spark, sf).withColumn("DEP_DATETIME_LAG", shift_hours(hour_floor("ts"), 1))
    return rollup(rows, ["ORIGIN", "DEP_DATETIME_LAG"], ["value"], "code", "codes")


def _flights(spark, sf):
    return s.event_flights(spark, sf).withColumns(
        {
            "DEP_DATETIME": scheduled_hour("FL_DATE", "CRS_DEP_TIME"),
            "DEP_DATETIME_LAG": shift_hours(scheduled_hour("FL_DATE", "CRS_DEP_TIME"), -2),
        }
    )


@query(
    "hourly_rollup",
    f"""WITH {s.EVENT_FLIGHTS_SQL}
SELECT ORIGIN, CAST(DEP_DATETIME_LAG AS VARCHAR) AS hour, round(value, 9) AS value, codes
FROM hourly""",
)
def hourly_rollup(spark, sf):
    return _hourly(spark, sf).select(
        "ORIGIN", F.col("DEP_DATETIME_LAG").cast("string").alias("hour"), r9("value").alias("value"), "codes"
    )


@query(
    "hour_key_join",
    f"""WITH {s.EVENT_FLIGHTS_SQL}
SELECT f.event_id, ORIGIN, CAST(DEP_DATETIME_LAG AS VARCHAR) AS hour,
       round(h.value, 9) AS weather, h.codes
FROM event_flights f JOIN hourly h USING (ORIGIN, DEP_DATETIME_LAG)""",
)
def hour_key_join(spark, sf):
    hourly = _hourly(spark, sf).withColumnRenamed("value", "weather")
    joined = hour_join(_flights(spark, sf), hourly)
    return joined.select(
        "event_id",
        "ORIGIN",
        F.col("DEP_DATETIME_LAG").cast("string").alias("hour"),
        r9("weather").alias("weather"),
        "codes",
    )


@query(
    "interval_join",
    f"""WITH {s.EVENT_FLIGHTS_SQL},
points AS (
  SELECT ORIGIN, ts AS at, avg(value) AS weather
  FROM observations JOIN shortlist USING (STATION) GROUP BY ALL
)
SELECT f.event_id, ORIGIN, CAST(p.at AS VARCHAR) AS at, round(p.weather, 9) AS weather
FROM event_flights f JOIN points p USING (ORIGIN)
WHERE p.at >= f.DEP_DATETIME_LAG - INTERVAL 2 HOUR AND p.at < f.DEP_DATETIME_LAG""",
)
def interval(spark, sf):
    points = rollup(
        _near(spark, sf).withColumnRenamed("ts", "at"), ["ORIGIN", "at"], ["value"]
    ).withColumnRenamed("value", "weather")
    joined = interval_join(_flights(spark, sf), points, "ORIGIN", "DEP_DATETIME_LAG", "at", hours=2)
    return joined.select(
        "event_id", "ORIGIN", F.col("at").cast("string").alias("at"), r9("weather").alias("weather")
    )


@query(
    "interval_join_by_user",
    """SELECT p.event_id AS probe_id, o.event_id AS point_id
FROM events p JOIN events o ON p.user_id = o.user_id
 AND o.ts >= p.ts - INTERVAL 3 HOUR AND o.ts < p.ts""",
)
def interval_by_user(spark, sf):
    """Every event with the same user's events of the three hours before."""
    (events,) = tables(spark, sf, "events")
    probes = events.select("user_id", F.col("event_id").alias("probe_id"), "ts")
    points = events.select(
        "user_id", F.col("event_id").alias("point_id"), F.col("ts").alias("point_ts")
    )
    joined = interval_join(probes, points, "user_id", "ts", "point_ts", hours=3)
    return joined.select("probe_id", "point_id")


@query(
    "listed_stations",
    f"""WITH {s.EVENT_FLIGHTS_SQL}
SELECT event_id, STATION FROM observations WHERE STATION IN (SELECT STATION FROM shortlist)""",
)
def listed_stations(spark, sf):
    kept = keep_listed(
        drop_above(s.observations(spark, sf), "value", 200), shortlist(spark, sf), ["STATION"]
    )
    return kept.select("event_id", "STATION")


@query(
    "utc_convert",
    f"""WITH {s.ZONES_SQL}
SELECT o_orderkey, zone AS time_zone_id,
       CAST((o_orderdate + INTERVAL 12 HOUR) AT TIME ZONE zone AT TIME ZONE 'UTC' AS VARCHAR) AS utc
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey JOIN zones USING (r_name)""",
)
def utc_convert(spark, sf):
    orders, customer, nation = tables(spark, sf, "orders", "customer", "nation")
    zones = (
        s.nation_zones(spark, sf)
        .join(nation, F.col("code") == F.col("n_name"))
        .join(customer, F.col("n_nationkey") == F.col("c_nationkey"))
        .select(F.col("c_custkey").alias("o_custkey"), "time_zone_id")
    )
    local = orders.select("o_orderkey", "o_custkey", shift_hours("o_orderdate", 12).alias("local"))
    return local.join(zones, "o_custkey").select(
        "o_orderkey", "time_zone_id", to_utc("local", "time_zone_id").cast("string").alias("utc")
    )


@query(
    "time_parse",
    f"""WITH {s.ORDER_FLIGHTS_SQL}
SELECT o_orderkey, CRS_DEP_TIME,
       substr(lpad(CAST(CRS_DEP_TIME AS VARCHAR), 4, '0'), 1, 2) AS "DEP_HOUR",
       CAST(CRS_DEP_TIME // 100 AS INTEGER) AS hour_number,
       CAST(CRS_DEP_TIME // 100 * 60 + CRS_DEP_TIME % 100 AS INTEGER) AS minute_number,
       CAST(CAST(FL_DATE AS TIMESTAMP) + to_hours(CAST(CRS_DEP_TIME // 100 - 2 AS INTEGER)) AS VARCHAR)
         AS lag_hour
FROM order_flights""",
)
def time_parse(spark, sf):
    return s.order_flights(spark, sf).select(
        "o_orderkey",
        "CRS_DEP_TIME",
        hour_text("CRS_DEP_TIME").alias("DEP_HOUR"),
        hour_of("CRS_DEP_TIME").alias("hour_number"),
        minute_of_day("CRS_DEP_TIME").alias("minute_number"),
        shift_hours(scheduled_hour("FL_DATE", "CRS_DEP_TIME"), -2).cast("string").alias("lag_hour"),
    )


@query(
    "composite_id",
    f"""WITH {s.ORDER_FLIGHTS_SQL}
SELECT o_orderkey, ORIGIN || '-' || DEST || '-' || FL_DATE || '-' || o_orderkey || '-'
       || OP_UNIQUE_CARRIER || '-' || CRS_DEP_TIME AS flight_id FROM order_flights""",
)
def flight_ids(spark, sf):
    return s.order_flights(spark, sf).select(
        "o_orderkey",
        composite_id(
            "ORIGIN", "DEST", "FL_DATE", "o_orderkey", "OP_UNIQUE_CARRIER", "CRS_DEP_TIME"
        ).alias("flight_id"),
    )


@query(
    "coalesce_time",
    f"""WITH {s.ORDER_FLIGHTS_SQL}
SELECT o_orderkey, CASE WHEN DEP_DEL15 = 1 THEN CRS_DEP_TIME
                        ELSE CAST((CRS_DEP_TIME + 5) % 2400 AS INTEGER) END AS "DEP_TIME_CLEANED"
FROM order_flights""",
)
def coalesce_time(spark, sf):
    flights = s.order_flights(spark, sf).withColumn(
        "DEP_TIME", F.when(F.col("DEP_DEL15") == 0, (F.col("CRS_DEP_TIME") + 5) % 2400)
    )
    cleaned = first_known(flights, "DEP_TIME_CLEANED", "DEP_TIME", "CRS_DEP_TIME")
    return cleaned.select("o_orderkey", "DEP_TIME_CLEANED")


# -- the whole join stage ----------------------------------------------------


def _raw_flights(spark, sf):
    """Event flights in the raw schema: duplicated rows, null tails, cancelled flights."""
    base = s.event_flights(spark, sf)
    cancelled = F.col("value") > 40
    flights = base.select(
        "FL_DATE",
        "ORIGIN",
        "ORIGIN_STATE_ABR",
        "ORIGIN_AIRPORT_ID",
        "CRS_DEP_TIME",
        F.when(F.col("user_id") != 7, F.col("TAIL_NUM")).alias("TAIL_NUM"),
        F.col("event_id").cast("int").alias("OP_CARRIER_FL_NUM"),
        F.lit("XX").alias("OP_UNIQUE_CARRIER"),
        F.col("ORIGIN_AIRPORT_ID").alias("DEST_AIRPORT_ID"),
        F.when(~cancelled, F.col("CRS_DEP_TIME")).alias("DEP_TIME"),
        F.when(~cancelled, (F.col("value") > 20).cast("double")).alias("DEP_DEL15"),
    )
    return flights.unionByName(flights)


def _raw_weather(spark, sf):
    """Observations in the raw schema: text measures, some of them unreadable."""
    value = F.col("value").cast("string")
    seen = s.observations(spark, sf)
    measures = {m: value for m in WEATHER_MEASURES}
    measures["HourlyPrecipitation"] = F.when(F.col("code") == "error", "T").otherwise(value)
    return seen.select(
        "STATION",
        F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T")).alias("DATE"),
        F.lit("12.5").alias("ELEVATION"),
        *[c.alias(m) for m, c in measures.items()],
        F.when(F.col("code") != "view", F.col("code")).alias("HourlyPresentWeatherType"),
    )


_JOINED_SELECT = """
SELECT ORIGIN_AIRPORT_ID || '-' || ORIGIN_AIRPORT_ID || '-' || FL_DATE || '-' || event_id
         || '-XX-' || CRS_DEP_TIME AS flight_id,
       CASE WHEN f.value > 40 OR f.value > 20 THEN 1.0 ELSE 0.0 END::DOUBLE AS "DEP_DEL15",
       CAST(DEP_DATETIME AT TIME ZONE zone AT TIME ZONE 'UTC' AS VARCHAR) AS utc,
       {columns}
FROM event_flights f JOIN zones USING (r_name) JOIN {weather}
WHERE f.user_id <> 7"""

_WEATHER_PARTS = """avg(value) AS wind, coalesce(avg(CASE WHEN code <> 'error' THEN value END), 0) AS rain"""


def _flights_and_columns(spark, sf):
    """The stand-in's flights, each twice and with columns that go after de-duplication (their
    nulls change places from row to row), and the columns to keep."""
    flights = _raw_flights(spark, sf)
    kept = [c for c in FLIGHTS.fieldNames() if c in flights.columns]
    odd = F.xxhash64("OP_CARRIER_FL_NUM", "FL_DATE") % 2 == 0
    extra = {"unused_a": F.when(odd, F.lit(1)), "unused_b": F.when(~odd, F.lit(1))}
    return flights.unionByName(flights).withColumns(extra), kept


@query(
    "joined_table",
    f"""WITH {s.EVENT_FLIGHTS_SQL}, {s.ZONES_SQL},
w AS (
  SELECT ORIGIN, date_trunc('hour', ts) + INTERVAL 1 HOUR AS DEP_DATETIME_LAG, {_WEATHER_PARTS},
         coalesce(string_agg(CASE WHEN code <> 'view' THEN code END, '|' ORDER BY code), '') AS codes
  FROM observations JOIN shortlist USING (STATION) GROUP BY ALL
)"""
    + _JOINED_SELECT.format(
        columns="round(w.wind, 9) AS wind, round(w.rain, 9) AS rain, w.codes",
        weather="w USING (ORIGIN, DEP_DATETIME_LAG)",
    ),
)
def joined_table(spark, sf):
    flights, kept = _flights_and_columns(spark, sf)
    joined = build_joined(
        flights, s.stations(spark, sf), _raw_weather(spark, sf), s.nation_zones(spark, sf), kept
    )
    return joined.select(
        "flight_id",
        "DEP_DEL15",
        F.col("UTC_DEP_DATETIME").cast("string").alias("utc"),
        r9("HourlyWindSpeed").alias("wind"),
        r9("HourlyPrecipitation").alias("rain"),
        F.col("AggHourlyPresentWeatherType").alias("codes"),
    )


@query(
    "joined_table_by_interval",
    f"""WITH {s.EVENT_FLIGHTS_SQL}, {s.ZONES_SQL},
w AS (
  SELECT ORIGIN, ts AS at, {_WEATHER_PARTS}
  FROM observations JOIN shortlist USING (STATION) GROUP BY ALL
)"""
    + _JOINED_SELECT.format(
        columns="CAST(w.at AS VARCHAR) AS at, round(w.wind, 9) AS wind, round(w.rain, 9) AS rain",
        weather="""w ON w.ORIGIN = f.ORIGIN AND w.at >= f.DEP_DATETIME_LAG - INTERVAL 2 HOUR
  AND w.at < f.DEP_DATETIME_LAG""",
    ),
)
def joined_by_interval(spark, sf):
    flights, kept = _flights_and_columns(spark, sf)
    joined = build_joined_by_interval(
        flights, s.stations(spark, sf), _raw_weather(spark, sf), s.nation_zones(spark, sf), kept
    )
    return joined.select(
        "flight_id",
        "DEP_DEL15",
        F.col("UTC_DEP_DATETIME").cast("string").alias("utc"),
        F.col("DATE").cast("string").alias("at"),
        r9("HourlyWindSpeed").alias("wind"),
        r9("HourlyPrecipitation").alias("rain"),
    )


@query(
    "weather_flags",
    f"""WITH {s.EVENT_FLIGHTS_SQL}
SELECT ORIGIN, CAST(DEP_DATETIME_LAG AS VARCHAR) AS hour,
       CAST(codes LIKE '%view%' AS INTEGER) AS "View", CAST(codes LIKE '%i%' AS INTEGER) AS "AnyI"
FROM hourly""",
)
def hourly_flags(spark, sf):
    flagged = weather_flags(_hourly(spark, sf), "codes", {"View": "view", "AnyI": "i"})
    return flagged.select(
        "ORIGIN", F.col("DEP_DATETIME_LAG").cast("string").alias("hour"), "View", "AnyI"
    )
