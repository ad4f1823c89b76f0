"""The flight data model read from the TPC-H-like tables, as DataFrames and as SQL.

orders   -> flights of seven years: priority is the carrier, status F means delayed
events   -> flights (purchases) and weather observations (all other events) of one month
supplier -> weather stations, customer -> airports by nation, region -> state
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaykit.catalogue.registry import tables

HOLDOUT = 2001

# -- orders as flights -------------------------------------------------------

ORDER_FLIGHTS_SQL = """
order_flights AS (
  SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS flight_id,
         CAST(year(o_orderdate) AS INTEGER) AS "YEAR",
         CAST(quarter(o_orderdate) AS INTEGER) AS "QUARTER",
         CAST(month(o_orderdate) AS INTEGER) AS "MONTH",
         strftime(o_orderdate, '%Y-%m-%d') AS FL_DATE,
         o_orderdate AS DEP_DATETIME_LAG,
         o_orderpriority AS OP_UNIQUE_CARRIER,
         'N' || CAST(o_custkey % 3 AS VARCHAR) AS TAIL_NUM,
         CAST((CAST(floor(o_totalprice) AS BIGINT) % 1440) // 60 * 100
              + (CAST(floor(o_totalprice) AS BIGINT) % 1440) % 60 AS INTEGER) AS CRS_DEP_TIME,
         CAST(o_orderstatus = 'F' AS INTEGER)::DOUBLE AS DEP_DEL15,
         o.n_name AS ORIGIN, d.n_name AS DEST, o_totalprice
  FROM orders
  JOIN customer ON c_custkey = o_custkey
  JOIN nation o ON o.n_nationkey = c_nationkey
  JOIN nation d ON d.n_nationkey = o_orderkey % 25
)"""


def order_flights(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with the columns of the joined flight table."""
    orders, customer, nation = tables(spark, sf, "orders", "customer", "nation")
    origins = customer.join(
        nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("ORIGIN")),
        "c_nationkey",
    ).select(F.col("c_custkey").alias("o_custkey"), "ORIGIN")
    targets = nation.select(F.col("n_nationkey").alias("__dest"), F.col("n_name").alias("DEST"))
    minute = F.floor("o_totalprice") % 1440
    return (
        orders.withColumn("__dest", (F.col("o_orderkey") % 25).cast("int"))
        .join(origins, "o_custkey")
        .join(targets, "__dest")
        .select(
            "o_orderkey",
            F.col("o_orderkey").cast("string").alias("flight_id"),
            F.year("o_orderdate").alias("YEAR"),
            F.quarter("o_orderdate").alias("QUARTER"),
            F.month("o_orderdate").alias("MONTH"),
            F.dayofweek("o_orderdate").alias("DAY_OF_WEEK"),
            F.to_date("o_orderdate").cast("string").alias("FL_DATE"),
            F.col("o_orderdate").alias("DEP_DATETIME_LAG"),
            F.col("o_orderpriority").alias("OP_UNIQUE_CARRIER"),
            F.concat(F.lit("N"), (F.col("o_custkey") % 3).cast("string")).alias("TAIL_NUM"),
            (F.floor(minute / 60) * 100 + minute % 60).cast("int").alias("CRS_DEP_TIME"),
            (F.col("o_orderstatus") == "F").cast("double").alias("DEP_DEL15"),
            "ORIGIN",
            "DEST",
            "o_totalprice",
        )
    )


def plain_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with year, carrier, label and id only; no joins."""
    (orders,) = tables(spark, sf, "orders")
    return orders.select(
        "o_orderkey",
        F.year("o_orderdate").alias("YEAR"),
        F.col("o_orderpriority").alias("OP_UNIQUE_CARRIER"),
        (F.col("o_orderstatus") == "F").cast("double").alias("DEP_DEL15"),
        F.col("o_orderdate").alias("DEP_DATETIME_LAG"),
        "o_custkey",
        "o_totalprice",
    )


PLAIN_ORDERS_SQL = """
plain_orders AS (
  SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS "YEAR",
         o_orderpriority AS OP_UNIQUE_CARRIER,
         CAST(o_orderstatus = 'F' AS INTEGER)::DOUBLE AS DEP_DEL15,
         o_orderdate AS DEP_DATETIME_LAG, o_custkey, o_totalprice
  FROM orders
)"""

# -- lineitem as routes ------------------------------------------------------

ROUTES_SQL = """
routes AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS "YEAR",
         CAST(quarter(o_orderdate) AS INTEGER) AS "QUARTER",
         c.n_name AS ORIGIN, s.n_name AS DEST
  FROM lineitem
  JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey
  JOIN supplier ON s_suppkey = l_suppkey
  JOIN nation c ON c.n_nationkey = c_nationkey
  JOIN nation s ON s.n_nationkey = s_nationkey
)"""


def routes(spark: SparkSession, sf: str) -> DataFrame:
    """One row per shipped line: from the customer's nation to the supplier's."""
    lineitem, orders, customer, supplier, nation = tables(
        spark, sf, "lineitem", "orders", "customer", "supplier", "nation"
    )
    origins = customer.join(
        nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("ORIGIN")),
        "c_nationkey",
    ).select(F.col("c_custkey").alias("o_custkey"), "ORIGIN")
    targets = supplier.join(
        nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("DEST")),
        "s_nationkey",
    ).select(F.col("s_suppkey").alias("l_suppkey"), "DEST")
    dated = orders.join(origins, "o_custkey").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.year("o_orderdate").alias("YEAR"),
        F.quarter("o_orderdate").alias("QUARTER"),
        "ORIGIN",
    )
    return (
        lineitem.select("l_orderkey", "l_suppkey")
        .join(targets, "l_suppkey")
        .join(dated, "l_orderkey")
        .select("YEAR", "QUARTER", "ORIGIN", "DEST")
    )


# -- events as flights and weather -------------------------------------------

EVENT_FLIGHTS_SQL = """
event_flights AS (
  SELECT event_id, ts, strftime(ts, '%Y-%m-%d') AS FL_DATE,
         CAST(hour(ts) * 100 + minute(ts) AS INTEGER) AS CRS_DEP_TIME,
         'N' || CAST(user_id AS VARCHAR) AS TAIL_NUM,
         n_name AS ORIGIN, r_name AS ORIGIN_STATE_ABR, n_nationkey AS ORIGIN_AIRPORT_ID,
         date_trunc('hour', ts) - INTERVAL 2 HOUR AS DEP_DATETIME_LAG,
         date_trunc('hour', ts) AS DEP_DATETIME, user_id, value, r_name
  FROM events
  JOIN customer ON c_custkey = user_id
  JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey
  WHERE event_type = 'purchase'
),
stations AS (
  SELECT DISTINCT 'K' || n_name AS neighbor_call, r_name AS neighbor_state,
         CAST(s_suppkey AS VARCHAR) AS station_id,
         greatest(s_acctbal, 0.0) AS distance_to_neighbor,
         CAST(n_nationkey AS DOUBLE) AS neighbor_lat, CAST(n_regionkey AS DOUBLE) AS neighbor_lon
  FROM supplier
  JOIN nation ON n_nationkey = s_nationkey
  JOIN region ON r_regionkey = n_regionkey
),
candidates AS (
  SELECT DISTINCT ORIGIN, station_id AS STATION, distance_to_neighbor, neighbor_lat, neighbor_lon
  FROM (SELECT DISTINCT ORIGIN, ORIGIN_STATE_ABR FROM event_flights) a
  JOIN stations s ON s.neighbor_call = 'K' || a.ORIGIN AND s.neighbor_state = a.ORIGIN_STATE_ABR
),
shortlist AS (
  SELECT * FROM candidates c WHERE
    distance_to_neighbor = (SELECT min(distance_to_neighbor) FROM candidates x WHERE x.ORIGIN = c.ORIGIN)
    OR distance_to_neighbor = (SELECT max(distance_to_neighbor) FROM candidates x WHERE x.ORIGIN = c.ORIGIN)
    OR distance_to_neighbor = (SELECT min(distance_to_neighbor) FROM candidates x
                               WHERE x.ORIGIN = c.ORIGIN AND x.distance_to_neighbor <> 0)
),
observations AS (
  SELECT event_id, ts, CAST(user_id AS VARCHAR) AS STATION, value, event_type AS code
  FROM events WHERE event_type <> 'purchase' AND value <= 200
),
hourly AS (
  SELECT ORIGIN, date_trunc('hour', ts) + INTERVAL 1 HOUR AS DEP_DATETIME_LAG,
         avg(value) AS value, string_agg(code, '|' ORDER BY code) AS codes,
         count(*) AS n_obs
  FROM observations JOIN shortlist USING (STATION)
  GROUP BY ALL
)"""


def event_airports(spark: SparkSession, sf: str) -> DataFrame:
    """user -> airport (nation of the customer of that number) and state (region)."""
    customer, nation, region = tables(spark, sf, "customer", "nation", "region")
    places = nation.join(
        region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name"), "n_regionkey"
    ).select(
        F.col("n_nationkey").alias("c_nationkey"),
        F.col("n_nationkey").alias("ORIGIN_AIRPORT_ID"),
        F.col("n_name").alias("ORIGIN"),
        F.col("r_name").alias("ORIGIN_STATE_ABR"),
    )
    return customer.join(places, "c_nationkey").select(
        F.col("c_custkey").alias("user_id"), "ORIGIN", "ORIGIN_STATE_ABR", "ORIGIN_AIRPORT_ID"
    )


def event_flights(spark: SparkSession, sf: str) -> DataFrame:
    """Purchases with the raw columns of a flight."""
    (events,) = tables(spark, sf, "events")
    return (
        events.filter(F.col("event_type") == "purchase")
        .join(event_airports(spark, sf), "user_id")
        .select(
            "event_id",
            "ts",
            F.to_date("ts").cast("string").alias("FL_DATE"),
            (F.hour("ts") * 100 + F.minute("ts")).alias("CRS_DEP_TIME"),
            F.concat(F.lit("N"), F.col("user_id").cast("string")).alias("TAIL_NUM"),
            "ORIGIN",
            "ORIGIN_STATE_ABR",
            "ORIGIN_AIRPORT_ID",
            "user_id",
            "value",
        )
    )


def stations(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as stations; a negative balance is distance 0."""
    supplier, nation, region = tables(spark, sf, "supplier", "nation", "region")
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(F.lit("K"), "n_name").alias("neighbor_call"),
            F.col("r_name").alias("neighbor_state"),
            F.col("s_suppkey").cast("string").alias("station_id"),
            F.greatest("s_acctbal", F.lit(0.0)).alias("distance_to_neighbor"),
            F.col("n_nationkey").cast("double").alias("neighbor_lat"),
            F.col("n_regionkey").cast("double").alias("neighbor_lon"),
        )
    )


def observations(spark: SparkSession, sf: str) -> DataFrame:
    """All other events as observations of the station that bears the user's number."""
    (events,) = tables(spark, sf, "events")
    return events.filter(F.col("event_type") != "purchase").select(
        "event_id",
        "ts",
        F.col("user_id").cast("string").alias("STATION"),
        "value",
        F.col("event_type").alias("code"),
    )


# region -> IANA time zone (fixed values of the stand-in)
ZONES = {
    "AFRICA": "Africa/Lagos",
    "AMERICA": "America/New_York",
    "ASIA": "Asia/Kolkata",
    "EUROPE": "Europe/Paris",
    "MIDDLE EAST": "Asia/Dubai",
}

ZONES_SQL = "zones AS (SELECT * FROM (VALUES {}) z(r_name, zone))".format(
    ", ".join(f"('{r}', '{z}')" for r, z in ZONES.items())
)


def nation_zones(spark: SparkSession, sf: str) -> DataFrame:
    """Time zone of every nation by its region: columns code and time_zone_id."""
    nation, region = tables(spark, sf, "nation", "region")
    zone = F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair])[F.col("r_name")]
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("code"), zone.alias("time_zone_id")
    )


# -- scored rows -------------------------------------------------------------

SCORED_SQL = """
scored AS (
  SELECT o_orderkey, o_custkey, o_orderpriority, CAST(month(o_orderdate) AS INTEGER) AS month,
         CAST(isodow(o_orderdate) AS INTEGER) AS weekday, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
         CAST(o_custkey % 5 AS INTEGER) AS region, o_totalprice > 200000 AS is_large,
         CAST(o_orderstatus = 'F' AS INTEGER)::DOUBLE AS label,
         CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS DOUBLE) / 1000 AS score
  FROM orders
)"""


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with a label and a closed-form score in [0, 1) that has many ties."""
    (orders,) = tables(spark, sf, "orders")
    return orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderpriority",
        F.month("o_orderdate").alias("month"),
        (F.weekday("o_orderdate") + 1).alias("weekday"),
        F.quarter("o_orderdate").alias("quarter"),
        (F.col("o_custkey") % 5).cast("int").alias("region"),
        (F.col("o_totalprice") > 200000).alias("is_large"),
        (F.col("o_orderstatus") == "F").cast("double").alias("label"),
        ((F.floor("o_totalprice") % 1000).cast("double") / 1000).alias("score"),
    )
