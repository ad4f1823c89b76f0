import datetime as dt
import random

from pyspark.sql import functions as F

from delaykit.operators.lookup import (
    fits_broadcast,
    keep_listed,
    null_safe_join,
    plain_key,
    sized_lookup,
)
from delaykit.operators.stations import station_shortlist
from delaykit.operators.timejoin import interval_join
from delaykit.operators.weather import rollup
from delaykit.plans.joined import build_joined, build_joined_by_interval, prepare_flights
from delaykit.sources import schemas

STATION = "neighbor_call string, neighbor_state string, station_id string, distance_to_neighbor double, neighbor_lat double, neighbor_lon double"


def test_shortlist_keeps_ties_and_needs_the_state(spark, rows):
    flights = spark.createDataFrame([("SFO", "CA"), ("SFO", "CA"), ("LAX", "CA")], "ORIGIN string, ORIGIN_STATE_ABR string")
    stations = spark.createDataFrame(
        [
            ("KSFO", "CA", "s0", 0.0, 1.0, 1.0), ("KSFO", "CA", "s1", 5.0, 1.0, 1.0),
            ("KSFO", "CA", "s2", 5.0, 2.0, 1.0), ("KSFO", "CA", "s3", 7.0, 1.0, 1.0),
            ("KSFO", "CA", "s4", 9.0, 1.0, 1.0), ("KSFO", "NV", "s5", 1.0, 1.0, 1.0),
            ("KLAX", "CA", "s1", 3.0, 1.0, 1.0), ("KLAX", "CA", "s9", 4.0, 1.0, 1.0),
            ("KLAX", "CA", "s8", 8.0, 1.0, 1.0), ("KLAX", "CA", "s8", 8.0, 1.0, 1.0),
        ],
        STATION,
    )
    got = rows(station_shortlist(flights, stations).select("ORIGIN", "STATION"))
    assert got == [("LAX", "s1"), ("LAX", "s8"), ("SFO", "s0"), ("SFO", "s1"), ("SFO", "s2"), ("SFO", "s4")]


def test_rollup_equals_plain_means_and_sorted_codes(spark, rows):
    df = spark.createDataFrame(
        [("a", 1.0, None, "RA"), ("a", 2.0, 4.0, None), ("a", None, 6.0, "BR"), ("a", 9.0, 8.0, "RA"), ("b", None, None, None)],
        "k string, x double, y double, c string",
    )
    got = rows(rollup(df, ["k"], ["x", "y"], "c", "codes"))
    assert got == [("a", 4.0, 6.0, "BR|RA|RA"), ("b", None, None, "")]
    assert rows(rollup(df, ["k"], ["x"])) == [("a", 4.0), ("b", None)]


def test_interval_join_equals_the_naive_join(spark):
    rng = random.Random(11)
    start = dt.datetime(2019, 1, 1)
    at = lambda: start + dt.timedelta(seconds=rng.choice([rng.randrange(86400), 3600 * rng.randrange(24)]))
    probes = spark.createDataFrame(
        [(i, rng.choice(["hub", "hub", "x", None]), at()) for i in range(300)], "p int, k string, t timestamp_ntz"
    )
    points = spark.createDataFrame(
        [(i, rng.choice(["hub", "hub", "x", None]), at()) for i in range(300)], "q int, k string, s timestamp_ntz"
    )
    for hours in (1, 2, 5):
        got = interval_join(probes, points, "k", "t", "s", hours).select("p", "q")
        naive = probes.join(points, "k").filter(
            (F.col("s") >= F.col("t") - F.expr(f"INTERVAL '{hours}' HOUR")) & (F.col("s") < F.col("t"))
        ).select("p", "q")
        assert got.count() == naive.count() and got.exceptAll(naive).count() == 0


def test_lookup_helpers(spark, rows):
    left = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, n int")
    right = spark.createDataFrame([("a", 10), (None, 20)], "k string, m int")
    assert rows(null_safe_join(left, right, ["k"])) == [(None, 2, 20), ("a", 1, 10)]
    assert rows(keep_listed(left, right, ["k"])) == [("a", 1)]
    assert fits_broadcast(right) and not fits_broadcast(right, max_bytes=1)
    assert "ResolvedHint" in sized_lookup(right)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in sized_lookup(right, 1)._jdf.queryExecution().analyzed().toString()
    tricky = spark.createDataFrame([("a|", "b"), ("a", "|b"), (None, "-"), ("-", None)], "x string, y string")
    assert tricky.select(plain_key("x", "y")).distinct().count() == 4


def _inputs(spark):
    flight = dict.fromkeys(schemas.FLIGHTS.fieldNames())
    flight.update(
        FL_DATE="2019-07-01", OP_UNIQUE_CARRIER="AA", TAIL_NUM="N1", OP_CARRIER_FL_NUM=7, ORIGIN="SFO",
        ORIGIN_STATE_ABR="CA", ORIGIN_AIRPORT_ID=1, DEST="LAX", DEST_AIRPORT_ID=2, CRS_DEP_TIME=905,
        DEP_TIME=910, DEP_DEL15=0.0, YEAR=2019,
    )
    data = [
        flight,
        dict(flight),                                             # exact copy
        dict(flight, OP_CARRIER_FL_NUM=8, TAIL_NUM=None),         # no tail number
        dict(flight, OP_CARRIER_FL_NUM=9, DEP_TIME=None, DEP_DEL15=None, CANCELLED=1.0),
        dict(flight, OP_CARRIER_FL_NUM=10, CRS_DEP_TIME=1305),    # no weather for its hour
        dict(flight, OP_CARRIER_FL_NUM=11, ORIGIN="OAK"),         # no station
    ]
    flights = spark.createDataFrame([tuple(d[c] for c in schemas.FLIGHTS.fieldNames()) for d in data], schemas.FLIGHTS)
    stations = spark.createDataFrame([("KSFO", "CA", "s0", 0.0, 1.0, 2.0)], STATION)

    def obs(date, wind, rain, code):
        d = dict.fromkeys(schemas.WEATHER.fieldNames())
        d.update(STATION="s0", DATE=date, HourlyWindSpeed=wind, HourlyPrecipitation=rain, HourlyPresentWeatherType=code)
        return tuple(d[c] for c in schemas.WEATHER.fieldNames())

    weather = spark.createDataFrame(
        [
            obs("2019-07-01T06:00:00", "10", "T", "RA"),     # hour 6 serves hour 7, two hours before 9
            obs("2019-07-01T06:59:59", "20", None, "FZRA"),
            obs("2019-07-01T06:30:00", "201", "9", "SN"),    # outlier
            obs("2019-07-01T06:30:00", None, "9", "SN"),     # no wind
            obs("2019-07-01T07:00:00", "99", "9", "SN"),     # serves hour 8
        ],
        schemas.WEATHER,
    )
    zones = spark.createDataFrame([("SFO", "America/Los_Angeles")], schemas.TIMEZONES)
    return flights, stations, weather, zones


def test_joined_table(spark):
    out = build_joined(*_inputs(spark)).orderBy("OP_CARRIER_FL_NUM").collect()
    assert [r["OP_CARRIER_FL_NUM"] for r in out] == [7, 9]
    first, cancelled = out
    assert first["HourlyWindSpeed"] == 15.0 and first["HourlyPrecipitation"] == 0.0
    assert first["AggHourlyPresentWeatherType"] == "FZRA|RA"
    assert first["DEP_HOUR"] == "09" and first["DEP_DATETIME_LAG"] == dt.datetime(2019, 7, 1, 7)
    assert first["UTC_DEP_DATETIME"] == dt.datetime(2019, 7, 1, 16)
    assert first["flight_id"] == "1-2-2019-07-01-7-AA-910" and first["DEP_DEL15"] == 0.0
    assert cancelled["DEP_TIME_CLEANED"] == 905 and cancelled["DEP_DEL15"] == 1.0


def test_joined_table_by_interval(spark, rows):
    out = build_joined_by_interval(*_inputs(spark))
    # hour 9 minus two is 7: observations from 5:00 up to, not including, 7:00
    got = rows(out.filter("OP_CARRIER_FL_NUM = 7").select("DATE", "HourlyWindSpeed"))
    assert got == [(dt.datetime(2019, 7, 1, 6), 10.0), (dt.datetime(2019, 7, 1, 6, 59, 59), 20.0)]


def test_weather_never_comes_from_the_last_two_hours(spark):
    out = build_joined_by_interval(*_inputs(spark))
    late = out.filter(F.col("DATE") > F.col("DEP_DATETIME") - F.expr("INTERVAL '2' HOUR"))
    assert late.count() == 0


def test_prepare_flights_drops_copies_and_null_tails(spark):
    flights = _inputs(spark)[0]
    assert prepare_flights(flights).count() == 4
