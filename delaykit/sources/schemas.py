"""Declared schemas; nothing is inferred on load."""

from __future__ import annotations

from pyspark.sql import types as T

_I, _D, _S = T.IntegerType(), T.DoubleType(), T.StringType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


FLIGHTS = _struct(
    QUARTER=_I, MONTH=_I, DAY_OF_MONTH=_I, DAY_OF_WEEK=_I, FL_DATE=_S,
    OP_UNIQUE_CARRIER=_S, TAIL_NUM=_S, OP_CARRIER_FL_NUM=_I,
    ORIGIN_AIRPORT_ID=_I, ORIGIN_AIRPORT_SEQ_ID=_I, ORIGIN=_S, ORIGIN_STATE_ABR=_S, ORIGIN_WAC=_I,
    DEST=_S, DEST_AIRPORT_ID=_I, DEST_AIRPORT_SEQ_ID=_I, DEST_STATE_ABR=_S, DEST_WAC=_I,
    CRS_DEP_TIME=_I, DEP_TIME=_I, DEP_DEL15=_D, DEP_DELAY=_D,
    DIVERTED=_D, DIV_AIRPORT_LANDINGS=_I, CANCELLED=_D, CANCELLATION_CODE=_S,
    CRS_ELAPSED_TIME=_D, DISTANCE=_D, YEAR=_I,
)

# every measure arrives as text and is parsed by the weather stage
WEATHER = _struct(
    STATION=_S, DATE=_S, ELEVATION=_S, SOURCE=_S,
    HourlyAltimeterSetting=_S, HourlyDewPointTemperature=_S, HourlyWetBulbTemperature=_S,
    HourlyDryBulbTemperature=_S, HourlyPrecipitation=_S, HourlyStationPressure=_S,
    HourlySeaLevelPressure=_S, HourlyRelativeHumidity=_S, HourlyVisibility=_S,
    HourlyWindSpeed=_S, HourlyPresentWeatherType=_S,
)

STATIONS = _struct(
    neighbor_call=_S, neighbor_state=_S, station_id=_S,
    distance_to_neighbor=_D, neighbor_lat=_D, neighbor_lon=_D,
)

# CSV lookups: all text, as in the files
TIMEZONES = _struct(code=_S, time_zone_id=_S)
SPECIAL_DAYS = _struct(SpecialDate=_S, SpecialDateType=_S, AssumedEffect_Text=_S)
PAGERANKS = _struct(id=_S, YEAR=_S, pagerank=_S)

METRICS_LOG = T.StructType(
    [
        T.StructField("date_time", T.TimestampType()),
        T.StructField("precision", _D),
        T.StructField("f0.5", _D),
        T.StructField("recall", _D),
        T.StructField("accuracy", _D),
        T.StructField("regParam", _D),
        T.StructField("elasticNetParam", _D),
        T.StructField("maxIter", _I),
        T.StructField("threshold", _D),
    ]
)
