"""Column roles, feature sets and constants of the flight-delay data model."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# They must equal the published data model for right results.
# ---------------------------------------------------------------------------

LABEL = "DEP_DEL15"
HOLDOUT_YEAR = 2021
SAMPLE_SEED = 261

MAX_WIND_SPEED = 200
WEATHER_LEAD_HOURS = 2
OBSERVATION_SHIFT_HOURS = 1
MIN_TURNAROUND_MINUTES = 120
STATION_PREFIX = "K"

NO_SPECIAL_DAY = "NONE"
TIER_LOW_DELAY = "AboveAverage"
TIER_MIDDLE = "Average"
TIER_HIGH_DELAY = "BelowAverage"
TIER_QUANTILES = (0.25, 0.75)

RESET_PROBABILITY = 0.15
PAGERANK_TOLERANCE = 0.01

CV_BLOCKS = 4
TRAIN_SHARE = 0.7

# flag column -> substring looked for in the joined weather codes
WEATHER_FLAGS = {
    "Blowing_Snow": "BLSN",
    "Freezing_Rain": "FZRA",
    "Rain": "RA",
    "Snow": "SN",
    "Thunder": "TS",
}

# kind of special day -> assumed effect on traffic
SPECIAL_DAY_EFFECTS = {
    "NewYear": "NotBusy",
    "Thanksgiving_m1": "Busy",
    "Thanksgiving": "NotBusy",
    "SunAfterThanksgiving": "Busy",
    "Christmas_m3": "Christmas_m3",
    "Christmas_m2": "Christmas_m2",
    "Christmas_m1": "Christmas_m1",
    "Christmas": "NotBusy",
    "Christmas_p1": "Christmas_p1",
    "Christmas_p2": "Christmas_p2",
    "Christmas_p3": "Christmas_p3",
    "MA_ShelterInPlace": "NotBusy",
}


WEATHER_MEASURES = [
    "HourlyAltimeterSetting", "HourlyDewPointTemperature", "HourlyWetBulbTemperature",
    "HourlyDryBulbTemperature", "HourlyPrecipitation", "HourlyStationPressure",
    "HourlySeaLevelPressure", "HourlyRelativeHumidity", "HourlyVisibility", "HourlyWindSpeed",
]

FLIGHT_ID_PARTS = [
    "ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID", "FL_DATE",
    "OP_CARRIER_FL_NUM", "OP_UNIQUE_CARRIER", "DEP_TIME_CLEANED",
]

# The published ranges of years.
CORRELATION_PERIODS = {
    "all": None,
    "2016-2019": (2016, 2019),
    "2018-2019": (2018, 2019),
    "2020": (2020, 2020),
    "2021": (2021, 2021),
}


@dataclass(frozen=True)
class FeatureSet:
    """Categorical and numeric inputs of one model family."""

    name: str
    categoricals: tuple[str, ...]
    numerics: tuple[str, ...]
    label: str = LABEL
    columns: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "columns", self.categoricals + self.numerics)


# The published feature sets.
_CALENDAR = ("QUARTER", "MONTH", "DAY_OF_WEEK", "OP_UNIQUE_CARRIER", "DEP_HOUR")
_FLAGS = tuple(WEATHER_FLAGS)
_WEATHER = ("ELEVATION",) + tuple(WEATHER_MEASURES)

FEATURE_SETS = {
    "full": FeatureSet(
        "full",
        _CALENDAR + ("AssumedEffect_Text", "airline_type", "is_prev_delayed") + _FLAGS,
        ("DISTANCE",) + _WEATHER + ("perc_delay", "pagerank"),
    ),
    "baseline": FeatureSet(
        "baseline",
        ("QUARTER", "MONTH", "DAY_OF_WEEK", "OP_UNIQUE_CARRIER"),
        ("DISTANCE",) + _WEATHER,
    ),
    "no_weather": FeatureSet(
        "no_weather",
        _CALENDAR + ("AssumedEffect_Text", "airline_type", "is_prev_delayed"),
        ("DISTANCE", "ELEVATION", "perc_delay", "pagerank"),
    ),
    "only_weather": FeatureSet("only_weather", _FLAGS, tuple(WEATHER_MEASURES)),
}

# --- fixed values: the published searches ---
PUBLISHED_GRIDS = {
    "lr": {"regParam": [0.0, 0.01, 0.5, 1.0, 2.0], "elasticNetParam": [0.0, 0.5, 1.0], "maxIter": [5, 10, 50]},
    "lr_baseline": {"regParam": [0.0, 0.01, 0.5, 2.0], "elasticNetParam": [0.0, 0.5, 1.0], "maxIter": [5, 10]},
    "gbt": {"maxIter": [5, 10], "maxDepth": [16, 8, 4], "maxBins": [128, 32, 16], "stepSize": [0.5, 0.1]},
    "svm": {"regParam": [0.0, 0.01, 0.5, 2.0], "maxIter": [5, 10, 50]},
}
PUBLISHED_THRESHOLDS = {
    "lr": [0.5, 0.6, 0.7, 0.8],
    "lr_baseline": [0.5, 0.6, 0.7],
    "gbt": [0.5, 0.6, 0.7],
    "svm": [0.5, 0.6, 0.7, 0.8],
}
