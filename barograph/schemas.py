"""Fixed names and values of the feeds, stated once as plain data."""

from pyspark.sql import types as T

# --- Fixed values: dataset codes and their prefix -------------------------
DATASET_PREFIX = "imd_"
STATION_DATASET = "imd_Station_API"
AWS_DATASET = "imd_AWS_ARG"

# --- Fixed values: columns that only serve the feed's web page ------------
DISPLAY_COLUMNS = ["WEATHER_ICON", "WEATHER_MESSAGE", "BACKGROUND", "BACKGROUND_URL"]

# --- Fixed values: raw station column -> tidy column ----------------------
STATION_NAMES = {
    "Station": "stationName",
    "Station Id": "stationID",
    "Mean Sea Level Pressure": "meanSeaLevelPressure",
    "Wind Direction": "windDirection",
    "Wind Speed KMPH": "windSpeed",
    "Temperature": "temperature",
    "Weather Code": "weatherCode",
    "Nebulosity": "nebulosity",
    "Humidity": "humidity",
    "Last 24 hrs Rainfall": "last24hrsRainfall",
    "Feel Like": "feelLike",
    "Sunrise": "sunrise",
    "Sunset": "sunset",
    "Moonrise": "moonrise",
    "Moonset": "moonset",
}
AWS_NAMES = {"ID": "stationID"}

# --- Fixed values: column roles, by raw name ------------------------------
STATION_DATE, STATION_HOUR = "Date of Observation", "Time"
AWS_DATE, AWS_CLOCK = "DATE", "TIME"
MEASURES = [
    "Mean Sea Level Pressure",
    "Wind Speed KMPH",
    "Temperature",
    "Nebulosity",
    "Humidity",
    "Last 24 hrs Rainfall",
    "Feel Like",
]
STRIPPED = ["Station", "Sunset"]
CLOCKS = ["Sunrise", "Sunset", "Moonrise", "Moonset"]
UPPERCASED = ["Station"]

# The sixteen columns a station snapshot is expected to hold once its
# timestamp has been composed.
STATION_EXPECTED = ["timestamp", *STATION_NAMES]

# Columns without which a snapshot cannot be cleaned.
STATION_REQUIRED = [STATION_DATE, STATION_HOUR, "Station", *CLOCKS, *MEASURES]
AWS_REQUIRED = [AWS_DATE, AWS_CLOCK]

STATION_RAW = [STATION_DATE, STATION_HOUR, *STATION_NAMES, *DISPLAY_COLUMNS]
AWS_RAW = ["ID", AWS_DATE, AWS_CLOCK, *DISPLAY_COLUMNS]
RAW_COLUMNS = {STATION_DATASET: STATION_RAW, AWS_DATASET: AWS_RAW}

# --- Fixed values: supported forecast product -----------------------------
FORECAST_MODEL = "ifs"
FORECAST_RESOLUTION = "0p25"
FORECAST_TYPE = "oper"
FORECAST_LEADS = ["0h", "6h"]

# --- Fixed values: transfer policy ----------------------------------------
OK_STATUS = 200
RETRYABLE_STATUSES = [404, 429, 500, 502, 504]
FILE_RETRIES = 10
OBSERVATION_RETRIES = 3

# --- Fixed values: report colours -----------------------------------------
STATUS_COLOURS = {"SUCCESS": "green", "CRITICAL": "red", "ERROR": "orange"}


def text_schema(columns):
    """A schema in which every column is nullable text."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


STATION_CLEAN_SCHEMA = T.StructType(
    [T.StructField("timestamp", T.StringType())]
    + [
        T.StructField(tidy, T.DoubleType() if raw in MEASURES else T.StringType())
        for raw, tidy in STATION_NAMES.items()
    ]
)
