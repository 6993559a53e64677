"""Cleaning of station observations."""

from pyspark.sql import functions as F

from barograph import schemas as S
from barograph.functions import (
    column,
    compose_timestamp,
    compose_timestamp_aws,
    is_hour,
    measure_number,
    normalise_clock,
    null_tokens,
    pad_hour,
    parse_clock_hms,
    parse_date,
    strip_controls,
    upper_name,
)
from barograph.operators import clean
from barograph.sources import dataset_filter
from checks.feeds import AWS, DAY, OTHER, STATION, Checks, Feed

CHECKS = Checks()

# --- The same rules in DuckDB's words ---------------------------------------


def q(name):
    return f'"{name}"'


def day_sql(text):
    day = f"CAST(try_strptime({text}, '%Y-%m-%d') AS DATE)"
    return (
        f"CASE WHEN {day} BETWEEN DATE '1677-09-22' AND DATE '2262-04-11' THEN {day} END"
    )


def hour_sql(text):
    return f"CASE WHEN length({text}) < 2 THEN lpad({text}, 2, '0') ELSE {text} END"


def valid_hour_sql(text):
    return f"coalesce(try_cast({text} AS INT) BETWEEN 0 AND 23 AND length({text}) <= 2, {text} = '')"


def clock_sql(text):
    return (
        f"CASE WHEN regexp_full_match({text}, '[0-9]{{1,2}}:[0-9]{{1,2}}') "
        f"THEN strftime(try_strptime({text}, '%H:%M'), '%H:%M') END"
    )


def hms_sql(text):
    part = [f"try_cast(split_part({text}, ':', {i}) AS INT)" for i in (1, 2, 3)]
    return (
        f"CASE WHEN regexp_full_match({text}, '[0-9]{{1,2}}:[0-9]{{1,2}}:[0-9]{{1,2}}') "
        f"AND {part[0]} < 24 AND {part[1]} < 60 AND {part[2]} < 62 THEN "
        f"strftime(TIMESTAMP '1900-01-01 00:00:00' + to_hours({part[0]}) "
        f"+ to_minutes({part[1]}) + to_seconds({part[2]}), '%H:%M:%S') END"
    )


STRIP = "trim({}, chr(13) || chr(10) || chr(9) || ' ')"


def number_sql(text):
    """Value of a measure; the feed's oddities are told apart one by one."""
    bare = f"replace(trim({text}, ' ' || chr(9)), '_', '')"
    return f"CASE WHEN regexp_full_match({bare}, '[-+0-9.eE]+') THEN try_cast({bare} AS DOUBLE) END"


def bad_number_sql(text):
    return f"({text} NOT IN ('NA', '', 'nan') AND ({number_sql(text)}) IS NULL)"


def reasons_sql(parts):
    cases = ", ".join(f"CASE WHEN {bad} THEN '{reason}' END" for reason, bad in parts)
    return f"concat_ws(',', {cases})"


STATION_DAY = day_sql(q("Date of Observation"))
STATION_HOUR = hour_sql(q("Time"))
STATION_STAMP = (
    f"CASE WHEN {valid_hour_sql(q('Time'))} THEN "
    f"strftime({STATION_DAY}, '%Y-%m-%d') || 'T' || {STATION_HOUR} || ':00:00.00+05:30' END"
)
AWS_DAY, AWS_CLOCK = day_sql(q("DATE")), hms_sql(q("TIME"))
AWS_STAMP = f"strftime({AWS_DAY}, '%Y-%m-%d') || 'T' || {AWS_CLOCK} || '.00+05:30'"


def station_column_sql(name):
    text = q(name)
    if name == "Station":
        return f"upper({STRIP.format(text)})"
    if name == "Sunset":
        return clock_sql(STRIP.format(text))
    if name in ("Sunrise", "Moonrise", "Moonset"):
        return clock_sql(text)
    if name in S.MEASURES:
        return number_sql(text)
    return text


STATION_TIDY = ", ".join(
    [f"{STATION_STAMP} AS timestamp"]
    + [f"{station_column_sql(raw)} AS {q(tidy)}" for raw, tidy in S.STATION_NAMES.items()]
    + ["event_id"]
)
AWS_TIDY = f'{AWS_STAMP} AS timestamp, "ID" AS "stationID", "RAIN", event_id'


def station(spark, sf_dir):
    return STATION.read(spark, sf_dir)


def aws(spark, sf_dir):
    return AWS.read(spark, sf_dir)


# --- Fields -----------------------------------------------------------------


@CHECKS.add("clean_station", f"SELECT {STATION_TIDY} FROM {STATION.sql}")
def clean_station(spark, sf_dir):
    return clean.clean_station(station(spark, sf_dir))


@CHECKS.add("clean_aws", f"SELECT {AWS_TIDY} FROM {AWS.sql}")
def clean_aws(spark, sf_dir):
    return clean.clean_aws(aws(spark, sf_dir))


@CHECKS.add(
    "drop_columns",
    f"SELECT * EXCLUDE (\"WEATHER_ICON\", \"WEATHER_MESSAGE\", \"BACKGROUND\", \"BACKGROUND_URL\") "
    f"FROM {AWS.sql}",
)
def drop_columns(spark, sf_dir):
    return clean.drop_columns(aws(spark, sf_dir), strict=True)


@CHECKS.add("parse_date", f"SELECT event_id, {STATION_DAY} AS day FROM {STATION.sql}")
def date(spark, sf_dir):
    return station(spark, sf_dir).select(
        "event_id", parse_date(column(S.STATION_DATE)).alias("day")
    )


@CHECKS.add("pad_hour", f"SELECT event_id, {STATION_HOUR} AS hour FROM {STATION.sql}")
def hour(spark, sf_dir):
    return station(spark, sf_dir).select("event_id", pad_hour(F.col("Time")).alias("hour"))


@CHECKS.add("parse_clock_hms", f"SELECT event_id, {AWS_CLOCK} AS clock FROM {AWS.sql}")
def clock_hms(spark, sf_dir):
    return aws(spark, sf_dir).select("event_id", parse_clock_hms(F.col("TIME")).alias("clock"))


@CHECKS.add("compose_timestamp", f"SELECT event_id, {STATION_STAMP} AS timestamp FROM {STATION.sql}")
def timestamp(spark, sf_dir):
    padded = pad_hour(F.col("Time"))
    stamp = compose_timestamp(parse_date(column(S.STATION_DATE)), F.when(is_hour(padded), padded))
    return station(spark, sf_dir).select("event_id", stamp.alias("timestamp"))


@CHECKS.add("compose_timestamp_aws", f"SELECT event_id, {AWS_STAMP} AS timestamp FROM {AWS.sql}")
def timestamp_aws(spark, sf_dir):
    stamp = compose_timestamp_aws(parse_date(F.col("DATE")), parse_clock_hms(F.col("TIME")))
    return aws(spark, sf_dir).select("event_id", stamp.alias("timestamp"))


@CHECKS.add(
    "strip_controls",
    f"SELECT event_id, {STRIP.format(q('Station'))} AS station, "
    f"{STRIP.format(q('Sunset'))} AS sunset FROM {STATION.sql}",
)
def strip(spark, sf_dir):
    return station(spark, sf_dir).select(
        "event_id",
        strip_controls(F.col("Station")).alias("station"),
        strip_controls(F.col("Sunset")).alias("sunset"),
    )


@CHECKS.add(
    "normalise_clock",
    "SELECT event_id, "
    + ", ".join(f"{clock_sql(q(name))} AS {name.lower()}" for name in S.CLOCKS)
    + f" FROM {STATION.sql}",
)
def clock(spark, sf_dir):
    clocks = [normalise_clock(F.col(name)).alias(name.lower()) for name in S.CLOCKS]
    return station(spark, sf_dir).select("event_id", *clocks)


@CHECKS.add(
    "rename_columns",
    "SELECT " + ", ".join(f"{q(a)} AS {q(b)}" for a, b in S.STATION_NAMES.items())
    + f", event_id FROM {STATION.sql}",
)
def rename(spark, sf_dir):
    raw = station(spark, sf_dir).select(*[column(name) for name in S.STATION_NAMES], "event_id")
    return clean.rename_columns(raw)


@CHECKS.add(
    "null_tokens",
    f"SELECT event_id, nullif(nullif({q('Temperature')}, 'NA'), '') AS temperature, "
    f"nullif(nullif({q('Last 24 hrs Rainfall')}, 'NA'), '') AS rainfall FROM {STATION.sql}",
)
def tokens(spark, sf_dir):
    return station(spark, sf_dir).select(
        "event_id",
        null_tokens(F.col("Temperature")).alias("temperature"),
        null_tokens(column("Last 24 hrs Rainfall")).alias("rainfall"),
    )


@CHECKS.add(
    "cast_measures",
    "SELECT event_id, "
    + ", ".join(f"{number_sql(q(name))} AS {q(S.STATION_NAMES[name])}" for name in S.MEASURES)
    + f" FROM {STATION.sql}",
)
def measures(spark, sf_dir):
    numbers = [
        measure_number(column(name)).alias(S.STATION_NAMES[name])
        for name in S.MEASURES
    ]
    return station(spark, sf_dir).select("event_id", *numbers)


PLACES = Feed("documents", {"doc_id": "doc_id", "name": "concat(lang, ' ', text)"})


@CHECKS.add("upper_name", f"SELECT doc_id, upper(replace(name, 'ß', 'SS')) AS name FROM {PLACES.sql}")
def upper(spark, sf_dir):
    return PLACES.read(spark, sf_dir).select("doc_id", upper_name(F.col("name")).alias("name"))


STAMPED = Feed("events", {**AWS.columns, "timestamp": DAY})


@CHECKS.add("column_order", f"SELECT timestamp, \"ID\", \"RAIN\", event_id FROM {STAMPED.sql}")
def order(spark, sf_dir):
    raw = STAMPED.read(spark, sf_dir).select("ID", "DATE", "TIME", "RAIN", "event_id", "timestamp")
    return clean.column_order(raw, dropped=("DATE", "TIME"))


# --- Whole feeds --------------------------------------------------------------

STATION_PART = Feed("events", STATION.columns, "event_type IN ('click', 'view')")
AWS_PART = Feed("events", AWS.columns, "event_type IN ('signup', 'purchase')")
OTHER_PART = Feed("events", OTHER.columns, "event_type = 'error'")


BY_DATASET_SQL = (
    f"SELECT 'imd_Station_API' AS dataset, {STATION_TIDY} FROM {STATION_PART.sql} "
    f"UNION ALL BY NAME SELECT 'imd_AWS_ARG' AS dataset, {AWS_TIDY} FROM {AWS_PART.sql} "
    f"UNION ALL BY NAME SELECT 'imd_Other' AS dataset, note, event_id FROM {OTHER_PART.sql}"
)
PARTS = {S.STATION_DATASET: STATION_PART, S.AWS_DATASET: AWS_PART, "imd_Other": OTHER_PART}


def mixed_records(spark, sf_dir):
    """One table of all three feeds: a record's dataset, its raw values as a map, and its event."""
    raw = Feed("events", {"event_id": "event_id", "k": "k", "ts": "ts", "props": "props", "user_id": "user_id", "value": "value", "event_type": "event_type"})
    code = record = None
    for name, feed in PARTS.items():
        here = F.expr(feed.where)
        pairs = [x for n, sql in feed.columns.items() if n != "event_id" for x in (F.lit(n), F.expr(sql))]
        values = F.create_map(*pairs)
        code = F.when(here, name) if code is None else code.when(here, name)
        record = F.when(here, values) if record is None else record.when(here, values)
    return raw.read(spark, sf_dir).select("event_id", code.alias("dataset"), record.alias("record"))


@CHECKS.add("clean_by_dataset", BY_DATASET_SQL)
def by_dataset(spark, sf_dir):
    columns = {code: [n for n in feed.columns if n != "event_id"] for code, feed in PARTS.items()}
    return clean.clean_records(mixed_records(spark, sf_dir), columns)


@CHECKS.add("clean_feeds_apart", BY_DATASET_SQL)
def feeds_apart(spark, sf_dir):
    return clean.clean_by_dataset({code: feed.read(spark, sf_dir) for code, feed in PARTS.items()})


# Which of the expected columns a feed has once it is tidy, told from its columns alone.
@CHECKS.add(
    "expected_columns_of_feeds",
    " UNION ALL ".join(
        f"SELECT '{code}' AS dataset, '{name}' AS \"column\", {str(has).lower()} AS present"
        for code, tidy in (("station", [*S.STATION_NAMES.values(), *S.STATION_NAMES]), ("aws", ["stationID", "ID"]))
        for name in S.STATION_EXPECTED
        for has in [name == "timestamp" or (name in S.STATION_NAMES if code == "station" else name in ("ID",))]
    ),
)
def expected_of_feeds(spark, sf_dir):
    found = clean.expected_columns(station(spark, sf_dir), "station")
    return found.unionByName(clean.expected_columns(aws(spark, sf_dir), "aws"))


STATION_REASONS = reasons_sql(
    [("date", f"({STATION_DAY}) IS NULL"), ("time", f"NOT coalesce({valid_hour_sql(q('Time'))}, false)")]
    + [(S.STATION_NAMES[name], bad_number_sql(q(name))) for name in S.MEASURES]
)
AWS_REASONS = reasons_sql(
    [("date", f"({AWS_DAY}) IS NULL"), ("time", f"({AWS_CLOCK}) IS NULL")]
)


@CHECKS.add(
    "reject_rows",
    f"SELECT * FROM (SELECT 'station' AS feed, event_id, {STATION_REASONS} AS reasons "
    f"FROM {STATION.sql} UNION ALL SELECT 'aws' AS feed, event_id, {AWS_REASONS} AS reasons "
    f"FROM {AWS.sql}) WHERE reasons <> ''",
)
def rejects(spark, sf_dir):
    def named(df, name):
        reasons = F.array_join("reject_reasons", ",").alias("reasons")
        return df.select(F.lit(name).alias("feed"), "event_id", reasons)

    stations = clean.reject_rows(station(spark, sf_dir))
    automatic = clean.reject_rows(aws(spark, sf_dir), S.AWS_DATASET)
    return named(stations, "station").unionByName(named(automatic, "aws"))


MOMENTS = Feed("events", {"event_id": "event_id", "ts": "ts"})


@CHECKS.add(
    "snapshot_label",
    "SELECT event_id, ts, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS timecode, "
    "strftime(ts, '%Y_%m_%d') AS snap_date, strftime(date_trunc('hour', ts), '%H_%M_%S') AS snap_time "
    f"FROM {MOMENTS.sql}",
)
def labels(spark, sf_dir):
    return clean.snapshot_label(MOMENTS.read(spark, sf_dir))


DATASETS = Feed(
    "events",
    {
        "event_id": "event_id",
        "dataset": "CASE event_type WHEN 'click' THEN 'imd_Station_API' WHEN 'view' THEN "
        "'imd_AWS_ARG' WHEN 'error' THEN 'cds' WHEN 'signup' THEN 'IMD_upper' ELSE 'shared' END",
    },
)


@CHECKS.add(
    "dataset_filter",
    f"SELECT event_id, dataset FROM {DATASETS.sql} WHERE substr(dataset, 1, 4) = 'imd_'",
)
def datasets(spark, sf_dir):
    return dataset_filter(DATASETS.read(spark, sf_dir))
