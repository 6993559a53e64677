"""Feeds derived from the given tables.

A feed is a list of (column, SQL expression) over one table. The expressions
run unchanged in Spark and in DuckDB, so both engines start from the same raw
values; everything after that is written twice, independently.
"""

from pyspark.sql import functions as F

# The number in an event's properties, 0 to 99: decides which oddity a raw
# value shows.
K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"
DAY = "CAST(CAST(ts AS DATE) AS STRING)"
COMPACT_DAY = f"replace({DAY}, '-', '')"


class Checks:
    """Named queries and the SQL that should give the same rows."""

    def __init__(self):
        self.queries, self.oracles = {}, {}

    def add(self, name, sql=None):
        def keep(run):
            self.queries[name] = run
            if sql is not None:
                self.oracles[name] = sql
            return run

        return keep


class Feed:
    def __init__(self, table, columns, where=None):
        self.table, self.columns, self.where = table, columns, where

    def read(self, spark, sf_dir):
        rows = spark.read.parquet(f"{sf_dir}/{self.table}.parquet")
        if self.table == "events":
            rows = rows.withColumn("k", F.expr(K))
        if self.where:
            rows = rows.filter(self.where)
        return rows.select(*[F.expr(sql).alias(name) for name, sql in self.columns.items()])

    @property
    def sql(self):
        source = self.table
        if self.table == "events":
            source = f"(SELECT *, {K} AS k FROM events)"
        chosen = ", ".join(f'{sql} AS "{name}"' for name, sql in self.columns.items())
        where = f" WHERE {self.where}" if self.where else ""
        return f"(SELECT {chosen} FROM {source}{where})"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_DISPLAY = {
    "WEATHER_ICON": "props",
    "WEATHER_MESSAGE": "event_type",
    "BACKGROUND": "'none'",
    "BACKGROUND_URL": "'none'",
}

_NUMBER = "CAST(value AS STRING)"

STATION = Feed(
    "events",
    {
        "Station": "concat(chr(13), chr(10), chr(9), ' ', event_type, ' ', "
        "CAST(user_id AS STRING), ' ', chr(9))",
        "Station Id": "concat('0', CAST(user_id AS STRING))",
        "Date of Observation": f"CASE WHEN k = 97 THEN 'bad' WHEN k = 96 THEN '' "
        f"WHEN k = 98 THEN '9999-12-31' ELSE {DAY} END",
        "Time": "CASE WHEN k = 95 THEN '24' WHEN k = 94 THEN NULL WHEN k = 93 THEN '123' "
        "WHEN k = 92 THEN '-1' WHEN k = 91 THEN '' ELSE CAST(hour(ts) AS STRING) END",
        "Mean Sea Level Pressure": f"CASE WHEN k < 5 THEN 'NA' ELSE {_NUMBER} END",
        "Wind Direction": "concat(event_type, ' ')",
        "Wind Speed KMPH": f"CASE WHEN k < 10 THEN '' WHEN k < 12 THEN '--' ELSE {_NUMBER} END",
        "Temperature": "CASE WHEN k < 10 THEN 'NA' WHEN k < 20 THEN '' WHEN k < 22 THEN '--' "
        "WHEN k = 22 THEN 'Trace' WHEN k = 23 THEN '1,000' WHEN k = 24 THEN 'NA ' "
        "WHEN k = 25 THEN '1d' WHEN k = 26 THEN 'nan' "
        f"WHEN k = 27 THEN concat(' ', {_NUMBER}, chr(9)) WHEN k = 28 THEN '1_000' "
        "WHEN k = 29 THEN '-1.5e3' WHEN k = 30 THEN '.5' WHEN k = 31 THEN '5.' "
        f"WHEN k = 32 THEN '0x10' WHEN k = 33 THEN '  ' ELSE {_NUMBER} END",
        "Weather Code": "concat('0', CAST(k AS STRING))",
        "Nebulosity": "CAST(k AS STRING)",
        "Humidity": "CASE WHEN k > 90 THEN NULL ELSE CAST(k AS STRING) END",
        "Last 24 hrs Rainfall": f"CASE WHEN k = 50 THEN 'na' ELSE {_NUMBER} END",
        "Feel Like": f"concat('-', {_NUMBER})",
        "Sunrise": "concat(CAST(k % 26 AS STRING), ':', CAST(minute(ts) + k % 3 AS STRING))",
        "Sunset": "concat(chr(13), ' ', CAST(hour(ts) AS STRING), ':', "
        "CAST(minute(ts) AS STRING), chr(10))",
        "Moonrise": "CASE WHEN k < 20 THEN ' 05:48' WHEN k < 30 THEN '05:48 ' "
        "WHEN k < 40 THEN '05:48:00' WHEN k < 50 THEN concat('10:47', chr(10)) "
        "ELSE concat('0', CAST(k % 12 AS STRING), ':', CAST(minute(ts) AS STRING)) END",
        "Moonset": "CASE WHEN k < 10 THEN 'NA' WHEN k < 20 THEN '' WHEN k < 30 THEN '0548' "
        "WHEN k < 40 THEN '--' ELSE concat(CAST(hour(ts) AS STRING), ':0') END",
        **_DISPLAY,
        "event_id": "event_id",
    },
)

AWS = Feed(
    "events",
    {
        "ID": "concat('A', CAST(user_id AS STRING))",
        "DATE": f"CASE WHEN k = 97 THEN 'bad' ELSE {DAY} END",
        "TIME": "CASE WHEN k = 90 THEN NULL WHEN k = 91 THEN '06:30' ELSE "
        "concat(CAST(k % 26 AS STRING), ':', CAST(minute(ts) AS STRING), ':', "
        "CASE WHEN k % 26 = 23 THEN '60' WHEN k = 59 THEN '61' WHEN k = 60 THEN '62' "
        "ELSE CAST(second(ts) AS STRING) END) END",
        "RAIN": _NUMBER,
        **_DISPLAY,
        "event_id": "event_id",
    },
)

OTHER = Feed("events", {"note": "props", **_DISPLAY, "event_id": "event_id"})

GRID = Feed(
    "lineitem",
    {
        "point_id": "l_orderkey * 8 + l_linenumber",
        "variable": "l_returnflag",
        "valid_time": "l_shipdate",
        "lat": "l_quantity",
        "lon": "CAST(l_linenumber AS DOUBLE) * 8 + l_tax * 50",
        "value": "l_extendedprice",
    },
)

REGIONS = Feed(
    "nation",
    {
        "region": "lower(n_name)",
        "north": "CAST(n_nationkey * 2 + 5 AS DOUBLE)",
        "west": "CAST(n_regionkey * 10 AS DOUBLE)",
        "south": "CAST(n_nationkey * 2 AS DOUBLE)",
        "east": "CAST(n_regionkey * 10 + 25 AS DOUBLE)",
    },
)

MESSAGES = Feed(
    "events",
    {
        "event_id": "event_id",
        "msg": "CASE WHEN k < 5 THEN '400 Bad Request. No date is known' "
        "WHEN k < 10 THEN concat('400 Bad Request. Data up to: ', "
        "substr(CAST(ts AS STRING), 1, 16), '. Try again') "
        "WHEN k < 20 THEN concat('400 Bad Request. Data up to: ', "
        "substr(CAST(ts AS STRING), 1, 16), '  ') "
        "WHEN k < 25 THEN concat('400 Bad Request. Data up to: ', "
        "substr(CAST(ts AS STRING), 1, 10), ' 25:00') "
        "ELSE concat('400 Client Error. The latest date available for this dataset is: ', "
        "substr(CAST(ts AS STRING), 1, 16)) END",
    },
)

HREFS = Feed(
    "events",
    {
        "event_id": "event_id",
        "source": "CAST(user_id AS STRING)",
        "href": "CASE WHEN k < 10 THEN '../' WHEN k < 20 THEN '/forecasts/readme/' "
        "WHEN k < 25 THEN '/forecasts/20241301/' WHEN k < 30 THEN '/' "
        f"ELSE concat('/forecasts/', {COMPACT_DAY}, '/') END",
    },
)

LISTINGS = Feed(
    "events",
    {
        "source": "concat('https://data.example/', CAST(user_id AS STRING))",
        "html": "CASE WHEN k < 10 THEN '<a href=\"../\">up</a><!-- <a href=\"/f/20991231/\">x</a> -->' "
        f"WHEN k < 40 THEN concat('<p>runs</p><A class=\"d\" HREF=''/f/', {COMPACT_DAY}, '/''>x</A>') "
        f"ELSE concat('<a href=\"/f/', {COMPACT_DAY}, '/\">x</a> <a href=\"/f/readme\">y</a>') END",
    },
)

FORECASTS = Feed(
    "events",
    {
        "event_id": "event_id",
        "base": "'https://data.example/forecasts'",
        "run_date": "CAST(ts AS DATE)",
        "zulu": "CASE WHEN k < 50 THEN '00z' ELSE '12z' END",
        "model": "CASE WHEN k < 10 THEN 'aifs' WHEN k < 12 THEN NULL ELSE 'ifs' END",
        "resolution": "CASE WHEN k < 20 THEN '0p4' ELSE '0p25' END",
        "forecast_type": "CASE WHEN k < 30 THEN 'enfo' ELSE 'oper' END",
    },
)

FILES = Feed(
    "documents",
    {
        "path": "concat('/data/', source, '/', lang, '/doc_', CAST(doc_id AS STRING), "
        "CASE lang WHEN 'en' THEN '.nc' WHEN 'de' THEN '.grib2' WHEN 'fr' THEN '' ELSE 'nc' END)",
        "length": "n_chars",
    },
)

TRANSFERS = Feed(
    "events",
    {
        "prefix": "CAST(user_id AS STRING)",
        "key": "concat(CAST(user_id AS STRING), '/', CAST(event_id AS STRING))",
        "ok": "k >= 2",
        "region": "event_type",
        "ts": "ts",
    },
)

ATTEMPTS = Feed(
    "events",
    {
        "file": "concat(CAST(user_id AS STRING), '-', event_type)",
        "attempt": "event_id",
        "status_code": "CASE WHEN k < 40 THEN 200 WHEN k < 50 THEN 404 WHEN k < 55 THEN 503 "
        "WHEN k < 65 THEN 429 WHEN k < 70 THEN 403 WHEN k < 80 THEN 504 WHEN k < 90 THEN 502 "
        "WHEN k = 99 THEN 1001 ELSE 500 END",
    },
)

ENTRIES = Feed(
    "events",
    {
        "job": "event_type",
        "run_date": COMPACT_DAY,
        "seq": "event_id",
        "component": "concat('part ', CAST(user_id AS STRING))",
        "status": "CASE WHEN k = 7 THEN 'CRITICAL' WHEN k IN (8, 9) THEN 'ERROR' ELSE 'SUCCESS' END",
        "comments": "props",
    },
)
