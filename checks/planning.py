"""Request planning and discovery of what is available."""

from pyspark.sql import functions as F

from barograph.functions import object_key, object_prefix, output_name, sidecar_name
from barograph.operators import availability, requests
from barograph.plans import (
    forecast_verdict,
    month_to_date_requests,
    plan_forecast,
    plan_requests,
    published_runs,
)
from barograph.session import scratch_dir
from barograph.sinks import write_ledger
from barograph.sources import listing_links, region_dims, variable_dims
from checks.feeds import (
    FORECASTS,
    HREFS,
    LISTINGS,
    MESSAGES,
    Checks,
    Feed,
    table,
)

CHECKS = Checks()

# --- Configurations: one per supplier, spanning its shipments ------------------

SPANS = (
    "SELECT l_suppkey, CAST(CAST(min(l_shipdate) AS DATE) AS STRING) AS start_date, "
    "CAST(CAST(max(l_shipdate) AS DATE) AS STRING) AS end_date FROM lineitem GROUP BY l_suppkey"
)
CONFIG = {
    "ds_id": "concat('DS', CAST(l_suppkey AS STRING))",
    "ds_name": "'Single_Level'",
    "ds_source": "'store'",
    "folder_name": "'all'",
    "extension": "'nc'",
    "start_date": "start_date",
    "end_date": "CASE WHEN l_suppkey = 3 THEN 'None' WHEN l_suppkey = 4 THEN '1990-01-31' "
    "ELSE end_date END",
}
BOUNDS = {"north_hill": [18.5, 73.5, 11.5, 78.5], "south_bay": [13.5, 76.5, 8.5, 80.5]}
VARIABLES = {"soil_wetness": "sw", "snow_depth": "sd", "sea_state": "ss"}

CONFIG_SQL = "(SELECT {} FROM ({}))".format(
    ", ".join(f"{sql} AS {name}" for name, sql in CONFIG.items()), SPANS
)
REGION_SQL = "(VALUES {}) r(region, north, west, south, east)".format(
    ", ".join(
        f"('{name}', " + ", ".join(f"CAST({edge} AS DOUBLE)" for edge in box) + ")"
        for name, box in BOUNDS.items()
    )
)
VARIABLE_SQL = "(VALUES {}) v(variable, code)".format(
    ", ".join(f"('{name}', '{code}')" for name, code in VARIABLES.items())
)
GRID_SQL = (
    "(SELECT c.ds_id, c.ds_name, c.ds_source, c.folder_name, c.extension, r.*, v.*, "
    "strftime(m, '%Y') AS year, strftime(m, '%m') AS month, "
    "upper(region) || '_' || strftime(m, '%Y_%m') || '_' || code || '.' || extension AS filename "
    f"FROM (SELECT * FROM (SELECT * REPLACE (try_cast(start_date AS DATE) AS start_date, "
    f"try_cast(end_date AS DATE) AS end_date) FROM {CONFIG_SQL}) WHERE start_date <= end_date) c, "
    f"{REGION_SQL}, {VARIABLE_SQL}, "
    "generate_series(date_trunc('month', start_date), end_date, INTERVAL 1 MONTH) g(m))"
)


def configs(spark, sf_dir, bounds=None, variables=None):
    spans = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.min("l_shipdate").cast("date").cast("string").alias("start_date"),
        F.max("l_shipdate").cast("date").cast("string").alias("end_date"),
    )
    boxes = [
        F.array(*[F.lit(edge) for edge in box]) for box in (bounds or BOUNDS).values()
    ]
    names = [F.lit(name) for name in (bounds or BOUNDS)]
    codes = [F.lit(x) for pair in (variables or VARIABLES).items() for x in pair]
    return spans.select(
        *[F.expr(sql).alias(name) for name, sql in CONFIG.items()],
        F.map_from_arrays(F.array(*names), F.array(*boxes)).alias("bounds"),
        F.create_map(*codes).alias("variables"),
    )


@CHECKS.add(
    "config_dims",
    f"SELECT 'region' AS dim, ds_id, region AS name, north, west, south, east, "
    f"CAST(NULL AS VARCHAR) AS code FROM {CONFIG_SQL}, {REGION_SQL} "
    f"UNION ALL SELECT 'variable', ds_id, variable, NULL, NULL, NULL, NULL, code "
    f"FROM {CONFIG_SQL}, {VARIABLE_SQL}",
)
def config_dims(spark, sf_dir):
    rows = configs(spark, sf_dir).select("ds_id", "bounds", "variables")
    regions = region_dims(rows.drop("variables")).withColumnRenamed("region", "name")
    variables = variable_dims(rows.drop("bounds")).withColumnRenamed("variable", "name")
    return (
        regions.withColumn("dim", F.lit("region"))
        .unionByName(variables.withColumn("dim", F.lit("variable")), allowMissingColumns=True)
    )


@CHECKS.add("request_grid", f"SELECT * FROM {GRID_SQL}")
def request_grid(spark, sf_dir):
    return requests.request_grid(requests.date_ranges(configs(spark, sf_dir)))


@CHECKS.add(
    "rejected_ranges",
    f"SELECT ds_id, 'end_date' AS reasons FROM {CONFIG_SQL} WHERE try_cast(end_date AS DATE) IS NULL",
)
def rejected_ranges(spark, sf_dir):
    rejected = requests.rejected_ranges(configs(spark, sf_dir))
    return rejected.select("ds_id", F.array_join("reject_reasons", ",").alias("reasons"))


# What is there already: the files of every month in which a supplier's goods
# came back.
RETURNED = (
    "(SELECT DISTINCT concat('DS', CAST(l_suppkey AS STRING)) AS ds_id, strftime(l_shipdate, '%Y') AS year, "
    "strftime(l_shipdate, '%m') AS month FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)"
)


@CHECKS.add(
    "requests_to_run",
    "SELECT ds_id, filename, format('{}-Single_Level/all/{}/{}', ds_id, upper(region), filename) AS object_key "
    f"FROM {GRID_SQL} g WHERE NOT EXISTS (SELECT 1 FROM {RETURNED} x WHERE x.ds_id = g.ds_id "
    "AND x.year = g.year AND x.month = g.month)",
)
def requests_to_run(spark, sf_dir):
    returned = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R' AND l_quantity > 45")
    units = returned.select(
        F.concat(F.lit("DS"), F.col("l_suppkey").cast("string")).alias("ds_id"),
        F.date_format("l_shipdate", "yyyy").alias("year"),
        F.date_format("l_shipdate", "MM").alias("month"),
        F.explode(F.array(*[F.lit(name) for name in BOUNDS])).alias("region"),
    )
    units = units.withColumn("code", F.explode(F.array(*[F.lit(code) for code in VARIABLES.values()])))
    prefix = object_prefix("ds_id", F.lit("Single_Level"), F.lit("all"), F.upper("region"))
    name = output_name("region", "year", "month", "code", F.lit("nc"))
    existing = units.select(object_key(prefix, name).alias("object_key"))
    planned = plan_requests(configs(spark, sf_dir), existing, overwrite=False)
    return planned.select("ds_id", "filename", "object_key")


RANGES = Feed(
    "orders",
    {
        "o_orderkey": "o_orderkey",
        "start_date": "CAST(o_orderdate AS DATE)",
        "end_date": "CAST(CASE o_orderpriority WHEN '1-URGENT' THEN TIMESTAMP '1998-01-10 00:00:00' "
        "WHEN '2-HIGH' THEN NULL ELSE TIMESTAMP '1999-06-30 00:00:00' END AS DATE)",
    },
)


@CHECKS.add(
    "expand_months",
    "SELECT o_orderkey, start_date, end_date, strftime(m, '%Y') AS year, strftime(m, '%m') AS month "
    f"FROM (SELECT * FROM {RANGES.sql} WHERE start_date <= end_date), "
    "generate_series(date_trunc('month', start_date), end_date, INTERVAL 1 MONTH) g(m)",
)
def expand_months(spark, sf_dir):
    return requests.expand_months(RANGES.read(spark, sf_dir))


@CHECKS.add(
    "month_to_date",
    "SELECT user_id, max(ts) AS latest, CAST(date_trunc('month', max(ts)) AS DATE) AS start_date, "
    "CAST(max(ts) AS DATE) AS end_date FROM events GROUP BY user_id",
)
def month_to_date(spark, sf_dir):
    latest = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("latest"))
    return requests.month_to_date(latest)


REQUESTS = Feed(
    "orders",
    {
        "region": "CASE WHEN o_orderstatus = 'F' THEN 'ka' ELSE 'in_all' END",
        "year": "substr(CAST(o_orderdate AS STRING), 1, 4)",
        "month": "substr(CAST(o_orderdate AS STRING), 6, 2)",
        "variable": "substr(o_orderpriority, 3)",
        "ds_id": "'DS1'",
        "ds_name": "'Single_Level'",
        "folder_name": "'all'",
        "filename": "concat(CAST(o_orderkey AS STRING), '.nc')",
        "o_orderkey": "o_orderkey",
    },
)


@CHECKS.add(
    "request_days",
    "SELECT o_orderkey, (SELECT string_agg(lpad(CAST(i AS VARCHAR), 2, '0'), ' ' ORDER BY i) "
    f"FROM range(1, 32) t(i)) AS days, CAST(31 AS INT) AS n FROM {REQUESTS.sql}",
)
def request_days(spark, sf_dir):
    days = requests.request_days(REQUESTS.read(spark, sf_dir))
    return days.select("o_orderkey", F.array_join("days", " ").alias("days"), F.size("days").alias("n"))


CODES = "(VALUES ('URGENT', 'u'), ('HIGH', 'h'), ('MEDIUM', 'm')) c(variable, code)"


@CHECKS.add(
    "variable_code",
    f"SELECT o_orderkey, variable, code FROM {REQUESTS.sql} LEFT JOIN {CODES} USING (variable)",
)
def variable_code(spark, sf_dir):
    codes = spark.createDataFrame(
        [("URGENT", "u"), ("HIGH", "h"), ("MEDIUM", "m")], "variable string, code string"
    )
    rows = REQUESTS.read(spark, sf_dir).select("o_orderkey", "variable")
    return requests.variable_code(rows, codes)


# Orders name their variable by priority and their code by status, so most variables have several codes.
PAIRED = Feed(
    "orders",
    {
        "variable": "substr(o_orderpriority, 3)",
        "code": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'u' ELSE lower(o_orderstatus) END",
    },
)


@CHECKS.add(
    "ambiguous_codes",
    "SELECT variable, array_to_string(list_sort(list(DISTINCT code)), ',') AS codes "
    f"FROM {PAIRED.sql} GROUP BY variable HAVING count(DISTINCT code) > 1",
)
def ambiguous(spark, sf_dir):
    found = requests.ambiguous_codes(PAIRED.read(spark, sf_dir))
    return found.select("variable", F.array_join("codes", ",").alias("codes"))


@CHECKS.add(
    "variable_code_ambiguous",
    "SELECT o_orderkey, variable, CASE WHEN n = 1 THEN code ELSE variable END AS code FROM "
    f"{REQUESTS.sql} JOIN (SELECT variable, count(DISTINCT code) AS n, min(code) AS code FROM {PAIRED.sql} "
    "GROUP BY variable) USING (variable)",
)
def variable_code_ambiguous(spark, sf_dir):
    rows = REQUESTS.read(spark, sf_dir).select("o_orderkey", "variable")
    return requests.variable_code(rows, PAIRED.read(spark, sf_dir))


@CHECKS.add(
    "output_name",
    "SELECT o_orderkey, format('{}_{}_{}_{}.nc', upper(region), year, month, variable) AS name "
    f"FROM {REQUESTS.sql}",
)
def names(spark, sf_dir):
    name = output_name("region", "year", "month", "variable", F.lit("nc"))
    return REQUESTS.read(spark, sf_dir).select("o_orderkey", name.alias("name"))


@CHECKS.add(
    "object_key",
    "SELECT o_orderkey, format('{}-{}/{}/{}/{}', ds_id, ds_name, folder_name, upper(region), filename) "
    "AS object_key, format('/data/bucket/{}-{}/{}/{}', ds_id, ds_name, folder_name, upper(region)) "
    f"AS local_dir FROM {REQUESTS.sql}",
)
def keys(spark, sf_dir):
    prefix = object_prefix("ds_id", "ds_name", "folder_name", F.upper("region"))
    return REQUESTS.read(spark, sf_dir).select(
        "o_orderkey",
        object_key(prefix, F.col("filename")).alias("object_key"),
        F.concat_ws("/", F.lit("/data"), F.lit("bucket"), prefix).alias("local_dir"),
    )


EXISTING = Feed("lineitem", {"filename": "concat(CAST(l_orderkey AS STRING), '.nc')"}, "l_quantity > 30")


@CHECKS.add(
    "skip_existing",
    f"SELECT 'skip' AS way, o_orderkey, filename, false AS replaces FROM {REQUESTS.sql} "
    f"WHERE filename NOT IN (SELECT filename FROM {EXISTING.sql}) "
    f"UNION ALL SELECT 'overwrite', o_orderkey, filename, "
    f"filename IN (SELECT filename FROM {EXISTING.sql}) FROM {REQUESTS.sql}",
)
def skip_existing(spark, sf_dir):
    wanted = REQUESTS.read(spark, sf_dir).select("o_orderkey", "filename")
    existing = EXISTING.read(spark, sf_dir)
    skipped = requests.skip_existing(wanted, existing).withColumn("replaces", F.lit(False))
    flagged = requests.skip_existing(wanted, existing, overwrite=True)
    return skipped.withColumn("way", F.lit("skip")).unionByName(
        flagged.withColumn("way", F.lit("overwrite"))
    )


@CHECKS.add(
    "skip_bucketed",
    f"SELECT o_orderkey, filename FROM {REQUESTS.sql} WHERE filename NOT IN (SELECT filename FROM {EXISTING.sql})",
)
def skip_bucketed(spark, sf_dir):
    """The same skipping by a ledger in buckets, which the join reads as it lies."""
    name = f"ledger_{scratch_dir(spark, 'x').rsplit('-', 1)[1]}"
    write_ledger(EXISTING.read(spark, sf_dir), name, scratch_dir(spark, "ledger"), key="filename", buckets=16)
    wanted = REQUESTS.read(spark, sf_dir).select("o_orderkey", "filename")
    return requests.skip_existing(wanted, spark.table(name), on=("filename",), small=False)


# --- Availability -----------------------------------------------------------


@CHECKS.add(
    "latest_from_message",
    "SELECT event_id, msg, try_strptime(right(rtrim(list_last(string_split(msg, '.'))), 16), "
    f"'%Y-%m-%d %H:%M') AS latest FROM {MESSAGES.sql}",
)
def latest_from_message(spark, sf_dir):
    return requests.latest_from_message(MESSAGES.read(spark, sf_dir))


PAGES = Feed("pages", {"page_id": "page_id", "html": """replace(html, '">', '/">')"""})


@CHECKS.add(
    "listing_links",
    "SELECT page_id, href FROM (SELECT page_id, replace(unnest(regexp_extract_all("
    "regexp_replace(html, '(?is)<!--.*?-->|<script.*?</script>|<style.*?</style>', '', 'g'), "
    """'<a [^>]*href="([^"]*)"', 1)), '&amp;', '&') AS href """
    f"FROM {PAGES.sql}) WHERE href LIKE '%/'",
)
def links(spark, sf_dir):
    return listing_links(PAGES.read(spark, sf_dir))


HREF_DATES = (
    "(SELECT event_id, source, href, CAST(try_strptime(split_part(href, '/', 3), '%Y%m%d') AS DATE) "
    f"AS date FROM {HREFS.sql} WHERE try_strptime(split_part(href, '/', 3), '%Y%m%d') IS NOT NULL)"
)


@CHECKS.add("listing_dates", f"SELECT * FROM {HREF_DATES}")
def listing_dates(spark, sf_dir):
    return availability.listing_dates(HREFS.read(spark, sf_dir))


@CHECKS.add(
    "newest_date", f"SELECT source, max(date) AS newest FROM {HREF_DATES} GROUP BY source"
)
def newest_date(spark, sf_dir):
    return availability.newest_date(availability.listing_dates(HREFS.read(spark, sf_dir)))


NOW = "2024-01-30 08:49:00"


def published_sql(dates):
    return (
        f"SELECT source, CASE WHEN TIMESTAMP '{NOW}' > newest + INTERVAL '8 hours 49 minutes' THEN newest "
        "WHEN list_contains(days, newest - 1) THEN newest - 1 END AS latest FROM "
        f"(SELECT source, max(date) AS newest, list(date) AS days FROM {dates} GROUP BY source)"
    )


@CHECKS.add("latest_published", published_sql(HREF_DATES))
def latest_published(spark, sf_dir):
    dates = availability.listing_dates(HREFS.read(spark, sf_dir))
    return availability.latest_published(dates, NOW)


LEADS = Feed(
    "orders",
    {
        "o_orderkey": "o_orderkey",
        "stated": "CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'O' THEN '12h' ELSE '0h,6h,24h' END",
    },
)


@CHECKS.add(
    "lead_times",
    "SELECT o_orderkey, CAST(unnest(range(len(leads))) AS INT) AS slot, unnest(leads) AS lead FROM "
    f"(SELECT o_orderkey, string_split(coalesce(stated, '0h,6h'), ',') AS leads FROM {LEADS.sql})",
)
def lead_times(spark, sf_dir):
    rows = LEADS.read(spark, sf_dir)
    stated = rows.select("o_orderkey", F.split("stated", ",").alias("leads"))
    return requests.lead_times(stated)


FILE_SQL = "format('{}000000-{}-{}-fc.grib2', strftime(run_date, '%Y%m%d'), lead, forecast_type)"


@CHECKS.add(
    "forecast_url",
    "SELECT *, base || '/' || strftime(run_date, '%Y%m%d') || '/' || zulu || '/' || model || '/' || "
    "resolution || '/' || forecast_type || '/' || filename AS url FROM (SELECT event_id, base, "
    f"run_date, zulu, coalesce(model, 'ifs') AS model, resolution, forecast_type, lead, {FILE_SQL} AS "
    f"filename FROM {FORECASTS.sql}, (VALUES ('0h'), ('6h')) l(lead))",
)
def forecast_url(spark, sf_dir):
    rows = FORECASTS.read(spark, sf_dir).withColumns(
        {"leads": F.lit(None).cast("array<string>"), "model": F.coalesce("model", F.lit("ifs"))}
    )
    files = requests.forecast_files(requests.lead_times(rows))
    return files.drop("slot", "index_filename", "index_url")


GRIBS = Feed(
    "orders",
    {"o_orderkey": "o_orderkey", "name": "concat('a.grib2/', CAST(o_orderkey AS STRING), '-fc.grib2')"},
)


@CHECKS.add(
    "sidecar_name",
    f"SELECT o_orderkey, regexp_replace(name, '[.]grib2', '.index', 'g') AS sidecar FROM {GRIBS.sql}",
)
def sidecar(spark, sf_dir):
    return GRIBS.read(spark, sf_dir).select("o_orderkey", sidecar_name("name").alias("sidecar"))


@CHECKS.add(
    "supported_requests",
    f"SELECT * FROM {FORECASTS.sql} WHERE model = 'ifs' AND resolution = '0p25' "
    "AND forecast_type = 'oper'",
)
def supported(spark, sf_dir):
    return requests.supported_requests(FORECASTS.read(spark, sf_dir))


LISTED = (
    "(SELECT source, CAST(strptime(unnest(regexp_extract_all(regexp_replace(html, '<!--.*-->', ''), "
    f"'/f/([0-9]{{8}})/', 1)), '%Y%m%d') AS DATE) AS date FROM {LISTINGS.sql})"
)


@CHECKS.add(
    "forecast_plan",
    f"SELECT source AS base, run_date, lead, {FILE_SQL} AS filename, source || '/' || "
    f"strftime(run_date, '%Y%m%d') || '/00z/ifs/0p25/oper/' || {FILE_SQL} AS url FROM "
    f"(SELECT source, latest AS run_date, 'oper' AS forecast_type FROM ({published_sql(LISTED)})), "
    "(VALUES ('0h'), ('6h')) l(lead) WHERE run_date IS NOT NULL",
)
def forecast_plan(spark, sf_dir):
    files = plan_forecast(published_runs(LISTINGS.read(spark, sf_dir), NOW))
    return files.select("base", "run_date", "lead", "filename", "url")


# Runs whose plan is complete, told by the number in a source's address: every third source misses the
# last index, every fifth a data file.
MISSING = {"index": "CAST(regexp_extract(base, '([0-9]+)$', 1) AS INT) % 3 = 0", "data": "CAST(regexp_extract(base, '([0-9]+)$', 1) AS INT) % 5 = 0"}


@CHECKS.add(
    "forecast_verdict",
    f"SELECT base, run_date, CAST(2 AS BIGINT) AS n_leads, CAST(CASE WHEN {MISSING['data']} THEN 1 ELSE 2 END AS BIGINT) AS n_data, "
    f"CAST(2 - CASE WHEN {MISSING['data']} THEN 1 ELSE 0 END - CASE WHEN {MISSING['index']} THEN 1 ELSE 0 END AS BIGINT) AS n_index, "
    f"NOT ({MISSING['data']}) AND NOT ({MISSING['index']}) AS ok FROM "
    f"(SELECT source AS base, latest AS run_date FROM ({published_sql(LISTED)}) WHERE latest IS NOT NULL)",
)
def verdict(spark, sf_dir):
    files = plan_forecast(published_runs(LISTINGS.read(spark, sf_dir), NOW))
    lost = F.expr(f"({MISSING['index']}) AND lead = '6h'")
    data = files.filter(F.expr(f"NOT ({MISSING['data']}) OR lead <> '0h'")).select("base", "filename")
    index = files.filter(~lost).select("base", F.col("index_filename").alias("filename"))
    return forecast_verdict(files, data.unionByName(index))


TO_DATE = (
    "(SELECT ds_id, max(latest) AS latest FROM (SELECT concat('DS', user_id % 50) AS ds_id, "
    f"try_strptime(right(rtrim(list_last(string_split(msg, '.'))), 16), '%Y-%m-%d %H:%M') AS latest FROM {MESSAGES.sql} "
    "JOIN (SELECT event_id, user_id FROM events) USING (event_id)) GROUP BY ds_id HAVING max(latest) IS NOT NULL)"
)


@CHECKS.add(
    "month_to_date_requests",
    "SELECT c.ds_id, upper(region) || '_' || strftime(latest, '%Y_%m') || '_' || code || '.nc' AS filename "
    f"FROM {CONFIG_SQL} c JOIN {TO_DATE} USING (ds_id), {REGION_SQL}, {VARIABLE_SQL}",
)
def to_date(spark, sf_dir):
    owners = table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("DS"), (F.col("user_id") % 50).cast("string")).alias("ds_id")
    )
    messages = MESSAGES.read(spark, sf_dir).join(owners, "event_id").select("ds_id", "msg")
    return month_to_date_requests(configs(spark, sf_dir), messages).select("ds_id", "filename")
