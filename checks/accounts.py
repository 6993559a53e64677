"""Accounting of files and transfers, and report rows."""

from pyspark.sql import functions as F

from barograph.operators import accounting, report
from barograph.operators.requests import date_ranges, object_keys, request_grid
from barograph.plans import report_run
from checks.feeds import ATTEMPTS, ENTRIES, FILES, TRANSFERS, Checks, Feed
from checks.planning import GRID_SQL, configs

CHECKS = Checks()


@CHECKS.add(
    "file_counts",
    "SELECT regexp_replace(path, '/[^/]*$', '') AS dir, CASE WHEN path LIKE '%.%' THEN "
    "split_part(path, '.', 2) ELSE '' END AS ext, count(*) AS n_files, "
    f"CAST(sum(length) AS BIGINT) AS n_bytes FROM {FILES.sql} GROUP BY ALL",
)
def file_counts(spark, sf_dir):
    return accounting.file_counts(FILES.read(spark, sf_dir))


@CHECKS.add(
    "file_counts_one_extension",
    "SELECT regexp_replace(path, '/[^/]*$', '') AS dir, 'nc' AS ext, count(*) AS n_files, "
    f"CAST(sum(length) AS BIGINT) AS n_bytes FROM {FILES.sql} WHERE path LIKE '%.nc' GROUP BY ALL",
)
def file_counts_one(spark, sf_dir):
    return accounting.file_counts(FILES.read(spark, sf_dir), "nc")


TALLY = (
    "count(*) AS total, CAST(count_if(ok) AS BIGINT) AS succeeded, "
    "CAST(count_if(NOT ok) AS BIGINT) AS failed"
)


@CHECKS.add("transfer_tally", f"SELECT prefix, {TALLY} FROM {TRANSFERS.sql} GROUP BY prefix")
def transfer_tally(spark, sf_dir):
    return accounting.transfer_tally(TRANSFERS.read(spark, sf_dir))


PREFIXES = Feed("customer", {"prefix": "CAST(c_custkey AS STRING)"})
LISTED = f"(SELECT prefix FROM {PREFIXES.sql} UNION SELECT prefix FROM {TRANSFERS.sql})"


@CHECKS.add(
    "prefix_status",
    "SELECT prefix, coalesce(total, 0) AS total, coalesce(succeeded, 0) AS succeeded, "
    f"coalesce(failed, 0) AS failed, coalesce(failed, 0) = 0 AS ok FROM {LISTED} p LEFT JOIN "
    f"(SELECT prefix, {TALLY} FROM {TRANSFERS.sql} GROUP BY prefix) t USING (prefix)",
)
def prefix_status(spark, sf_dir):
    return accounting.prefix_status(PREFIXES.read(spark, sf_dir), TRANSFERS.read(spark, sf_dir))


@CHECKS.add(
    "tally_levels",
    f"SELECT CAST(2 - CAST(grouping(region) AS INT) - CAST(grouping(prefix) AS INT) AS INT) AS level, region, prefix, {TALLY}, "
    f"count_if(NOT ok) = 0 AS ok FROM {TRANSFERS.sql} GROUP BY ROLLUP (region, prefix)",
)
def tally_levels(spark, sf_dir):
    transfers = TRANSFERS.read(spark, sf_dir)
    listed = transfers.filter("ok").select("region", "prefix")
    return accounting.tally_levels(listed, transfers, ["region", "prefix"])


RESULTS = (
    f"(SELECT region, prefix, bool_and(ok) AS ok, count(*) AS n_files, max(ts) AS latest "
    f"FROM {TRANSFERS.sql} GROUP BY region, prefix)"
)


def results(spark, sf_dir):
    return TRANSFERS.read(spark, sf_dir).groupBy("region", "prefix").agg(
        F.bool_and("ok").alias("ok"), F.count("*").alias("n_files"), F.max("ts").alias("latest")
    )


@CHECKS.add(
    "run_status",
    "SELECT 'all' AS runs, bool_and(ok) AS ok, CAST(sum(n_files) AS BIGINT) AS n_files, "
    f"max(latest) AS latest FROM {RESULTS} UNION ALL SELECT prefix, bool_and(ok), "
    f"CAST(sum(n_files) AS BIGINT), max(latest) FROM {RESULTS} GROUP BY prefix "
    "UNION ALL SELECT 'none', true, 0, NULL",
)
def run_status(spark, sf_dir):
    rows = results(spark, sf_dir)
    every = accounting.run_status(rows).withColumn("runs", F.lit("all"))
    each = accounting.run_status(rows, by=["prefix"]).withColumnRenamed("prefix", "runs")
    none = accounting.run_status(rows.filter("n_files < 0")).withColumn("runs", F.lit("none"))
    return every.unionByName(each).unionByName(none)


EXPECTED = Feed(
    "orders", {"run": "o_custkey", "filename": "concat(CAST(o_orderkey AS STRING), '-0h-fc.grib2')"}
)
ARRIVED_DATA = Feed(
    "lineitem", {"filename": "concat(CAST(l_orderkey AS STRING), '-0h-fc.grib2')"}, "l_linestatus = 'F'"
)
ARRIVED_INDEX = Feed(
    "lineitem", {"filename": "concat(CAST(l_orderkey AS STRING), '-0h-fc.index')"}, "l_returnflag <> 'N'"
)
PAIRS = (
    "(SELECT o_custkey AS run, o_orderkey, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey "
    "AND l_linestatus = 'F') AS d, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey "
    "AND l_returnflag <> 'N') AS i FROM orders)"
)


@CHECKS.add(
    "pair_completeness",
    "SELECT run, count(*) AS n_leads, CAST(count_if(d) AS BIGINT) AS n_data, "
    "CAST(count_if(d AND i) AS BIGINT) AS n_index, bool_and(d AND i) AS ok "
    f"FROM {PAIRS} GROUP BY run",
)
def pair_completeness(spark, sf_dir):
    arrived = ARRIVED_DATA.read(spark, sf_dir).unionByName(ARRIVED_INDEX.read(spark, sf_dir))
    return accounting.pair_completeness(EXPECTED.read(spark, sf_dir), arrived)


@CHECKS.add(
    "lead_pairs",
    "SELECT run, concat(o_orderkey, '-0h-fc.grib2') AS filename, d AS data_ok, d AND i AS index_ok "
    f"FROM {PAIRS}",
)
def lead_pairs(spark, sf_dir):
    arrived = ARRIVED_DATA.read(spark, sf_dir).unionByName(ARRIVED_INDEX.read(spark, sf_dir))
    return accounting.lead_pairs(EXPECTED.read(spark, sf_dir), arrived)


@CHECKS.add(
    "attempt_outcomes",
    "SELECT file, attempts, status_code, CASE WHEN status_code = 200 THEN 'ok' WHEN status_code "
    "NOT IN (404, 500, 502, 504, 429) THEN 'failed' WHEN attempts > 10 THEN 'exhausted' "
    "ELSE 'retrying' END AS outcome FROM (SELECT file, count(*) AS attempts, "
    f"arg_max(status_code, attempt) AS status_code FROM {ATTEMPTS.sql} GROUP BY file)",
)
def attempt_outcomes(spark, sf_dir):
    return accounting.attempt_outcomes(ATTEMPTS.read(spark, sf_dir))


OBJECTS = Feed(
    "orders",
    {
        "prefix": "concat('run/', CAST(o_custkey AS STRING))",
        "key": "concat('run/', CAST(o_custkey AS STRING), '/', CAST(o_orderkey AS STRING))",
        "o_orderkey": "o_orderkey",
    },
)
SHIPPED = Feed("lineitem", {"o_orderkey": "l_orderkey"}, "l_quantity > 30")


@CHECKS.add(
    "delivery_ledger",
    f"SELECT prefix, key, ok, CASE WHEN NOT ok THEN 'not found at destination' END AS error FROM "
    f"(SELECT prefix, key, o_orderkey IN (SELECT o_orderkey FROM {SHIPPED.sql}) AS ok FROM {OBJECTS.sql})",
)
def delivery_ledger(spark, sf_dir):
    objects = OBJECTS.read(spark, sf_dir)
    delivered = objects.join(SHIPPED.read(spark, sf_dir), "o_orderkey").select("key")
    return accounting.delivery_ledger(objects, delivered)


# --- Reports --------------------------------------------------------------------


@CHECKS.add(
    "report_rows",
    "SELECT *, CASE status WHEN 'SUCCESS' THEN 'green' WHEN 'CRITICAL' THEN 'red' "
    f"WHEN 'ERROR' THEN 'orange' END AS colour FROM {ENTRIES.sql}",
)
def report_rows(spark, sf_dir):
    return report.report_rows(ENTRIES.read(spark, sf_dir))


COMPLAINTS = Feed(
    "events", {**ENTRIES.columns, "seq": "event_id"}, "event_type = 'error'"
)
CALM = Feed("events", {**ENTRIES.columns, "seq": "event_id"}, "event_type <> 'error'")


@CHECKS.add(
    "entries_in_order",
    "SELECT job, run_date, component, status, comments, moment, CAST(row_number() OVER (ORDER BY t, moment) AS BIGINT) AS seq FROM "
    f"(SELECT 0 AS t, * RENAME (seq AS moment) FROM {COMPLAINTS.sql} UNION ALL "
    f"SELECT 1, * RENAME (seq AS moment) FROM {CALM.sql})",
)
def entries_in_order(spark, sf_dir):
    """Entries of two tables, one after the other, numbered without a window over all."""
    tables = [feed.read(spark, sf_dir).withColumnRenamed("seq", "moment") for feed in (COMPLAINTS, CALM)]
    return report.entries_in_order(tables, "moment")


FLAGS = (
    "SELECT job, run_date, count_if(status = 'CRITICAL') > 0 AS any_critical, "
    f"count_if(status = 'ERROR') > 0 AS any_error FROM {ENTRIES.sql} GROUP BY job, run_date"
)


@CHECKS.add("report_flags", FLAGS)
def report_flags(spark, sf_dir):
    return report.report_flags(ENTRIES.read(spark, sf_dir))


@CHECKS.add(
    "report_subject",
    "SELECT job, run_date, CASE WHEN any_error THEN 'Errors raised - ' ELSE '' END || "
    "CASE WHEN any_critical THEN 'CRITICAL ERROR!! - ' ELSE '' END || job || ' || ' || run_date "
    f"AS subject FROM ({FLAGS})",
)
def report_subject(spark, sf_dir):
    return report.report_subject(ENTRIES.read(spark, sf_dir))


CHECKED = "2024-02-01 06:30:00"


def message_sql(source):
    """The run message, put together piece by piece."""
    name = "replace(ds_name, '_', ' ')"
    last = (
        f"'The last timestamp of data availability for ' || {name} || ' is ' || CAST(latest AS VARCHAR) "
        f"|| ' UTC, when checked at approximately {CHECKED} UTC.'"
    )
    good = (
        f"'All ' || n_files || ' files obtained from ' || {name} || ' on ' || ds_source || "
        f"' have been successfully uploaded to S3 on 2024-02-01.' || chr(10) || {last} || "
        "'Detailed health of the run can be found in the debug log file for the current month "
        "on the server: logs/run-2024-02-debug.log.'"
    )
    bad = (
        f"'One or more files from ' || {name} || ' on ' || ds_source || ' have failed to upload to S3 "
        f"on 2024-02-01.' || chr(10) || {last} || chr(10) || "
        "'Detailed health of the run can be found in the attached debug log file.'"
    )
    return (
        f"SELECT *, CASE WHEN ok THEN 'SUCCESS' ELSE 'CRITICAL' END AS status, "
        f"CASE WHEN ok THEN {good} ELSE {bad} END AS message FROM {source}"
    )


@CHECKS.add(
    "run_message",
    message_sql(
        "(SELECT prefix, bool_and(ok) AS ok, CAST(sum(n_files) AS BIGINT) AS n_files, "
        "max(latest) AS latest, 'Single_Level_' || prefix AS ds_name, 'store' AS ds_source "
        f"FROM {RESULTS} GROUP BY prefix)"
    ),
)
def run_message(spark, sf_dir):
    runs = accounting.run_status(results(spark, sf_dir), by=["prefix"]).withColumns(
        {"ds_name": F.concat(F.lit("Single_Level_"), F.col("prefix")), "ds_source": F.lit("store")}
    )
    return report.run_message(runs, CHECKED)


# Delivery of each configuration's requests, told from the shipments: a request
# counts as failed if its supplier returned goods that month.
FAILED = (
    "(SELECT DISTINCT concat('DS', CAST(l_suppkey AS STRING)) AS ds_id, "
    "strftime(l_shipdate, '%Y') AS year, strftime(l_shipdate, '%m') AS month "
    "FROM lineitem WHERE l_returnflag = 'R')"
)
LATEST = (
    "(SELECT concat('DS', CAST(l_suppkey AS STRING)) AS ds_id, max(l_shipdate) AS latest "
    "FROM lineitem GROUP BY l_suppkey)"
)


@CHECKS.add(
    "gridded_report",
    message_sql(
        "(SELECT ds_id, ds_name, ds_source, bool_and(ok) AS ok, count(*) AS n_files, "
        "max(latest) AS latest FROM (SELECT g.ds_id, ds_name, ds_source, f.ds_id IS NULL AS ok, latest "
        f"FROM {GRID_SQL} g LEFT JOIN {FAILED} f ON g.ds_id = f.ds_id AND g.year = f.year "
        f"AND g.month = f.month JOIN {LATEST} l ON g.ds_id = l.ds_id) GROUP BY ALL)"
    ),
)
def gridded_report(spark, sf_dir):
    requests = object_keys(request_grid(date_ranges(configs(spark, sf_dir))))
    shipments = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumns(
        {
            "ds_id": F.concat(F.lit("DS"), F.col("l_suppkey").cast("string")),
            "year": F.date_format("l_shipdate", "yyyy"),
            "month": F.date_format("l_shipdate", "MM"),
        }
    )
    months = ["ds_id", "year", "month"]
    failed = shipments.filter("l_returnflag = 'R'").select(*months).distinct()
    ledger = requests.join(failed.withColumn("failed", F.lit(True)), months, "left").select(
        "prefix", F.col("failed").isNull().alias("ok")
    )
    latest = shipments.groupBy("ds_id").agg(F.max("l_shipdate").alias("latest"))
    return report_run(requests, ledger, latest, CHECKED)
