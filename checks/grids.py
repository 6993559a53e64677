"""Cuts of a gridded table: shipments as points of three variables."""

from pyspark.sql import functions as F

from barograph.operators import subset
from barograph.operators.requests import date_ranges, request_grid
from barograph.plans import plan_requests, recorded_ledger, report_run, run_requests
from barograph.session import scratch_dir
from barograph.sinks import delivered_units, delivery_record, read_grid, read_units, write_grid
from barograph.sources import file_inventory
from checks.accounts import CHECKED, message_sql
from checks.feeds import GRID, REGIONS, Checks, Feed

CHECKS = Checks()

INSIDE = "lat BETWEEN south AND north AND lon BETWEEN west AND east"
# Region by region, as the oracle has it: every point against every box.
MONTHS = "generate_series(DATE '1996-01-01', DATE '1996-04-01', INTERVAL 1 MONTH) g(m)"
FULFILLED = (
    "(SELECT p.*, region, strftime(valid_time, '%Y') AS year, strftime(valid_time, '%m') AS month, "
    "upper(region) || '_' || strftime(valid_time, '%Y_%m') || '_' || lower(variable) || '.nc' AS filename, "
    f"lower(variable) AS code, 'nc' AS extension FROM {GRID.sql} p JOIN {REGIONS.sql} r ON {INSIDE} "
    "WHERE variable IN ('A', 'R') AND valid_time >= TIMESTAMP '1996-01-01 00:00:00' "
    "AND valid_time < TIMESTAMP '1996-05-01 00:00:00')"
)


def grid(spark, sf_dir):
    return GRID.read(spark, sf_dir)


def wanted(spark, sf_dir):
    """One configuration per region; days within a month do not matter."""
    box = F.array("north", "west", "south", "east")
    configs = REGIONS.read(spark, sf_dir).select(
        F.create_map("region", box).alias("bounds"),
        F.create_map(F.lit("A"), F.lit("a"), F.lit("R"), F.lit("r")).alias("variables"),
        F.lit("1996-01-20").alias("start_date"),
        F.lit("1996-04-10").alias("end_date"),
        F.lit("nc").alias("extension"),
    )
    return request_grid(date_ranges(configs))


@CHECKS.add(
    "box_filter",
    f"SELECT * FROM {GRID.sql} WHERE lat BETWEEN 11 AND 19 AND lon BETWEEN 8 AND 26",
)
def box_filter(spark, sf_dir):
    return subset.box_filter(grid(spark, sf_dir), [19, 8, 11, 26])


@CHECKS.add(
    "region_assign",
    f"SELECT p.*, region, north, west, south, east FROM {GRID.sql} p JOIN {REGIONS.sql} r ON {INSIDE}",
)
def region_assign(spark, sf_dir):
    return subset.region_assign(grid(spark, sf_dir), REGIONS.read(spark, sf_dir))


# Boxes of very different size: the nations' beside one of 0.02 degrees per part and one of the whole
# globe per region.
MIXED = {
    "part": Feed(
        "part",
        {
            "region": "concat('p', CAST(p_partkey AS STRING))",
            "north": "CAST(p_size AS DOUBLE) + 0.02",
            "west": "CAST(p_partkey % 64 AS DOUBLE) - 0.01",
            "south": "CAST(p_size AS DOUBLE)",
            "east": "CAST(p_partkey % 64 AS DOUBLE) + 0.01",
        },
    ),
    "region": Feed(
        "region",
        {"region": "lower(r_name)", "north": "90.0D", "west": "-180.0D", "south": "-90.0D", "east": "180.0D"},
    ),
}
MIXED_SQL = (
    f"(SELECT * FROM {REGIONS.sql} UNION ALL SELECT * FROM {MIXED['part'].sql} UNION ALL "
    "SELECT lower(r_name), 90.0, -180.0, -90.0, 180.0 FROM region)"
)


@CHECKS.add(
    "region_assign_mixed",
    f"SELECT p.point_id, r.region FROM {GRID.sql} p JOIN {MIXED_SQL} r ON {INSIDE}",
)
def region_assign_mixed(spark, sf_dir):
    boxes = REGIONS.read(spark, sf_dir)
    for feed in MIXED.values():
        boxes = boxes.unionByName(feed.read(spark, sf_dir))
    return subset.region_assign(grid(spark, sf_dir), boxes).select("point_id", "region")


def laid_out(spark, sf_dir):
    """The grid as ``write_grid`` lays it out."""
    path = scratch_dir(spark, "grid")
    points = grid(spark, sf_dir)
    write_grid(points, path)
    return read_grid(spark, path, ", ".join(f"{name} {kind}" for name, kind in points.dtypes))


@CHECKS.add(
    "clustered_box",
    f"SELECT * FROM {GRID.sql} WHERE lat BETWEEN 11 AND 19 AND lon BETWEEN 8 AND 26",
)
def clustered_box(spark, sf_dir):
    return subset.box_filter(laid_out(spark, sf_dir), [19, 8, 11, 26]).drop(subset.GRID_MONTH)


@CHECKS.add(
    "variable_select",
    f"SELECT * FROM {GRID.sql} WHERE variable = 'A' OR variable = 'R'",
)
def variable_select(spark, sf_dir):
    return subset.variable_select(grid(spark, sf_dir), wanted(spark, sf_dir))


@CHECKS.add(
    "month_select",
    f"SELECT * FROM {GRID.sql} WHERE strftime(valid_time, '%Y-%m') = '1996-12'",
)
def month_select(spark, sf_dir):
    return subset.month_select(grid(spark, sf_dir), 1996, 12)


@CHECKS.add("fulfil_requests", f"SELECT * FROM {FULFILLED}")
def fulfil_requests(spark, sf_dir):
    return subset.fulfil_requests(grid(spark, sf_dir), wanted(spark, sf_dir))


@CHECKS.add("fulfil_laid_out", f"SELECT * FROM {FULFILLED}")
def fulfil_laid_out(spark, sf_dir):
    return subset.fulfil_requests(laid_out(spark, sf_dir), wanted(spark, sf_dir))


@CHECKS.add(
    "partitioned_write",
    "SELECT region, CAST(year AS INT) AS year, CAST(month AS INT) AS month, code, filename, "
    f"count(*) AS n_points, max(value) AS top FROM {FULFILLED} GROUP BY ALL",
)
def partitioned_write(spark, sf_dir):
    path = scratch_dir(spark, "requests")
    run_requests(grid(spark, sf_dir), wanted(spark, sf_dir), path)
    return (
        spark.read.parquet(path)
        .groupBy("region", "year", "month", "code", "filename")
        .agg(F.count("*").alias("n_points"), F.max("value").alias("top"))
    )


# Two datasets that share regions and codes; the second one's boxes lie further north.
SHIFTS = {"DS1": 0.0, "DS2": 3.0}
DATASETS = f"(VALUES {', '.join(f'({name!r}, {shift})' for name, shift in SHIFTS.items())}) d(ds_id, shift)"
DELIVERED = (
    "(SELECT ds_id, region, strftime(valid_time, '%Y') AS year, strftime(valid_time, '%m') AS month, "
    f"lower(variable) AS code, value FROM {GRID.sql} p JOIN (SELECT * FROM {REGIONS.sql}, {DATASETS}) r "
    "ON lat BETWEEN south + shift AND north + shift AND lon BETWEEN west AND east "
    "WHERE variable IN ('A', 'R') AND valid_time >= TIMESTAMP '1996-01-01 00:00:00' "
    "AND valid_time < TIMESTAMP '1996-03-01 00:00:00')"
)


def dataset_configs(spark, sf_dir, end_date):
    """One configuration per region and dataset, from January 1996 on."""
    shifts = F.array(
        *[F.struct(F.lit(n).alias("ds_id"), F.lit(s).alias("shift")) for n, s in SHIFTS.items()]
    )
    regions = REGIONS.read(spark, sf_dir).select("*", F.inline(shifts))
    box = F.array(F.expr("north + shift"), "west", F.expr("south + shift"), "east")
    return regions.select(
        "ds_id",
        F.lit("Single_Level").alias("ds_name"),
        F.lit("all").alias("folder_name"),
        F.create_map("region", box).alias("bounds"),
        F.create_map(F.lit("A"), F.lit("a"), F.lit("R"), F.lit("r")).alias("variables"),
        F.lit("1996-01-01").alias("start_date"),
        F.lit(end_date).alias("end_date"),
        F.lit("nc").alias("extension"),
    )


def deliver(spark, sf_dir):
    """Write the units of both datasets, one run after the other, below one folder."""
    path = scratch_dir(spark, "datasets")
    requests = plan_requests(dataset_configs(spark, sf_dir, "1996-02-29"))
    for name in SHIFTS:
        run_requests(grid(spark, sf_dir), requests.where(F.col("ds_id") == name), path)
    return path


@CHECKS.add(
    "datasets_apart",
    "SELECT ds_id, region, CAST(year AS INT) AS year, CAST(month AS INT) AS month, code, "
    f"count(*) AS n_points, max(value) AS top FROM {DELIVERED} GROUP BY ALL",
)
def datasets_apart(spark, sf_dir):
    return (
        spark.read.parquet(deliver(spark, sf_dir))
        .groupBy("ds_id", "region", "year", "month", "code")
        .agg(F.count("*").alias("n_points"), F.max("value").alias("top"))
    )


@CHECKS.add(
    "skip_delivered",
    "SELECT ds_id, region, year, month, code FROM (SELECT ds_id, region, strftime(m, '%Y') AS year, "
    f"strftime(m, '%m') AS month, code FROM {REGIONS.sql}, {DATASETS}, {MONTHS}, "
    f"(VALUES ('a'), ('r')) v(code)) WHERE (ds_id, region, year, month, code) NOT IN "
    f"(SELECT (ds_id, region, year, month, code) FROM {DELIVERED})",
)
def skip_delivered(spark, sf_dir):
    files = file_inventory(spark, deliver(spark, sf_dir), "parquet", recursive=True)
    configs = dataset_configs(spark, sf_dir, "1996-04-30")
    rest = plan_requests(configs, delivered_units(files), overwrite=False)
    return rest.select("ds_id", "region", "year", "month", "code")


# --- Delivery by the record -----------------------------------------------------

# Two folders of one dataset whose boxes differ, and a third run over the first folder with boxes that
# lie north of every point for one variable: its units are emptied. Region names need escaping in paths.
FOLDERS = {"f1": 0.0, "f2": 3.0}
MOVED = 1000.0
UNITS = (
    "(SELECT f.folder, region, strftime(m, '%Y') AS year, strftime(m, '%m') AS month, v.variable, lower(v.variable) AS code, "
    f"south + f.shift + CASE WHEN f.folder = 'f1' AND v.variable = 'R' THEN {MOVED} ELSE 0 END AS south, "
    f"north + f.shift + CASE WHEN f.folder = 'f1' AND v.variable = 'R' THEN {MOVED} ELSE 0 END AS north, west, east, m "
    f"FROM (SELECT * REPLACE (region || ':%=' AS region) FROM {REGIONS.sql}), (VALUES ('f1', 0.0), ('f2', 3.0)) f(folder, shift), "
    "generate_series(DATE '1996-01-01', DATE '1996-02-01', INTERVAL 1 MONTH) g(m), (VALUES ('A'), ('R')) v(variable))"
)
COUNTED = (
    f"(SELECT u.folder, u.region, u.year, u.month, u.code, count(p.point_id) AS n_rows FROM {UNITS} u LEFT JOIN {GRID.sql} p "
    "ON p.variable = u.variable AND p.lat BETWEEN u.south AND u.north AND p.lon BETWEEN u.west AND u.east "
    "AND date_trunc('month', p.valid_time) = u.m GROUP BY ALL)"
)


def folder_configs(spark, sf_dir, folder, shift=0.0, variables=("A", "R"), end_date="1996-02-29"):
    regions = REGIONS.read(spark, sf_dir).withColumn("region", F.concat("region", F.lit(":%=")))
    box = F.array(F.col("north") + shift, "west", F.col("south") + shift, "east")
    names = [F.lit(x) for name in variables for x in (name, name.lower())]
    return regions.select(
        F.lit("DS1").alias("ds_id"), F.lit("Single_Level").alias("ds_name"), F.lit("store").alias("ds_source"),
        F.lit(folder).alias("folder_name"), F.create_map("region", box).alias("bounds"),
        F.create_map(*names).alias("variables"), F.lit("1996-01-01").alias("start_date"),
        F.lit(end_date).alias("end_date"), F.lit("nc").alias("extension"),
    )


def deliver_folders(spark, sf_dir):
    """Both folders, then the first one's second variable with boxes that hold nothing."""
    path, points = scratch_dir(spark, "folders"), grid(spark, sf_dir)
    for n, (folder, shift) in enumerate(FOLDERS.items()):
        run_requests(points, plan_requests(folder_configs(spark, sf_dir, folder, shift)), path, f"2024-01-0{n + 1} 00:00:00")
    moved = folder_configs(spark, sf_dir, "f1", MOVED, variables=("R",))
    run_requests(points, plan_requests(moved), path, "2024-01-03 00:00:00")
    return path


UNIT_SCHEMA = (
    "point_id bigint, ds_id string, ds_name string, folder_name string, region string, year string, month string, "
    "code string, extension string"
)


@CHECKS.add(
    "folders_apart", f"SELECT folder AS folder_name, region, year, month, code, n_rows FROM {COUNTED} WHERE n_rows > 0"
)
def folders_apart(spark, sf_dir):
    rows = read_units(spark, deliver_folders(spark, sf_dir), UNIT_SCHEMA)
    return rows.groupBy("folder_name", "region", "year", "month", "code").agg(F.count("*").alias("n_rows"))


@CHECKS.add("delivery_record", f"SELECT folder AS folder_name, region, year, month, code, n_rows FROM {COUNTED}")
def record(spark, sf_dir):
    found = delivery_record(spark, deliver_folders(spark, sf_dir))
    return found.select("folder_name", "region", "year", "month", "code", "n_rows")


# A later plan of both folders that reaches into March: what was delivered, empty units included, is left out.
@CHECKS.add(
    "skip_recorded",
    "SELECT folder AS folder_name, region, '1996' AS year, '03' AS month, lower(variable) AS code FROM "
    f"(SELECT DISTINCT folder, region, variable FROM {UNITS})",
)
def skip_recorded(spark, sf_dir):
    there = delivery_record(spark, deliver_folders(spark, sf_dir))
    planned = [
        plan_requests(folder_configs(spark, sf_dir, folder, end_date="1996-03-31"), there, overwrite=False)
        for folder in FOLDERS
    ]
    return planned[0].unionByName(planned[1]).select("folder_name", "region", "year", "month", "code")


# Ledger and report of one folder's plan up to March, of which March was never delivered.
@CHECKS.add(
    "report_recorded",
    message_sql(
        "(SELECT 'DS1' AS ds_id, 'Single_Level' AS ds_name, 'store' AS ds_source, month_end < '03' AS ok, n_files, latest FROM "
        "(SELECT '03' AS month_end, CAST(count(*) / 2 * 3 AS BIGINT) AS n_files, "
        f"(SELECT max(valid_time) FROM {GRID.sql}) AS latest FROM {UNITS} WHERE folder = 'f2'))"
    ),
)
def report_recorded(spark, sf_dir):
    planned = plan_requests(folder_configs(spark, sf_dir, "f2", 3.0, end_date="1996-03-31"))
    ledger = recorded_ledger(planned, delivery_record(spark, deliver_folders(spark, sf_dir)))
    latest = grid(spark, sf_dir).agg(F.max("valid_time").alias("latest")).withColumn("ds_id", F.lit("DS1"))
    return report_run(planned, ledger, latest, CHECKED)
