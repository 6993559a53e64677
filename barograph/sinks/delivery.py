"""Delivery of request units, with a record of what was delivered.

The record is a Parquet table beside the units, in a folder that readers of the
units pass over. It has one row per requested unit and run: how many rows the unit
got, none included. A run replaces the units that have rows, then empties those
that have none any more, and writes its record last. A run that breaks off has no
record, so its units are planned again, and running it again ends in the same state.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from barograph.session import scratch_dir
from barograph.sinks.partitioned import (
    EXTENSION_KEY,
    OUTPUT_KEYS,
    REQUEST_KEYS,
    unit_keys,
    unit_parts,
    write_requests,
)
from barograph.sources.files import file_inventory

RECORD = "_record"
RECORD_NAMES = [*OUTPUT_KEYS, *REQUEST_KEYS, EXTENSION_KEY, "prefix", "object_key", "filename"]
RECORD_SCHEMA = ", ".join(f"{name} string" for name in RECORD_NAMES) + ", n_rows bigint, delivered_at timestamp"


def _read(spark, path, schema):
    """A Parquet table, or one without rows where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_units(spark, output, schema):
    """The rows delivered below a destination; ``schema`` covers data and unit keys."""
    return _read(spark, output, schema)


def delivery_record(spark, output):
    """One row per unit ever requested: names, the rows of its latest delivery, and its time.

    ``plan_requests`` skips by it and ``delivery_ledger`` is fed from it.
    """
    rows = _read(spark, f"{output}/{RECORD}", RECORD_SCHEMA)
    return rows.groupBy(*RECORD_NAMES).agg(
        F.max_by("n_rows", "delivered_at").alias("n_rows"), F.max("delivered_at").alias("delivered_at")
    )


def _unit_files(spark, output, keys):
    """Files of units below a destination: path, the unit's folder and its keys."""
    folder = F.regexp_extract("path", rf"/({'/'.join(f'{key}=[^/]+' for key in keys)})/[^/]+$", 1)
    try:
        files = file_inventory(spark, output, "parquet", recursive=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "path string")
    files = files.select("path", folder.alias("folder")).filter("folder <> ''")
    return files.select("path", "folder", *unit_parts("path", keys))


def _empty_units(spark, output, folders):
    """Delete unit folders; as in the commit of a partitioned write, the driver does it."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(output)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for row in folders.toLocalIterator():
        files.delete(jvm.org.apache.hadoop.fs.Path(root, row["folder"]), True)


def deliver_units(points, requests, output, delivered_at=None):
    """Write the points of requests as units, and one record row per requested unit.

    ``points`` come from ``fulfil_requests``, ``requests`` are those it fulfilled.
    ``delivered_at`` is the time of the run as ``yyyy-MM-dd HH:mm:ss``, by default the
    present; of several records of a unit the latest counts.

    A requested unit all of whose files were there before the run got no rows and
    loses them. Rows are counted from what was written: unit keys come from paths and
    counts from footers, so the points are worked out once.
    """
    spark, keys = points.sparkSession, unit_keys(requests.columns)
    schema = points.schema
    earlier = scratch_dir(spark, "earlier-files")
    _unit_files(spark, output, keys).select("path").write.parquet(earlier)
    write_requests(points, output)
    names = [name for name in RECORD_NAMES if name in requests.columns]
    asked = requests.select(*[F.col(name).cast("string").alias(name) for name in names]).distinct()
    units = asked.select(*keys).distinct()
    old = spark.read.parquet(earlier).withColumn("_old", F.lit(True))
    there = _unit_files(spark, output, keys).join(units, keys, "left_semi").join(old, "path", "left")
    gone = there.groupBy("folder").agg(F.bool_and(F.coalesce("_old", F.lit(False))).alias("gone"))
    _empty_units(spark, output, gone.filter("gone").select("folder"))
    written = read_units(spark, output, schema).select(*[F.col(k).cast("string").alias(k) for k in keys])
    counts = written.join(units, keys, "left_semi").groupBy(*keys).agg(F.count("*").alias("n_rows"))
    moment = F.current_timestamp() if delivered_at is None else F.lit(delivered_at).cast("timestamp")
    record = asked.join(counts, keys, "left").withColumns(
        {"n_rows": F.coalesce("n_rows", F.lit(0)), "delivered_at": moment}
    )
    missing = {n: F.lit(None).cast("string") for n in RECORD_NAMES if n not in names}
    record = record.withColumns(missing).select(*RECORD_NAMES, "n_rows", "delivered_at")
    record.write.mode("append").parquet(f"{output}/{RECORD}")
