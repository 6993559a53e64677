"""Snapshot CSV files and per-request Parquet files.

Both replace the partitions they write and leave the others alone, so a job
that is run again after a failure ends in the same state.
"""

from functools import cache

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barograph.functions import column
from barograph.session import fewer_listing_tasks
from barograph.sinks.mounted import mounted_path, write_lines
from barograph.sources.folders import file_path, folder_value, has_many_folders

SNAPSHOT_KEYS = ["dataset", "snap_date", "snap_time"]
# What tells the units of a destination apart, where requests name it.
OUTPUT_KEYS = ["ds_id", "ds_name", "folder_name"]
REQUEST_KEYS = ["region", "year", "month", "code"]
EXTENSION_KEY = "extension"

# CSV as other tools expect it: quotes doubled, missing values and empty texts
# both written as nothing, blanks kept.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def _replace_partitions(df, keys):
    return (
        df.write.partitionBy(*keys).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    )


def _gather(df, keys):
    """Bring the rows of a partition together: one file each, more for a large one.

    Rebalancing collects small partitions and splits a hot one by size, where a
    plain repartition would hand it to a single task.
    """
    return df.hint("rebalance", *keys)


def _csv_line(values):
    """A row as the line that the CSV writer makes of it.

    A mark after the last value is cut off again, as a row of one missing value would fail. Such a
    row is null here: the writer leaves its line out.
    """
    options = {name: str(value).lower() if isinstance(value, bool) else value for name, value in CSV_OPTIONS.items()}
    row = F.struct(*[value.alias(f"_{i}") for i, value in enumerate([*values, F.lit("x")])])
    line = F.to_csv(row, options)
    return F.nullif(F.left(line, F.length(line) - 2), F.lit("")).alias("line")


@cache
def _csv_row(names):
    return _csv_line([column(name) for name in names])


_HEADERS = {}


def _csv_header(spark, names):
    if names not in _HEADERS:
        line = _csv_line([F.lit(name) for name in names])
        _HEADERS[names] = spark.range(1).select(line).first()["line"]
    return _HEADERS[names]


def write_snapshots(df, path, gathered=False):
    """Write tidy snapshots as ``dataset=/snap_date=/snap_time=`` CSV files.

    ``gathered`` says that each snapshot lies in one task already, as it does
    when it was read from one landed file; it is then written without a shuffle, and
    by the tasks alone where the folder is on a mounted file system.
    """
    folder = mounted_path(df.sparkSession, path) if gathered else None
    if folder is None:
        rows = df if gathered else _gather(df, SNAPSHOT_KEYS)
        _replace_partitions(rows, SNAPSHOT_KEYS).options(**CSV_OPTIONS).csv(path)
        return
    names = tuple(name for name in df.columns if name not in SNAPSHOT_KEYS)
    header = _csv_header(df.sparkSession, names)
    write_lines(df.select(*SNAPSHOT_KEYS, _csv_row(names)), SNAPSHOT_KEYS, folder, ".csv", header, replace=True)


def read_snapshots(spark, path, schema):
    """Read snapshots back; ``schema`` covers the data and partition columns."""
    fields = spark.createDataFrame([], schema).schema.fields
    keys = [field for field in fields if field.name in SNAPSHOT_KEYS]
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", True)
    if not keys or not has_many_folders(spark, path, len(keys)):
        with fewer_listing_tasks(spark):
            return reader.schema(schema).csv(path)
    data = StructType([field for field in fields if field.name not in SNAPSHOT_KEYS])
    values = [folder_value(F.col("_path"), field.name).cast(field.dataType).alias(field.name) for field in keys]
    with fewer_listing_tasks(spark):
        rows = reader.schema(data).option("recursiveFileLookup", True).csv(path)
    return rows.select(*[column(name) for name in data.names], file_path().alias("_path")).select(
        *[column(name) for name in data.names], *values
    )


def unit_keys(columns):
    """The keys of a request unit: its dataset, folder and extension, where named, and the request."""
    every = [*OUTPUT_KEYS, *REQUEST_KEYS, EXTENSION_KEY]
    return [name for name in every if name in REQUEST_KEYS or name in columns]


def write_requests(df, path):
    """Write request outputs as ``ds_id=/ds_name=/folder_name=/region=/...`` Parquet files.

    Datasets and folders keep apart, also where they share a region and a code.
    Levels that the rows do not name are left out. Only units with rows are
    replaced; ``deliver_units`` also empties those that lost all of theirs.
    """
    keys = unit_keys(df.columns)
    _replace_partitions(_gather(df, keys), keys).parquet(path)


def unit_parts(path, keys):
    """The unit keys in a file's path, as they were before Spark escaped them for it."""
    parts = {name: F.regexp_extract(path, rf"/{name}=([^/]+)/", 1) for name in keys}
    plain = {name: F.url_decode(F.replace(p, F.lit("+"), F.lit("%2B"))) for name, p in parts.items()}
    return [part.alias(name) for name, part in plain.items()]


def delivered_units(inventory, keys=("ds_id", *REQUEST_KEYS)):
    """Request units found below a destination, read from their file paths.

    Units without points leave no files; ``delivery_record`` knows of them.
    """
    return inventory.select(*unit_parts("path", keys)).filter("region <> ''").distinct()
