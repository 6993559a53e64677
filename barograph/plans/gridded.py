"""From region and variable maps to written subsets and a run report."""

from pyspark.sql import functions as F

from barograph.operators.accounting import delivery_ledger, tally_levels
from barograph.operators.joins import lookup_join
from barograph.operators.report import run_message
from barograph.operators.requests import (
    date_ranges,
    latest_from_message,
    month_to_date,
    object_keys,
    request_grid,
    skip_existing,
)
from barograph.operators.subset import fulfil_requests
from barograph.sinks import deliver_units
from barograph.sinks.partitioned import REQUEST_KEYS


def plan_requests(configs, existing=None, overwrite=True, tasks=None):
    """Named requests of each configuration, less those already there.

    ``existing`` is the ``delivery_record`` of a destination or any table with
    ``object_key``, or the units that ``delivered_units`` reads from file paths; the
    latter tell only what their columns name apart. With overwriting on, all requests stay and ``replaces``
    flags those that exist. ``tasks`` spreads the regions of few configurations
    over so many tasks.
    """
    requests = object_keys(request_grid(date_ranges(configs), tasks=tasks))
    if existing is None:
        return requests.withColumn("replaces", F.lit(False)) if overwrite else requests
    units = [name for name in ("ds_id", "ds_name", "folder_name", *REQUEST_KEYS) if name in existing.columns]
    on = ("object_key",) if "object_key" in existing.columns else tuple(units)
    return skip_existing(requests, existing.select(*on).distinct(), overwrite, on=on)


def run_requests(grid, requests, output, delivered_at=None):
    """Cut the grid by all requests at once; write one unit per request and their record."""
    deliver_units(fulfil_requests(grid, requests), requests, output, delivered_at)


def recorded_ledger(requests, record, strict=False):
    """The ledger of planned requests from a destination's ``delivery_record``."""
    expected = requests.select(F.col("object_key").alias("key"))
    return delivery_ledger(expected, record.select(F.col("object_key").alias("key")), strict)


def month_to_date_requests(configs, messages, existing=None, overwrite=True, tasks=None):
    """Requests from the first of the newest available month to its last day.

    ``messages`` has ``ds_id`` and ``msg``, the answer to a request beyond what is
    available; the timestamp that ends it replaces the range of its dataset's
    configurations. A dataset whose messages name no timestamp has no requests.
    """
    newest = latest_from_message(messages).groupBy("ds_id").agg(F.max("latest").alias("latest"))
    undated = configs.drop("start_date", "end_date")
    dated = month_to_date(lookup_join(undated, newest, ["ds_id"]))
    texts = {name: F.col(name).cast("string") for name in ("start_date", "end_date")}
    return plan_requests(dated.withColumns(texts), existing, overwrite, tasks)


def report_run(requests, ledger, latest, checked_at, log_name="run"):
    """Status and message per dataset, from the delivery of its requests.

    ``ledger`` has ``prefix`` and ``ok`` and is that of these requests;
    ``latest`` has ``ds_id`` and the newest timestamp available. A region none of
    whose files was tried is in order, and a run's verdict is that of all its
    regions. A prefix begins with its dataset, so prefixes and datasets are counted in
    one grouping; rows of datasets that were not requested are left out.
    """
    dataset = F.substring_index("prefix", "/", 1).alias("dataset")
    named = ["ds_id", "ds_name", "ds_source"]
    levels = tally_levels(
        requests.select(dataset, "prefix", *named),
        ledger.select(dataset, "prefix", "ok"),
        ["dataset", "prefix"],
        named,
    )
    runs = levels.filter("level = 1 AND ds_id IS NOT NULL").join(latest, "ds_id", "left")
    columns = [*named, "ok", F.col("total").alias("n_files"), "latest"]
    return run_message(runs.select(*columns), checked_at, log_name)
