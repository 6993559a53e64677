"""From directory listings to the forecast files to fetch."""

from pyspark.sql import functions as F

from barograph import schemas as S
from barograph.operators.accounting import pair_completeness
from barograph.operators.availability import latest_published, listing_dates
from barograph.operators.requests import forecast_files, lead_times, supported_requests
from barograph.sources import listing_links


def published_runs(listings, now):
    """Newest published run date per source, from the listing pages."""
    dates = listing_dates(listing_links(listings.select("source", "html")))
    return latest_published(dates, now)


def plan_forecast(
    runs,
    leads=None,
    zulu="00z",
    model=S.FORECAST_MODEL,
    resolution=S.FORECAST_RESOLUTION,
    forecast_type=S.FORECAST_TYPE,
    strict=True,
):
    """Files of each source's newest run, one row per lead time.

    ``runs`` has ``source``, the base address, and ``latest``; a source without
    a published date has no files. ``leads`` is a list or one lead time.
    """
    if isinstance(leads, str):
        leads = [leads]
    wanted = F.lit(None).cast("array<string>") if leads is None else F.array(*map(F.lit, leads))
    requests = runs.filter("latest is not null").select(
        F.col("source").alias("base"),
        F.col("latest").alias("run_date"),
        F.lit(zulu).alias("zulu"),
        F.lit(model).alias("model"),
        F.lit(resolution).alias("resolution"),
        F.lit(forecast_type).alias("forecast_type"),
        wanted.alias("leads"),
    )
    return forecast_files(lead_times(supported_requests(requests, strict)))


def forecast_verdict(files, arrived, strict=False):
    """Whether each source's run is complete: every planned file and its index arrived.

    ``files`` is the plan, ``arrived`` has the name of every file that is there,
    as ``base`` and ``filename``. Strict fails on a run that is not complete.
    """
    runs = files.withColumn("filename", F.concat_ws("/", "base", "filename"))
    there = arrived.select(F.concat_ws("/", "base", "filename").alias("filename"))
    return pair_completeness(runs, there, by=("base", "run_date"), strict=strict)
