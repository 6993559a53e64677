"""Planning of gridded and forecast requests."""

from pyspark.sql import functions as F

from barograph import schemas as S
from barograph.functions import (
    forecast_name,
    forecast_url,
    object_key,
    object_prefix,
    output_name,
    sidecar_name,
)
from barograph.operators.joins import fits_in_broadcast, lookup_join

# Numbers that a task unfolds from one range of a configuration's requests.
REQUESTS_AT_ONCE = 4096


def month_starts(start, end):
    """First days of the months an inclusive date range touches.

    Null for a range that is reversed or has no readable end.
    """
    return F.when(start <= end, F.sequence(F.trunc(start, "MM"), end, F.expr("interval 1 month")))


def _split_month(df, month):
    return df.withColumns(
        {"year": F.date_format(month, "yyyy"), "month": F.date_format(month, "MM")}
    ).drop(month)


def expand_months(df, start="start_date", end="end_date"):
    """One row per month of each range, as texts ``year`` and ``month``.

    A reversed range, or a bound that is no date, gives no rows.
    """
    first, last = F.col(start).cast("date"), F.col(end).cast("date")
    return _split_month(df.withColumn("_month", F.explode(month_starts(first, last))), "_month")


def date_ranges(df, start="start_date", end="end_date"):
    """Read the range bounds of a configuration from text; no date is null."""
    return df.withColumns({name: F.try_to_date(name, "yyyy-MM-dd") for name in (start, end)})


def rejected_ranges(df, start="start_date", end="end_date"):
    """Configurations of which a range bound is no date, with the bounds' names."""
    bad = [F.when(F.try_to_date(name, "yyyy-MM-dd").isNull(), name) for name in (start, end)]
    named = df.withColumn("reject_reasons", F.array_compact(F.array(*bad)))
    return named.filter(F.size("reject_reasons") > 0)


def month_to_date(df, latest="latest"):
    """Range from the first of the latest timestamp's month to its day."""
    day = F.col(latest).cast("date")
    return df.withColumns({"start_date": F.trunc(day, "MM"), "end_date": day})


def day_list():
    """The days of a whole-month request: 01 to 31, whatever the month."""
    return F.transform(F.sequence(F.lit(1), F.lit(31)), lambda d: F.lpad(d.cast("string"), 2, "0"))


def request_days(df):
    """Add the day list to each request."""
    return df.withColumn("days", day_list())


def request_grid(configs, extension="extension", tasks=None):
    """Requests of each configuration: region x month x variable.

    A configuration row holds ``bounds`` (region -> [N, W, S, E]),
    ``variables`` (name -> code), ``start_date``, ``end_date`` and an
    extension. Its requests are numbered from 0 on: the variable is the last digit
    of a number, the month the one before, the region the first. Equal ranges of
    numbers are dealt to ``tasks`` tasks, by default as many as a shuffle has
    partitions, and each number is split into its digits there. So one
    configuration with millions of requests is as evenly spread as many small ones.
    """
    spark = configs.sparkSession
    if tasks is None:
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    first, last = (F.col(name).cast("date") for name in ("start_date", "end_date"))
    span = (F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first) + 1
    months = F.when(first <= last, span).otherwise(0).cast("bigint")

    def size(name):
        return F.coalesce(F.size(F.map_keys(name)), F.lit(0)).cast("bigint")

    sized = configs.withColumns(
        {"_regions": size("bounds"), "_months": months, "_variables": size("variables")}
    )
    total = F.col("_regions") * F.col("_months") * F.col("_variables")
    sized = sized.withColumn("_requests", total).filter("_requests > 0")
    ranges = sized.withColumn(
        "_start", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_requests") - 1, F.lit(REQUESTS_AT_ONCE)))
    ).repartition(tasks)
    listed = ranges.withColumns(
        {
            "_names": F.map_keys("bounds"), "_boxes": F.map_values("bounds"), "_first": F.trunc(first, "MM"),
            "_long": F.map_keys("variables"), "_short": F.map_values("variables"),
        }
    ).drop("bounds", "variables", "start_date", "end_date")
    stop = F.least(F.col("_start") + REQUESTS_AT_ONCE, F.col("_requests")) - 1
    numbered = listed.withColumn("_number", F.explode(F.sequence(F.col("_start"), stop)))
    variable = (F.col("_number") % F.col("_variables")).cast("int")
    month = F.expr("CAST(_number div _variables % _months AS INT)")
    region = F.expr("CAST(_number div (_variables * _months) AS INT)")
    box, start = F.get("_boxes", region), F.add_months("_first", month)
    kept = [name for name in configs.columns if name not in ("bounds", "variables", "start_date", "end_date")]
    grid = numbered.select(
        *kept,
        F.get("_names", region).alias("region"),
        *[F.element_at(box, i + 1).alias(name) for i, name in enumerate(["north", "west", "south", "east"])],
        F.date_format(start, "yyyy").alias("year"),
        F.date_format(start, "MM").alias("month"),
        F.get("_long", variable).alias("variable"),
        F.get("_short", variable).alias("code"),
    )
    return grid.withColumn("filename", output_name("region", "year", "month", "code", extension))


def variable_code(df, variables, strict=False):
    """Add the short code of each row's variable.

    Without a table of codes the name itself serves. An unknown name has a null
    code, and a name with several codes goes by its own name; strict fails on both.
    ``ambiguous_codes`` lists the latter.
    """
    if variables is None:
        return df.withColumn("code", F.col("variable"))
    codes = variables.groupBy("variable").agg(
        F.min("code").alias("code"), (F.min("code") < F.max("code")).alias("_several")
    )
    found = lookup_join(df, codes, ["variable"], "left")
    several, code = F.coalesce("_several", F.lit(False)), F.col("code")
    if strict:
        none = F.raise_error(F.concat(F.lit("no code for variable "), F.col("variable")))
        many = F.raise_error(F.concat(F.lit("several codes for variable "), F.col("variable")))
        code = F.when(several, many).when(code.isNull(), none).otherwise(code)
    else:
        code = F.when(several, F.col("variable")).otherwise(code)
    return found.withColumn("code", code).drop("_several")


def ambiguous_codes(variables):
    """Variables that a table of codes gives several codes, with those in order."""
    codes = variables.groupBy("variable").agg(F.array_sort(F.collect_set("code")).alias("codes"))
    return codes.filter(F.size("codes") > 1)


def object_keys(requests):
    """Add the prefix and the key under which each request is stored."""
    prefix = object_prefix("ds_id", "ds_name", "folder_name", F.upper("region"))
    return requests.withColumn("prefix", prefix).withColumn(
        "object_key", object_key(F.col("prefix"), F.col("filename"))
    )


def skip_existing(requests, existing, overwrite=False, on=("filename",), small=None):
    """Leave out requests whose file exists, or flag them when overwriting.

    ``small`` tells whether ``existing`` fits in a broadcast, which else costs a
    count of it. A ledger bucketed by its key (``sinks.write_ledger``) is known to be
    large: with ``small=False`` only the requests are shuffled, to its buckets.
    """
    names = existing.select(*on)
    if small is None:
        small = fits_in_broadcast(names)
    if not overwrite:
        return lookup_join(requests, names.distinct(), on, "left_anti", small)
    found = names.distinct().withColumn("replaces", F.lit(True))
    flagged = lookup_join(requests, found, on, "left", small)
    return flagged.withColumn("replaces", F.coalesce("replaces", F.lit(False)))


def latest_from_message(df, message="msg", only_status=None):
    """Add ``latest``, the timestamp that ends the text after its last full stop.

    ``only_status`` restricts this to messages that begin with that code.
    """
    tail = F.substring_index(message, ".", -1)
    text = F.regexp_extract(tail, r"([0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2})\s*\z", 1)
    latest = F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm")).cast("timestamp_ntz")
    if only_status is not None:
        latest = F.when(F.col(message).startswith(only_status), latest)
    return df.withColumn("latest", latest)


def lead_times(df, leads="leads"):
    """One row per lead time, with its place; a null list means the default one."""
    default = F.array(*[F.lit(lead) for lead in S.FORECAST_LEADS])
    kept = [name for name in df.columns if name != leads]
    return df.select(*kept, F.posexplode(F.coalesce(leads, default)).alias("slot", "lead"))


def forecast_files(df):
    """Add name, address and sidecar of each forecast file.

    Needs ``base``, ``run_date``, ``zulu``, ``model``, ``resolution``,
    ``forecast_type`` and ``lead``.
    """
    parts = ["base", "run_date", "zulu", "model", "resolution", "forecast_type", "filename"]
    return (
        df.withColumn("filename", forecast_name("run_date", "lead", "forecast_type"))
        .withColumn("url", forecast_url(*parts))
        .withColumn("index_filename", sidecar_name("filename"))
        .withColumn("index_url", sidecar_name("url"))
    )


def supported_requests(df, strict=False):
    """Keep requests for the one supported product; strict fails on others."""
    supported = (
        F.col("model").eqNullSafe(S.FORECAST_MODEL)
        & F.col("resolution").eqNullSafe(S.FORECAST_RESOLUTION)
        & F.col("forecast_type").eqNullSafe(S.FORECAST_TYPE)
    )
    if not strict:
        return df.filter(supported)
    message = F.lit("unsupported model, resolution or forecast type")
    model = F.when(supported, F.col("model")).otherwise(F.raise_error(message))
    return df.withColumn("model", model)
