"""Counts, tallies and verdicts over files and transfers.

All of these are grouped counts and flags that combine on the map side, so a
prefix, file or run holding most of the rows costs no more than any other.
"""

from pyspark.sql import functions as F

from barograph import schemas as S
from barograph.functions import file_extension, has_extension, parent_dir
from barograph.operators.joins import fits_in_broadcast, lookup_join


def file_counts(files, extension=None, path="path", length="length"):
    """Number and bytes of files per directory and extension."""
    if extension is not None:
        files = files.filter(has_extension(F.col(path), extension))
    return files.groupBy(
        parent_dir(F.col(path)).alias("dir"), file_extension(F.col(path)).alias("ext")
    ).agg(F.count("*").alias("n_files"), F.sum(length).alias("n_bytes"))


def transfer_tally(transfers, by=("prefix",)):
    """Attempted, succeeded and failed transfers per prefix."""
    return transfers.groupBy(*by).agg(
        F.count("*").alias("total"),
        F.count_if("ok").alias("succeeded"),
        F.count_if(~F.coalesce("ok", F.lit(False))).alias("failed"),
    )


def prefix_status(prefixes, transfers, by=("prefix",)):
    """Tally and verdict of every prefix; one without transfers is in order.

    Prefixes join the tally as rows that count nothing, which needs one shuffle
    of partial counts and no join.
    """
    listed = prefixes.select(*by).withColumn("ok", F.lit(None).cast("boolean"))
    seen = transfers.select(*by, F.coalesce("ok", F.lit(False)).alias("ok"))
    tally = (
        listed.unionByName(seen)
        .groupBy(*by)
        .agg(
            F.count("ok").alias("total"),
            F.count_if("ok").alias("succeeded"),
            F.count_if(~F.col("ok")).alias("failed"),
        )
    )
    return tally.withColumn("ok", F.col("failed") == 0)


def tally_levels(listed, transfers, levels, names=()):
    """Tallies and verdicts at every level at once, from the whole down to the last column.

    ``levels`` are the columns from the widest to the narrowest, such as dataset
    and prefix; ``level`` tells how many of them a row is grouped by. ``listed`` holds
    what has to come up even without transfers, and the columns ``names``, which a row
    hands on as the greatest value below it. One grouping serves all levels: rows are
    combined on the map side, and what is shuffled is a partial count per group.
    """
    mark = F.lit(None).cast("boolean").alias("ok")
    tried = transfers.select(*levels, F.coalesce("ok", F.lit(False)).alias("ok"))
    both = listed.select(*levels, *names, mark).unionByName(tried, allowMissingColumns=True)
    tally = both.rollup(*levels).agg(
        F.grouping_id().alias("_id"),
        F.count("ok").alias("total"),
        F.count_if("ok").alias("succeeded"),
        F.count_if(~F.col("ok")).alias("failed"),
        *[F.max(name).alias(name) for name in names],
    )
    # The grouping id has a bit for each level that was rolled up, the last level's lowest.
    level = F.lit(len(levels)) - F.bit_count("_id")
    return tally.withColumns({"level": level.cast("int"), "ok": F.col("failed") == 0}).drop("_id")


def run_status(results, by=()):
    """Verdict of a run over its regions: all in order, files in all, latest time.

    A run without regions is in order and has no files.
    """
    return results.groupBy(*by).agg(
        F.coalesce(F.bool_and("ok"), F.lit(True)).alias("ok"),
        F.coalesce(F.sum("n_files"), F.lit(0)).cast("bigint").alias("n_files"),
        F.max("latest").alias("latest"),
    )


def lead_pairs(expected, arrived):
    """Per expected forecast file: did it arrive, and its index with it?

    An index without its data does not count.
    """
    name = F.col("filename")
    data_name = F.when(has_extension(name, "grib2"), name).when(
        has_extension(name, "index"), F.concat(F.expr("left(filename, length(filename) - 5)"), F.lit("grib2"))
    )
    files = (
        arrived.select(data_name.alias("filename"), has_extension(name, "index").alias("_is_index"))
        .filter("filename IS NOT NULL")
        .groupBy("filename")
        .agg(F.bool_or(~F.col("_is_index")).alias("_data"), F.bool_or("_is_index").alias("_index"))
    )
    small = fits_in_broadcast(arrived.select("filename"))
    pairs = lookup_join(expected, files, ["filename"], "left", small)
    data = F.coalesce("_data", F.lit(False))
    return pairs.withColumns(
        {"data_ok": data, "index_ok": data & F.coalesce("_index", F.lit(False))}
    ).drop("_data", "_index")


def pair_completeness(expected, arrived, by=("run",), strict=False):
    """Verdict per run: every data file and every index is there.

    Strict fails on a run that is incomplete.
    """
    runs = (
        lead_pairs(expected, arrived)
        .groupBy(*by)
        .agg(
            F.count("*").alias("n_leads"),
            F.count_if("data_ok").alias("n_data"),
            F.count_if("index_ok").alias("n_index"),
        )
    )
    ok = (F.col("n_data") == F.col("n_leads")) & (F.col("n_index") == F.col("n_leads"))
    if strict:
        message = F.concat(F.lit("files missing for run "), *[F.col(n).cast("string") for n in by])
        ok = F.when(ok, ok).otherwise(F.raise_error(message).cast("boolean"))
    return runs.withColumn("ok", ok)


def attempt_outcomes(attempts, retries=S.FILE_RETRIES, by=("file",), strict=False):
    """Outcome per file of a log of attempts.

    The last attempt decides, and of several with its number the greatest status:
    ``ok``; ``failed`` for a status that is not retried; ``exhausted`` when a retried
    status came back more often than the number of retries allows; otherwise
    ``retrying``. An attempt without any status, such as a broken connection, is
    retried.
    """
    status = F.col("status_code").cast("int")
    # A decimal orders by attempt, then status, and a hash aggregate can keep it.
    number = F.col("attempt").cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(11,0)")
    order = number + F.coalesce(status, F.lit(-(1 << 31)))
    files = attempts.groupBy(*by).agg(
        F.count("*").alias("attempts"), F.max_by(status, order).alias("status_code")
    )
    retried = F.coalesce(F.col("status_code").isin(*S.RETRYABLE_STATUSES), F.lit(True))
    outcome = (
        F.when(F.col("status_code") == S.OK_STATUS, "ok")
        .when(~retried, "failed")
        .when(F.col("attempts") > retries, "exhausted")
        .otherwise("retrying")
    )
    files = files.withColumn("outcome", outcome)
    if strict:
        status = F.coalesce(F.col("status_code").cast("string"), F.lit("unknown"))
        message = F.concat(F.lit("transfer failed with status "), status)
        lost = F.col("outcome").isin("failed", "exhausted")
        files = files.withColumn(
            "outcome", F.when(lost, F.raise_error(message)).otherwise(F.col("outcome"))
        )
    return files


def delivery_ledger(expected, delivered, strict=False):
    """One row per object that was to be written: is it at its destination?

    Both tables have a ``key``, which is a prefix, a slash and a file name.
    Objects that nobody expected are left out. Strict fails on a missing one.
    Feeds ``transfer_tally``.
    """
    marks = expected.select("key", F.lit(True).alias("_expected")).unionByName(
        delivered.select("key", F.lit(False).alias("_expected"))
    )
    ledger = (
        marks.groupBy("key")
        .agg(
            F.bool_or("_expected").alias("_wanted"), F.bool_or(~F.col("_expected")).alias("ok")
        )
        .filter("_wanted")
    )
    error = F.when(~F.col("ok"), "not found at destination")
    if strict:
        message = F.concat(F.lit("not delivered: "), F.col("key"))
        error = F.when(~F.col("ok"), F.raise_error(message))
    return ledger.select(
        parent_dir(F.col("key")).alias("prefix"), "key", "ok", error.alias("error")
    )
