"""Rows and texts of a status report."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph import schemas as S
from barograph.operators.numbering import number_rows

# Subject marks, in the order they are put in front.
CRITICAL_MARK = "CRITICAL ERROR!! - "
ERROR_MARK = "Errors raised - "

# Fixed texts of the run message.
ALL_DELIVERED = (
    "All %d files obtained from %s on %s have been successfully uploaded to S3 on %s.\n"
    "The last timestamp of data availability for %s is %s UTC, "
    "when checked at approximately %s UTC."
    "Detailed health of the run can be found in the debug log file for the "
    "current month on the server: logs/%s-%s-debug.log."
)
SOME_FAILED = (
    "One or more files from %s on %s have failed to upload to S3 on %s.\n"
    "The last timestamp of data availability for %s is %s UTC, "
    "when checked at approximately %s UTC.\n"
    "Detailed health of the run can be found in the attached debug log file."
)


def entries_in_order(tables, *order):
    """Report entries of several tables, one table after the other, numbered by ``seq``.

    Within a table ``order`` decides. Numbers are given out part by part, so that
    the entries never meet in one task.
    """
    marked = [table.withColumn("_table", F.lit(i)) for i, table in enumerate(tables)]
    every = reduce(DataFrame.unionByName, marked)
    return number_rows(every, "_table", *order, name="seq").drop("_table")


def report_rows(entries):
    """Report entries with the colour of their status; ``seq`` keeps their order."""
    colour = F.create_map(*[F.lit(x) for pair in S.STATUS_COLOURS.items() for x in pair])
    return entries.select(
        "job", "run_date", "seq", "component", "status", colour[F.col("status")].alias("colour"), "comments"
    )


def report_flags(entries, by=("job", "run_date")):
    """Whether a run holds a critical entry, and whether it holds an error."""

    def any_of(status):
        return F.coalesce(F.bool_or(F.col("status") == status), F.lit(False))

    return entries.groupBy(*by).agg(
        any_of("CRITICAL").alias("any_critical"), any_of("ERROR").alias("any_error")
    )


def report_subject(entries):
    """Subject line of each run's report, marked by its worst entries."""
    marks = [
        F.when(F.col(flag), F.lit(mark)).otherwise("")
        for flag, mark in (("any_error", ERROR_MARK), ("any_critical", CRITICAL_MARK))
    ]
    subject = F.concat(*marks, F.col("job"), F.lit(" || "), F.col("run_date"))
    return report_flags(entries).select("job", "run_date", subject.alias("subject"))


def run_message(runs, checked_at, log_name="run"):
    """Status and text that report on a run.

    Needs ``ok``, ``n_files``, ``latest``, ``ds_name`` and ``ds_source``;
    ``checked_at`` is the UTC time of the check as ``yyyy-MM-dd HH:mm:ss``.
    """
    name, source = F.replace("ds_name", F.lit("_"), F.lit(" ")), F.col("ds_source")
    latest, day = F.col("latest").cast("string"), F.lit(checked_at[:10])
    shared = [name, latest, F.lit(checked_at)]
    good = F.format_string(
        ALL_DELIVERED, "n_files", name, source, day, *shared, F.lit(log_name), F.lit(checked_at[:7])
    )
    bad = F.format_string(SOME_FAILED, name, source, day, *shared)
    return runs.withColumns(
        {
            "status": F.when(F.col("ok"), "SUCCESS").otherwise("CRITICAL"),
            "message": F.when(F.col("ok"), good).otherwise(bad),
        }
    )
