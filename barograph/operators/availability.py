"""Discovery of the newest available forecast date."""

from datetime import timezone

from pyspark.sql import functions as F

# Fixed value: a day's forecast counts as published once this UTC clock time
# of that day has passed.
PUBLISHED_AFTER = "interval '0 08:49:00' day to second"


def listing_dates(links, href="href"):
    """Keep links whose third path part is a date, adding it as ``date``."""
    part = F.split_part(href, F.lit("/"), F.lit(3))
    return links.withColumn("date", F.try_to_date(part, "yyyyMMdd")).filter("date is not null")


def _utc_text(moment):
    """A UTC moment as text; a datetime without a zone is taken as UTC."""
    if isinstance(moment, str):
        return moment
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return moment.isoformat(sep=" ")


def newest_date(dates, by=("source",)):
    """Newest date of each source."""
    return dates.groupBy(*by).agg(F.max("date").alias("newest"))


def latest_published(dates, now, by=("source",)):
    """Newest published date of each source, at the given UTC time.

    The newest date counts only after its publication time; before it, the day
    before counts, if listed. Otherwise the result is null.

    Every date is noted under itself and, as a predecessor, under the day
    after. The dates of a source are thus never gathered: both steps combine
    on the map side, first to distinct days and then to one row per source.
    Day and mark share one number, which keeps the second step a hash
    aggregate too.
    """
    now = F.lit(_utc_text(now)).cast("timestamp_ntz")
    notes = F.array(
        F.struct(F.col("date").alias("day"), F.lit(True).alias("listed")),
        F.struct(F.date_add("date", 1).alias("day"), F.lit(False).alias("listed")),
    )
    days = (
        dates.select(*by, F.inline(notes))
        .groupBy(*by, "day")
        .agg(F.bool_or("listed").alias("listed"), F.bool_or(~F.col("listed")).alias("follows"))
    )
    marked = F.unix_date("day") * 2 + F.col("follows").cast("int")
    newest = days.groupBy(*by).agg(F.max(F.when(F.col("listed"), marked)).alias("newest"))
    day = F.date_from_unix_date(F.floor(F.col("newest") / 2).cast("int"))
    published = now > day.cast("timestamp_ntz") + F.expr(PUBLISHED_AFTER)
    follows = F.col("newest") % 2 != 0
    latest = F.when(published, day).when(follows, F.date_sub(day, 1))
    return newest.select(*by, latest.alias("latest"))
