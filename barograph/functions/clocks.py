"""Dates, clocks and timestamp texts.

Everything works on text, ``DATE`` and ``TIMESTAMP_NTZ``, so results do not
depend on the session time zone.
"""

from pyspark.sql import functions as F

# Fixed patterns: clock texts with one or two digits per part. \z, unlike $,
# does not forgive a trailing line break.
HOUR_MINUTE = r"^(2[0-3]|[01]?[0-9]):[0-5]?[0-9]\z"
HOUR_MINUTE_SECOND = r"^(2[0-3]|[01]?[0-9]):[0-5]?[0-9]:(6[01]|[0-5]?[0-9])\z"
TWO_DIGIT_HOUR = r"^([01][0-9]|2[0-3])\z"

# First and last day a nanosecond timestamp can hold; days
# beyond them count as unparseable.
EARLIEST_DAY, LATEST_DAY = "1677-09-22", "2262-04-11"

# Fixed value: offset of the observation clock.
OFFSET = "+05:30"

SECONDS_PER_DAY = 86_400


def _two_digits(number):
    return F.lpad(number.cast("string"), 2, "0")


def read_date(text, date_format="yyyy-MM-dd"):
    """Date held by a text in one declared format; anything else is null."""
    return F.try_to_date(text, date_format)


def in_span(day):
    """Whether a nanosecond timestamp can hold the day; false for null."""
    first, last = (F.lit(bound).cast("date") for bound in (EARLIEST_DAY, LATEST_DAY))
    return F.coalesce(day.between(first, last), F.lit(False))


def parse_date(text, date_format="yyyy-MM-dd"):
    """Date in one declared format, within the span; anything else is null."""
    day = read_date(text, date_format)
    return F.when(in_span(day), day)


def pad_hour(text):
    """Left-pad to two characters; longer texts stay whole."""
    return F.lpad(text, F.greatest(F.lit(2), F.length(text)), F.lit("0"))


def is_hour(padded):
    """Whether a padded hour names an hour of the day; false for null."""
    return F.coalesce(padded.rlike(TWO_DIGIT_HOUR), F.lit(False))


def normalise_clock(text):
    """``H:M`` as ``HH:MM``; anything else, blanks included, is null."""
    hour, minute = (F.lpad(F.substring_index(text, ":", i), 2, "0") for i in (1, -1))
    return F.when(text.rlike(HOUR_MINUTE), F.concat(hour, F.lit(":"), minute))


def parse_clock_hms(text):
    """``H:M:S`` as ``HH:MM:SS``, else null; seconds 60 and 61 roll over."""
    hour, minute, second = (
        F.split_part(text, F.lit(":"), F.lit(i)).try_cast("int") for i in (1, 2, 3)
    )
    of_day = (hour * 3600 + minute * 60 + second) % SECONDS_PER_DAY
    clock = F.concat_ws(
        ":",
        _two_digits(F.floor(of_day / 3600)),
        _two_digits(F.floor(of_day / 60) % 60),
        _two_digits(of_day % 60),
    )
    return F.when(text.rlike(HOUR_MINUTE_SECOND), clock)


def compose_timestamp(day, padded_hour):
    """``YYYY-MM-DDTHH:00:00.00+05:30``; null if either input is null."""
    return F.concat(day.cast("string"), F.lit("T"), padded_hour, F.lit(f":00:00.00{OFFSET}"))


def compose_timestamp_aws(day, clock):
    """``YYYY-MM-DDTHH:MM:SS.00+05:30``; null if either input is null."""
    return F.concat(day.cast("string"), F.lit("T"), clock, F.lit(f".00{OFFSET}"))


def parse_timecode(text):
    """Timestamp of a timecode such as ``2024-01-02T03:00:00``."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss")).cast("timestamp_ntz")


def snapshot_hour(moment):
    """The moment cut to its hour."""
    return F.make_timestamp_ntz(
        F.year(moment), F.month(moment), F.dayofmonth(moment), F.hour(moment), F.lit(0), F.lit(0)
    )


def snapshot_date(moment):
    """Date label ``YYYY_MM_DD`` of a snapshot."""
    return F.date_format(moment.cast("date"), "yyyy_MM_dd")


def snapshot_time(moment):
    """Time label ``HH_MM_SS`` of a snapshot."""
    return F.concat_ws(
        "_",
        _two_digits(F.hour(moment)),
        _two_digits(F.minute(moment)),
        _two_digits(F.second(moment)),
    )
