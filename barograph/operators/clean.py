"""Cleaning of station observations.

Each feed is cleaned by one projection: no shuffle, no Python. ``mode`` says
what a value that cannot be read does: ``"permissive"`` makes it null and names
it as a reject reason, ``"strict"`` fails the job that computes it.
"""

from functools import cache, reduce

from pyspark.sql import functions as F

from barograph import schemas as S
from barograph.functions import (
    column,
    compose_timestamp,
    compose_timestamp_aws,
    in_span,
    is_hour,
    measure_text,
    normalise_clock,
    pad_hour,
    parse_clock_hms,
    read_date,
    snapshot_date,
    snapshot_hour,
    snapshot_time,
    strip_controls,
    upper_name,
    without_nan,
)

MODES = ("strict", "permissive")


def _check_mode(mode):
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")


def _check_columns(df, names):
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {', '.join(missing)}")


def drop_columns(df, names=tuple(S.DISPLAY_COLUMNS), strict=False):
    """Drop the display columns; strict insists that all of them are there."""
    if strict:
        _check_columns(df, names)
    return df.drop(*names)


def rename_columns(df, names=None):
    """Rename raw columns to tidy ones; names that are not there are ignored."""
    return df.withColumnsRenamed(S.STATION_NAMES if names is None else names)


def column_order(df, first="timestamp", dropped=(S.STATION_DATE, S.STATION_HOUR, "Date")):
    """Put one column first, drop the inputs it was made of, keep the rest in order."""
    kept = [name for name in df.columns if name != first and name not in dropped]
    return df.select(column(first), *[column(name) for name in kept])


def expected_columns(df, dataset=S.STATION_DATASET, expected=tuple(S.STATION_EXPECTED)):
    """One row per expected column, telling whether the table has it.

    Reads the table's metadata only. The timestamp is composed during
    cleaning, hence always there.
    """
    rows = [(dataset, name, name == "timestamp" or name in df.columns) for name in expected]
    return df.sparkSession.createDataFrame(rows, "dataset string, column string, present boolean")


def expected_in_payloads(records, keys, expected=tuple(S.STATION_EXPECTED)):
    """The same check on the data: per snapshot, is a column in any record?

    ``records`` has an array of text maps in ``records``; ``keys`` name the
    snapshot. A column counts as present if at least one record has its key.
    """

    def holds(name):
        return F.exists("records", lambda record: F.map_contains_key(record, name))

    found = [
        F.coalesce(F.bool_or(F.lit(True) if name == "timestamp" else holds(name)), F.lit(False))
        for name in expected
    ]
    checks = F.array(
        *[
            F.struct(F.lit(name).alias("column"), column(name).alias("present"))
            for name in expected
        ]
    )
    flags = [flag.alias(name) for flag, name in zip(found, expected)]
    return records.groupBy(*keys).agg(*flags).select(*keys, F.inline(checks))


# Fields are read in one projection, judged in a second one where reasons are
# wanted, and put in place in a last one. What is read is used more than once
# later on, so the optimizer keeps the steps apart and nothing is parsed twice.
# The judging step uses an array function that Spark runs outside whole-stage
# code. Without that break the generated method would grow past the 8000 bytes
# up to which the JVM compiles it, and run several times slower. Expressions of
# the columns that a feed is known by are put together once, as a stream cleans
# many small batches.


def _station_parts(field, date_format):
    """What is read of a station record; ``field`` gives a raw column by its name."""
    parts = {"_day": read_date(field(S.STATION_DATE), date_format)}
    parts["_time"] = pad_hour(field(S.STATION_HOUR))
    for name in S.MEASURES:
        parts[f"_{S.STATION_NAMES[name]}"] = measure_text(field(name))
    for name in S.CLOCKS:
        text = field(name)
        clock = normalise_clock(strip_controls(text) if name in S.STRIPPED else text)
        parts[f"_{S.STATION_NAMES[name]}"] = clock
    return parts


def _aws_parts(field, date_format):
    return {
        "_day": read_date(field(S.AWS_DATE), date_format),
        "_time": parse_clock_hms(field(S.AWS_CLOCK)),
    }


_known_station_parts = cache(lambda date_format: _station_parts(column, date_format))
_known_aws_parts = cache(lambda date_format: _aws_parts(column, date_format))


def _read_station(df, date_format):
    return df.withColumns(_known_station_parts(date_format))


def _read_aws(df, date_format):
    return df.withColumns(_known_aws_parts(date_format))


@cache
def _station_problems():
    problems = {"date": ~in_span(F.col("_day")), "time": ~is_hour(F.col("_time"))}
    for target in map(S.STATION_NAMES.get, S.MEASURES):
        problems[target] = F.col(f"_{target}") == ""
    return problems


@cache
def _aws_problems():
    return {"date": ~in_span(F.col("_day")), "time": F.col("_time").isNull()}


def _judge(df, problems):
    """Add ``reject_reasons``, the names of the problems a row has."""
    named = [F.when(bad, reason) for reason, bad in problems.items()]
    return df.withColumn("reject_reasons", F.array_compact(F.array(*named)))


def _complete(df, required, mode):
    """Add required columns that are absent as null; in strict mode refuse."""
    if mode == "strict":
        _check_columns(df, [*S.DISPLAY_COLUMNS, *required])
    absent = {name: F.lit(None).cast("string") for name in required if name not in df.columns}
    return df.withColumns(absent) if absent else df


_RULES = {
    S.STATION_DATASET: (S.STATION_REQUIRED, _read_station, _station_problems),
    S.AWS_DATASET: (S.AWS_REQUIRED, _read_aws, _aws_problems),
}


def reject_reasons(df, dataset=S.STATION_DATASET, date_format="yyyy-MM-dd"):
    """The raw rows plus ``reject_reasons``, the fields that cannot be read."""
    required, read, problems = _RULES[dataset]
    df = _complete(df, required, "permissive")
    raw = [column(name) for name in df.columns]
    return _judge(read(df, date_format), problems()).select(*raw, "reject_reasons")


def reject_rows(df, dataset=S.STATION_DATASET, date_format="yyyy-MM-dd"):
    """The raw rows that strict cleaning would fail on, with their reasons."""
    required, read, problems = _RULES[dataset]
    df = _complete(df, required, "permissive")
    raw, found = [column(name) for name in df.columns], problems()
    # The plain flags decide which rows stay; names are put together for those alone.
    any_bad = reduce(lambda x, y: x | y, [F.coalesce(bad, F.lit(False)) for bad in found.values()])
    return _judge(read(df, date_format).filter(any_bad), found).select(*raw, "reject_reasons")


def _or_fail(value, reasons, mode):
    """The value; in strict mode it raises where one of the reasons holds.

    The error sits inside the column, so it cannot be pruned away from a job
    that uses the column.
    """
    if mode == "permissive":
        return value
    bad = F.arrays_overlap("reject_reasons", F.array(*[F.lit(reason) for reason in reasons]))
    message = F.concat(F.lit("cannot be read: "), F.array_join("reject_reasons", ", "))
    return F.when(bad, F.raise_error(message)).otherwise(value)


def _place(df, tidy, stamp, problems, mode, with_reasons):
    """Timestamp first, then the tidy columns, then the reasons if wanted."""
    stamp = F.when(~(problems["date"] | problems["time"]), stamp)
    first = _or_fail(stamp, ["date", "time"], mode).alias("timestamp")
    if with_reasons or mode == "strict":
        df = _judge(df, problems)
    return df.select(first, *tidy, *(["reject_reasons"] if with_reasons else []))


def _station_tidy(names, field, mode):
    """Tidy name and value of each raw column, from the record and what was read of it."""
    tidy, inputs = {}, {S.STATION_DATE, S.STATION_HOUR, "Date", *S.DISPLAY_COLUMNS}
    for name in names:
        if name in inputs:
            continue
        value, target = field(name), S.STATION_NAMES.get(name, name)
        if name in S.CLOCKS:
            value = F.col(f"_{target}")
        elif name in S.STRIPPED:
            value = strip_controls(value)
        if name in S.UPPERCASED:
            value = upper_name(value)
        if name in S.MEASURES:
            number = without_nan(F.col(f"_{target}").try_cast("double"))
            value = _or_fail(number, [target], mode)
        tidy[target] = value
    return tidy


@cache
def _known_station_tidy(names, mode):
    return [value.alias(name) for name, value in _station_tidy(names, column, mode).items()]


def _aws_tidy(names, field, mode):
    inputs = {S.AWS_DATE, S.AWS_CLOCK, *S.DISPLAY_COLUMNS}
    return {S.AWS_NAMES.get(name, name): field(name) for name in names if name not in inputs}


def _other_tidy(names, field, mode):
    return {name: field(name) for name in names if name not in S.DISPLAY_COLUMNS}


def clean_station(df, mode="permissive", date_format="yyyy-MM-dd", with_reasons=False):
    """Tidy a station feed: composed timestamp, clocks, names and measures.

    ``with_reasons`` adds ``reject_reasons`` to the tidy rows, which saves a
    second pass where both are wanted.
    """
    _check_mode(mode)
    df = _complete(df, S.STATION_REQUIRED, mode)
    tidy = _known_station_tidy(tuple(df.columns), mode)
    stamp = compose_timestamp(F.col("_day"), F.col("_time"))
    parsed = _read_station(df, date_format)
    return _place(parsed, tidy, stamp, _station_problems(), mode, with_reasons)


def clean_aws(df, mode="permissive", date_format="yyyy-MM-dd", with_reasons=False):
    """Tidy an automatic station feed: composed timestamp; measures untouched."""
    _check_mode(mode)
    df = _complete(df, S.AWS_REQUIRED, mode)
    tidy = [value.alias(name) for name, value in _aws_tidy(df.columns, column, mode).items()]
    stamp = compose_timestamp_aws(F.col("_day"), F.col("_time"))
    return _place(_read_aws(df, date_format), tidy, stamp, _aws_problems(), mode, with_reasons)


def clean_feed(df, dataset, mode="permissive", date_format="yyyy-MM-dd", with_reasons=False):
    """Clean one feed by the rules of its dataset code.

    A code without rules of its own only loses the display columns.
    """
    if dataset == S.STATION_DATASET:
        return clean_station(df, mode, date_format, with_reasons)
    if dataset == S.AWS_DATASET:
        return clean_aws(df, mode, date_format, with_reasons)
    _check_mode(mode)
    tidy = drop_columns(df, strict=mode == "strict")
    if with_reasons:
        tidy = tidy.withColumn("reject_reasons", F.array().cast("array<string>"))
    return tidy


def clean_by_dataset(feeds, mode="permissive", date_format="yyyy-MM-dd"):
    """Clean several feeds, given by dataset code, into one table.

    Columns are matched by name; one that a feed lacks is null there, and one
    that the feeds type differently becomes text.
    """
    cleaned = {code: clean_feed(df, code, mode, date_format) for code, df in feeds.items()}
    types = {}
    for df in cleaned.values():
        for field in df.schema.fields:
            types.setdefault(field.name.lower(), set()).add(field.dataType.simpleString())
    parts = []
    for code, df in cleaned.items():
        same = [
            column(name).cast("string").alias(name)
            if len(types[name.lower()]) > 1
            else column(name)
            for name in df.columns
        ]
        parts.append(df.select(F.lit(code).alias("dataset"), *same))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def clean_records(rows, columns, dataset="dataset", record="record", date_format="yyyy-MM-dd"):
    """Clean records of several datasets in one pass, into one table.

    ``rows`` has a dataset's code and a raw record as a map of texts; other columns are
    passed on. ``columns`` maps each code to its raw columns. Every row is read by the
    rules of its own code alone, so the table is scanned once, however many codes there
    are. Columns are as in ``clean_by_dataset``; what cannot be read is null. Rows of
    a code that is not named are left out.
    """
    parts, stamps, tidy = {}, [], {}
    for code, names in columns.items():
        mine = F.col(dataset) == code

        def field(name, names=names):
            held = F.col(record).getItem(name)
            return held if name in names else F.lit(None).cast("string")

        required, read, stamp, rules = {
            S.STATION_DATASET: (S.STATION_REQUIRED, _station_parts, compose_timestamp, _station_tidy),
            S.AWS_DATASET: (S.AWS_REQUIRED, _aws_parts, compose_timestamp_aws, _aws_tidy),
        }.get(code, ([], None, None, _other_tidy))
        if read:
            for name, value in read(field, date_format).items():
                parts.setdefault(name, []).append(F.when(mine, value))
            problems = (_station_problems if code == S.STATION_DATASET else _aws_problems)()
            good = mine & ~(problems["date"] | problems["time"])
            stamps.append(F.when(good, stamp(F.col("_day"), F.col("_time"))))
        every = [*names, *[name for name in required if name not in names]]
        for name, value in rules(every, field, "permissive").items():
            number = code == S.STATION_DATASET and name in map(S.STATION_NAMES.get, S.MEASURES)
            tidy.setdefault(name.lower(), []).append((name, mine, value, number))
    kept = [column(name) for name in rows.columns if name not in (dataset, record)]
    known = rows.filter(F.col(dataset).isin(*columns))
    read = known.withColumns({name: F.coalesce(*values) for name, values in parts.items()})
    placed = []
    for found in tidy.values():
        # A column that the datasets type differently becomes text.
        same = len({number for *_, number in found}) == 1
        values = [F.when(mine, value if same else value.cast("string")) for _, mine, value, _ in found]
        placed.append(F.coalesce(*values).alias(found[0][0]))
    stamp = [F.coalesce(*stamps).alias("timestamp")] if stamps else []
    return read.select(column(dataset), *stamp, *placed, *kept)


def snapshot_label(df, moment="ts", cut=True):
    """Add the labels of the snapshot a moment belongs to.

    By default the moment is cut to its hour; a given timecode is kept whole.
    """
    at = snapshot_hour(F.col(moment)) if cut else F.col(moment)
    return df.withColumn("timecode", at).withColumns(
        {"snap_date": snapshot_date(F.col("timecode")), "snap_time": snapshot_time(F.col("timecode"))}
    )
