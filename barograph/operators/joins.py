"""Joins of a large table with a lookup table, broadcast only where its size is proven."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def row_bytes(df):
    """Estimate of the bytes of a row: texts and nested values by their length."""
    total = F.lit(0)
    for field in df.schema.fields:
        value = F.col("`" + field.name.replace("`", "``") + "`")
        if isinstance(field.dataType, T.StringType):
            total = total + F.coalesce(F.octet_length(value), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0))
        else:
            total = total + F.lit(16)
    return total


def fits_in_broadcast(df, max_rows=MAX_BROADCAST_ROWS, max_bytes=MAX_BROADCAST_BYTES):
    """Whether a table is proven small: one distributed count of rows and bytes.

    A table that is still to be deduplicated can be checked as it is, which
    costs a scan and no shuffle.
    """
    size = df.agg(F.count("*").alias("rows"), F.sum(row_bytes(df)).alias("bytes")).first()
    return size["rows"] <= max_rows and (size["bytes"] or 0) <= max_bytes


def lookup_join(left, right, on, how="inner", small=None):
    """Join a large table with a lookup table on equal keys.

    ``how`` is inner, left, left_semi or left_anti. A right side of proven size
    is broadcast and the left side is not shuffled; ``small`` passes on the
    answer of a check already made. Beyond that size both sides are shuffled, and
    adaptive execution splits the left side's hot partitions while the join runs
    (see ``session.SETTINGS``): all four kinds of join allow that. The hint is needed:
    Spark's own estimate sees the files a table comes from and not what explodes from them.
    """
    if small is None:
        small = fits_in_broadcast(right)
    return left.join(F.broadcast(right) if small else right.hint("merge"), list(on), how)
