"""Column expressions; all of them native, none of them a Python UDF."""

from barograph.functions.clocks import (
    compose_timestamp,
    compose_timestamp_aws,
    in_span,
    is_hour,
    normalise_clock,
    pad_hour,
    parse_clock_hms,
    parse_date,
    parse_timecode,
    read_date,
    snapshot_date,
    snapshot_hour,
    snapshot_time,
)
from barograph.functions.names import (
    column,
    file_extension,
    forecast_name,
    forecast_url,
    has_extension,
    object_key,
    object_prefix,
    output_name,
    parent_dir,
    sidecar_name,
)
from barograph.functions.values import (
    measure_number,
    measure_text,
    null_tokens,
    strip_controls,
    upper_name,
    without_nan,
)

__all__ = [
    "column",
    "compose_timestamp",
    "compose_timestamp_aws",
    "file_extension",
    "forecast_name",
    "forecast_url",
    "has_extension",
    "in_span",
    "is_hour",
    "measure_number",
    "measure_text",
    "normalise_clock",
    "null_tokens",
    "object_key",
    "object_prefix",
    "output_name",
    "pad_hour",
    "parent_dir",
    "parse_clock_hms",
    "parse_date",
    "parse_timecode",
    "read_date",
    "sidecar_name",
    "snapshot_date",
    "snapshot_hour",
    "snapshot_time",
    "strip_controls",
    "upper_name",
    "without_nan",
]
