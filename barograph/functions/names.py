"""File names, object keys and addresses."""

from pyspark.sql import functions as F

GRIB, INDEX = ".grib2", ".index"


def column(name):
    """Reference to a column whatever characters its name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def output_name(region, year, month, code, extension):
    """``{REGION}_{YYYY}_{MM}_{code}.{ext}``."""
    return F.concat(F.concat_ws("_", F.upper(region), year, month, code), F.lit("."), extension)


def object_prefix(ds_id, ds_name, folder, unit):
    """``{ds_id}-{ds_name}/{folder}/{unit}``; the unit is a region or a date."""
    return F.concat(ds_id, F.lit("-"), ds_name, F.lit("/"), folder, F.lit("/"), unit)


def object_key(prefix, filename):
    """Key of one object under its prefix."""
    return F.concat(prefix, F.lit("/"), filename)


def forecast_name(run_date, lead, forecast_type):
    """``{yyyyMMdd}000000-{lead}-{type}-fc.grib2``; the stamp is midnight."""
    stamp = F.concat(F.date_format(run_date, "yyyyMMdd"), F.lit("000000"))
    return F.concat(F.concat_ws("-", stamp, lead, forecast_type), F.lit("-fc" + GRIB))


def forecast_url(base, run_date, zulu, model, resolution, forecast_type, filename):
    """Address of a forecast file below its base address."""
    day = F.date_format(run_date, "yyyyMMdd")
    return F.concat_ws("/", base, day, zulu, model, resolution, forecast_type, filename)


def sidecar_name(name):
    """Name or address of the index that goes with a forecast file."""
    return F.replace(name, F.lit(GRIB), F.lit(INDEX))


def file_extension(path):
    """Extension of the last path part, without the dot; empty if none."""
    return F.regexp_extract(path, r"\.([^./]*)\z", 1)


def has_extension(path, extension):
    """Whether a path ends in a dot and this extension."""
    return path.endswith("." + extension)


def parent_dir(path):
    """The part of a path before its last slash."""
    name = F.substring_index(path, "/", -1)
    return F.left(path, F.greatest(F.length(path) - F.length(name) - 1, F.lit(0)))
