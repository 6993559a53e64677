"""Grids laid out so that requests read little of them."""

from pyspark.sql import functions as F

from barograph.operators.subset import GRID_MONTH, grid_month

# Bits a side of the key; a step of latitude is 180 / 2**16 degrees.
MORTON_BITS = 16
GRID_KEYS = ["variable", GRID_MONTH]


def _apart(number):
    """The bits of a number below 2**16, each moved to twice its place."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        number = (number.bitwiseOR(F.shiftleft(number, shift))).bitwiseAND(F.lit(mask).cast("bigint"))
    return number


def morton_key(lat="lat", lon="lon"):
    """Position on a curve along which points that are near in both directions stay near.

    The bits of latitude and longitude alternate. Longitudes count from -180 or
    from 0; places beyond the globe share the key of its edge.
    """
    steps = 1 << MORTON_BITS

    def step(share):
        whole = F.floor(share * steps).cast("bigint")
        return F.least(F.greatest(whole, F.lit(0)), F.lit(steps - 1)).cast("bigint")

    south = step((F.col(lat) + 90) / 180)
    west = step(F.pmod(F.col(lon) + 180, F.lit(360.0)) / 360)
    return F.shiftleft(_apart(south), 1).bitwiseOR(_apart(west))


def write_grid(grid, path, mode="overwrite", rows_per_group=None):
    """Write a grid as ``variable=/grid_month=`` Parquet, sorted along a curve over the globe.

    Requests prune its partitions by name and month, and within a file a box
    prunes row groups and pages by the least and greatest latitude and longitude
    they hold. The range partitioning splits a month with most of the points over
    many files. ``rows_per_group`` bounds the rows of a row group's page.
    """
    keyed = grid.withColumn(GRID_MONTH, grid_month()).withColumn("_morton", morton_key())
    order = [*GRID_KEYS, "_morton"]
    rows = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_morton")
    writer = rows.write.partitionBy(*GRID_KEYS).mode(mode)
    writer = writer.option("partitionOverwriteMode", "dynamic")
    if rows_per_group is not None:
        writer = writer.option("parquet.page.row.count.limit", rows_per_group)
    writer.parquet(path)


def read_grid(spark, path, schema):
    """A grid that ``write_grid`` wrote; ``schema`` is that of its points, as text."""
    return spark.read.schema(f"{schema}, {GRID_MONTH} int").parquet(path)
