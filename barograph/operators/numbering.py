"""Consecutive numbers over a table that is spread over many tasks."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from barograph.session import scratch_dir

# ``monotonically_increasing_id`` holds the partition above this many bits of a row's place.
PLACE_BITS = 33


def number_rows(df, *order, name="seq", first=1):
    """Number rows from ``first`` on in the order of the given columns, without gaps.

    Rows are sorted by ranges, each task numbers its own, and what lies before a
    task is the sum of the counts of the tasks before it: one small row per task. No
    task sees the whole table. The sorted rows are stored, so that both steps see the
    same ranges. Rows that are equal in all of ``order`` are numbered in any order.
    """
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, "numbered")
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.schema(df.schema.add("_place", T.LongType())).parquet(path)
    part = F.shiftright("_place", PLACE_BITS).alias("_part")
    counts = stored.groupBy(part).agg(F.count("*").alias("n"))
    # Running sums over the parts: one row that holds a number per task, then a row per task again.
    counted = counts.agg(F.array_sort(F.collect_list(F.struct("_part", "n"))).alias("parts"))
    sums = F.aggregate(
        F.col("parts"),
        F.array(F.lit(first).cast("bigint")),
        lambda done, count: F.concat(done, F.array(F.element_at(done, -1) + count["n"])),
    )
    starts = counted.select(
        F.inline(F.arrays_zip(F.col("parts._part"), F.slice(sums, F.lit(1), F.size("parts")))).alias("_part", "_start")
    )
    inside = F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    numbered = stored.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return numbered.withColumn(name, F.col("_start") + inside).drop("_part", "_place", "_start")
