"""Session settings that suit these jobs, and where they may keep tables."""

import uuid
from contextlib import contextmanager

# Adaptive execution sizes shuffles and splits hot partitions. The code limit
# makes Spark fall back to smaller methods where a stage would generate one that
# the JVM does not compile. Timestamps that carry no zone are taken as UTC.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


def scratch_dir(spark, label):
    """A fresh folder path for one intermediate or checkpoint table.

    The folder lies in the shared location the cluster names in
    ``spark.checkpoint.dir``. Where none is named it lies in the warehouse, which
    Spark itself needs the driver and every executor to reach.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/barograph-scratch"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


# Tasks that list files, for every core. Spark takes one per path up to 10,000, and most of such a task
# is its own start.
LISTING_TASKS_PER_CORE = 4


# What opening a file counts as, in bytes. By Spark's 4 MB a task reads no more than 32 small files.
OPEN_COST = 256 * 1024


def listing_settings(spark):
    """Settings under which many paths are listed by as many tasks as keep all cores busy."""
    tasks = LISTING_TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    return {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(tasks)}


def reading_settings(spark):
    """Settings under which a task reads some hundreds of small files, and no more bytes than before."""
    return {"spark.sql.files.openCostInBytes": str(OPEN_COST)}


@contextmanager
def _held(spark, settings):
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def fewer_listing_tasks(spark):
    """Hold ``listing_settings`` while tables of many files are opened, which is when they are listed."""
    return _held(spark, listing_settings(spark))


def fewer_reading_tasks(spark):
    """Hold ``reading_settings`` while a query over many small files runs."""
    return _held(spark, reading_settings(spark))


def session_with(spark, settings):
    """A session beside the given one, with its settings and these; for streams, which list as they run."""
    own = spark.newSession()
    for key, value in {**spark.conf.getAll, **settings}.items():
        if own.conf.get(key, None) != value:
            own.conf.set(key, value)
    return own
