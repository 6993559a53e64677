"""A ledger of delivered objects, kept in buckets by key."""

BUCKETS = 64


def write_ledger(ledger, table, path=None, key="object_key", buckets=BUCKETS, mode="append"):
    """Add rows to a ledger table that is bucketed and sorted by ``key``.

    A later join on the key reads it bucket by bucket: a day's requests are shuffled
    to the buckets, and the ledger, however long, stays where it lies. The number of
    buckets belongs to the table and must not change between runs. ``path`` keeps the
    table's files outside the warehouse.
    """
    writer = ledger.write.mode(mode).bucketBy(buckets, key).sortBy(key).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)
