"""Partitioned output, written straight to any Hadoop path."""

from barograph.sinks.delivery import deliver_units, delivery_record, read_units
from barograph.sinks.grids import read_grid, write_grid
from barograph.sinks.ledger import write_ledger
from barograph.sinks.partitioned import (
    delivered_units,
    read_snapshots,
    write_requests,
    write_snapshots,
)

__all__ = [
    "deliver_units",
    "delivered_units",
    "delivery_record",
    "read_grid",
    "read_snapshots",
    "read_units",
    "write_grid",
    "write_ledger",
    "write_requests",
    "write_snapshots",
]
