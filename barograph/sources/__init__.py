"""Tables made from landed responses, listings, files and configuration."""

from barograph.sources.config import dataset_filter, region_dims, variable_dims
from barograph.sources.files import file_inventory
from barograph.sources.listings import listing_links
from barograph.sources.observations import (
    counting_files,
    landed_files,
    landed_payloads,
    latest_payloads,
    parse_payloads,
    payload_columns,
    payload_records,
    payload_rejects,
    read_payloads,
)

__all__ = [
    "counting_files",
    "dataset_filter",
    "file_inventory",
    "landed_files",
    "landed_payloads",
    "latest_payloads",
    "listing_links",
    "parse_payloads",
    "payload_columns",
    "payload_records",
    "payload_rejects",
    "read_payloads",
    "region_dims",
    "variable_dims",
]
