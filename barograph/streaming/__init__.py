"""Continuous cleaning of landed snapshots."""

from barograph.streaming.snapshots import stream_snapshots

__all__ = ["stream_snapshots"]
