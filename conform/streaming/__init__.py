"""Structured Streaming: incremental ingest into the raw tables, and conform of whatever reached them."""

from conform.streaming.conform import stream_conform
from conform.streaming.ingest import stream_ingest

__all__ = ["stream_conform", "stream_ingest"]
