"""Incremental ingest and resolution with Structured Streaming."""

from moniker.streaming.ingest import ingest_available
from moniker.streaming.resolve import batch_resolver, resolve_available

__all__ = ["batch_resolver", "ingest_available", "resolve_available"]
