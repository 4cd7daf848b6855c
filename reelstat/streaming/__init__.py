"""Incremental ingestion."""

from reelstat.streaming.incremental import committed, ingest_landing

__all__ = ["committed", "ingest_landing"]
