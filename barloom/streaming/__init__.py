"""Incremental runs: what landed since the last one."""

from barloom.streaming.ingest import ingest_new

__all__ = ["ingest_new"]
