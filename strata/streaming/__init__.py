"""Structured Streaming form of the landing load (incremental, exactly
once, checkpointed)."""

from .ingest import header_of, ingest_available, landing_stream

__all__ = ["header_of", "ingest_available", "landing_stream"]
