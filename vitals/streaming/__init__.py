"""Structured Streaming jobs."""

from .ingest import ingest_archives

__all__ = ["ingest_archives"]
