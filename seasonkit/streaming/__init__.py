"""Incremental ingest of season files with Structured Streaming."""

from .season_files import header_schema, ingest_seasons

__all__ = ["header_schema", "ingest_seasons"]
