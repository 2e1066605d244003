"""Sources and sinks."""

from .fixtures import EMBED_FEATURES, labelled_embeddings
from .headers import file_headers, read_by_header
from .plays import (
    PLAYS_VIEW_SQL_DUCKDB,
    plays_from_lineitem,
    read_play_files,
    write_seasons,
)

__all__ = [
    "EMBED_FEATURES",
    "PLAYS_VIEW_SQL_DUCKDB",
    "file_headers",
    "labelled_embeddings",
    "plays_from_lineitem",
    "read_by_header",
    "read_play_files",
    "write_seasons",
]
