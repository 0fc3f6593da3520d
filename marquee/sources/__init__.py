"""Readers and writers: delimited text profiles, directory ingest, Parquet tables."""

from marquee.sources.delimited import (IMDB_TSV, IMDB_TSV_HEADERLESS, PIPE_CSV, PLAIN_CSV,
                                       RFC4180_CSV, Profile, read_by_header, read_delimited,
                                       write_delimited)
from marquee.sources.directory import list_entries, read_directory
from marquee.sources.sinks import preview, write_then_preview
from marquee.sources.tables import read_table, register_views, table_path

__all__ = [
    "IMDB_TSV", "IMDB_TSV_HEADERLESS", "PIPE_CSV", "PLAIN_CSV", "RFC4180_CSV", "Profile",
    "read_by_header", "read_delimited", "write_delimited", "list_entries", "read_directory",
    "read_table", "register_views", "table_path", "preview", "write_then_preview",
]
