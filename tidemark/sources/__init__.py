"""Readers and sinks: file sources, table loads, parquet sinks."""

from tidemark.sources.files import FileSource, discover_files, resolve_schema, stream_files
from tidemark.sources.incremental import full_load, incremental_load, last_watermark, run_load

__all__ = ["FileSource", "discover_files", "resolve_schema", "stream_files", "full_load", "incremental_load",
           "last_watermark", "run_load"]
