"""Incremental loads: batch high-water mark (T1) and file stream."""

from strata.streaming.file_stream import read_bronze_stream, stream_into_table
from strata.streaming.incremental import incremental_delta, incremental_load

__all__ = ["incremental_delta", "incremental_load", "read_bronze_stream", "stream_into_table"]
