"""Logs as a stream."""

from lumberline.streaming.apart import read_stream_counts, read_stream_rows, stream_counts_apart
from lumberline.streaming.logs import stream_ahead_of_arrival, stream_level_counts, stream_parse_to_json
from lumberline.streaming.sources import message_lines, stream_raw_logs

__all__ = [
    "message_lines",
    "read_stream_counts",
    "read_stream_rows",
    "stream_ahead_of_arrival",
    "stream_counts_apart",
    "stream_level_counts",
    "stream_parse_to_json",
    "stream_raw_logs",
]
