"""Structured Streaming forms of incremental reads, log tailing and object routing."""

from tidemark.streaming.incremental import new_rows, stream_rows
from tidemark.streaming.logs import tail_log
from tidemark.streaming.routing import route_objects

__all__ = ["new_rows", "route_objects", "stream_rows", "tail_log"]
