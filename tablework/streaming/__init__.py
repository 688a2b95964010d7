"""Incremental form of the feed ingest (see :mod:`tablework.streaming.feed`)."""

from tablework.streaming.feed import (read_stop_event_stream, start_delay_sink,
                                      stream_delays)

__all__ = ["read_stop_event_stream", "start_delay_sink", "stream_delays"]
