"""Structured Streaming forms of the daily-refresh operators.

The reference refreshes daily (data by 07:00, alert after 08:00) and re-runs
its status queries after each change. Here the same operators run
incrementally over arriving files: stream-static joins for resolution, a
running breakdown, and an event-time freshness monitor with a watermark.
"""

from .refresh import (freshness_stream, resolution_breakdown_stream, resolve_stream,
                      start_query)

__all__ = ["freshness_stream", "resolution_breakdown_stream", "resolve_stream", "start_query"]
