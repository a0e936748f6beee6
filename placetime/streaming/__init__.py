"""Streaming form of the dashboard's live counts.

The reference has no streaming code; this package only re-runs the same
batch operators incrementally (Structured Streaming) so the hourly counts of
an incident feed stay current as files arrive.
"""

from .hourly import hourly_counts_stream, start_hourly_counts

__all__ = ["hourly_counts_stream", "start_hourly_counts"]
