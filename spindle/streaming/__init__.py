"""Structured Streaming jobs."""

from .jobs import (decode_messages, dedup_stream, file_arrivals, message_stream,
                   metrics_batch_writer, per_file_line_counts, progress_durations,
                   run_available_now, run_foreach_batch)

__all__ = ["decode_messages", "dedup_stream", "file_arrivals", "message_stream",
           "metrics_batch_writer", "per_file_line_counts", "progress_durations",
           "run_available_now", "run_foreach_batch"]
