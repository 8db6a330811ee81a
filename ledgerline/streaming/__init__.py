from .live import (bronze_stream, dedupe_stream, follow_hours, hourly_metrics_stream, latest_stream,
                   stream_hours, stream_table, stream_upsert)

__all__ = ["bronze_stream", "dedupe_stream", "follow_hours", "hourly_metrics_stream", "latest_stream",
           "stream_hours", "stream_table", "stream_upsert"]
