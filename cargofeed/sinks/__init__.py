"""Feed sinks."""

from .csv import NoDataError, export_feed, feed_path, read_feed

__all__ = ["NoDataError", "export_feed", "feed_path", "read_feed"]
