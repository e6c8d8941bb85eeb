"""Structured Streaming ingest: drain-and-stop appends, watermark dedup, streaming CDC."""

from voltaic.streaming.ingest import *  # noqa: F401,F403
