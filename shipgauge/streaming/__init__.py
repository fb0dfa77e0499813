"""Structured Streaming forms of the raw-table load and the daily rollups."""

from shipgauge.streaming.daily import stream_delivery_daily, stream_ml_daily
from shipgauge.streaming.ingest import ingest_stream, read_loaded
