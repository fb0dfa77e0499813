"""Typed sources, the generic-event adapter and sinks."""

from shipgauge.sources.events import (
    adapt_delivery_events,
    adapt_ml_events,
    conform,
    read_delivery_events,
    read_events,
    read_ml_events,
)
from shipgauge.sources.sinks import (
    RequiredColumnError,
    ingest_overwrite,
    output_schema,
    required_violations,
    table_path,
    write_table,
)
