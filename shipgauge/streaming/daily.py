"""The daily delivery and ML rollups as streaming aggregations.

Days are event-time windows of one day (UTC); a day is emitted once, in
append mode, when the watermark (newest event time minus ``lateness``) has
passed its end, so events up to ``lateness`` late still count. The
aggregates are exactly those of the batch rollups; state holds one partial
row per open (day, team) or (day, team, model).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shipgauge.config import DEFAULT, PipelineConfig
from shipgauge.operators.rollups import dora_aggregates, dora_inputs, ml_aggregates, ml_inputs
from shipgauge.operators.staging import stage_delivery_events, stage_ml_events


def _instant(df: DataFrame) -> DataFrame:
    """Watermarks need an instant; under the UTC session the wall clock is kept."""
    if isinstance(df.schema["event_timestamp"].dataType, T.TimestampNTZType):
        return df.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    return df


def _by_day(rows: DataFrame, keys: list[str], aggs, lateness: str) -> DataFrame:
    daily = (rows.withWatermark("event_timestamp", lateness)
             .groupBy(F.window("event_timestamp", "1 day").alias("_day"), *keys).agg(*aggs))
    return daily.select(F.to_date(F.col("_day.start")).alias("date_day"), *keys,
                        *[c for c in daily.columns if c not in ("_day", *keys)])


def stream_delivery_daily(raw_stream: DataFrame, lateness: str = "2 days",
                          cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Delivery rollup per (date_day, team) over a stream of raw delivery events."""
    rows = dora_inputs(_instant(stage_delivery_events(raw_stream)))
    return _by_day(rows, ["team"], dora_aggregates(), lateness)


def stream_ml_daily(raw_stream: DataFrame, lateness: str = "2 days",
                    cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """ML rollup per (date_day, team, model_name) over a stream of raw ML events."""
    rows = ml_inputs(_instant(stage_ml_events(raw_stream, cfg)))
    return _by_day(rows, ["team", "model_name"], ml_aggregates(), lateness)
