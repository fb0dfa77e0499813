"""Streaming load and daily rollup agree with the batch operators."""

import tempfile

from pyspark.sql import functions as F

from shipgauge.operators.rollups import dora_daily
from shipgauge.operators.staging import stage_delivery_events
from shipgauge.schemas import DELIVERY_EVENTS
from shipgauge.sources.events import adapt_delivery_events
from shipgauge.streaming import ingest_stream, read_loaded, stream_delivery_daily

SF = "/root/testdata/sf0.001"


def test_incremental_load_then_streaming_rollup(spark):
    root = tempfile.mkdtemp(prefix="sg-stream-")
    events = spark.read.parquet(f"{SF}/events.parquet")
    # the generic log arrives as three files
    events.repartition(3).write.parquet(f"{root}/incoming")

    q = ingest_stream(spark, f"{root}/incoming", events.schema, DELIVERY_EVENTS, f"{root}/raw",
                      checkpoint=f"{root}/ck-ingest", transform=adapt_delivery_events,
                      max_files_per_trigger=1)
    q.awaitTermination()
    loaded = read_loaded(spark, f"{root}/raw", DELIVERY_EVENTS)
    batch = adapt_delivery_events(events)
    assert loaded.count() == batch.count() == 1000
    assert loaded.exceptAll(batch).count() == 0

    # a second run finds nothing new: exactly once
    ingest_stream(spark, f"{root}/incoming", events.schema, DELIVERY_EVENTS, f"{root}/raw",
                  checkpoint=f"{root}/ck-ingest", transform=adapt_delivery_events).awaitTermination()
    assert read_loaded(spark, f"{root}/raw", DELIVERY_EVENTS).count() == 1000

    raw_stream = spark.readStream.schema(loaded.schema).parquet(f"{root}/raw")
    daily = stream_delivery_daily(raw_stream, lateness="1 day")
    sq = (daily.writeStream.outputMode("append").format("memory").queryName("sg_daily")
          .option("checkpointLocation", f"{root}/ck-daily").trigger(availableNow=True).start())
    sq.awaitTermination()
    got = spark.table("sg_daily")
    assert got.count() > 0
    want = dora_daily(stage_delivery_events(batch)).join(got.select("date_day").distinct(), "date_day")
    assert got.count() == want.count()
    def rounded(df):
        return df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])

    assert rounded(got).exceptAll(rounded(want.select(*got.columns))).count() == 0
    # every emitted day is closed: at least one day's lateness before the newest event
    newest = batch.agg(F.max("event_date")).first()[0]
    assert got.agg(F.max("date_day")).first()[0] < newest.date()


def test_streaming_ml_rollup_matches_batch(spark):
    from shipgauge.operators.rollups import ml_delivery_daily
    from shipgauge.operators.staging import stage_ml_events
    from shipgauge.schemas import ML_EVENTS
    from shipgauge.sources.events import adapt_ml_events
    from shipgauge.streaming import stream_ml_daily

    root = tempfile.mkdtemp(prefix="sg-stream-ml-")
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.repartition(2).write.parquet(f"{root}/incoming")
    ingest_stream(spark, f"{root}/incoming", events.schema, ML_EVENTS, f"{root}/raw",
                  checkpoint=f"{root}/ck-ingest", transform=adapt_ml_events).awaitTermination()
    loaded = read_loaded(spark, f"{root}/raw", ML_EVENTS)
    stream = spark.readStream.schema(loaded.schema).parquet(f"{root}/raw")
    sq = (stream_ml_daily(stream, lateness="1 day").writeStream.outputMode("append").format("memory")
          .queryName("sg_ml_daily").option("checkpointLocation", f"{root}/ck-daily")
          .trigger(availableNow=True).start())
    sq.awaitTermination()
    got = spark.table("sg_ml_daily")
    want = ml_delivery_daily(stage_ml_events(adapt_ml_events(events))).join(
        got.select("date_day").distinct(), "date_day")

    def rounded(df):
        return df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])

    assert got.count() > 0 and got.count() == want.count()
    assert rounded(got).exceptAll(rounded(want.select(*got.columns))).count() == 0
