"""Incremental load of raw event files.

The batch load replaces a table; this is the same load for files that keep
arriving: each micro-batch is cast to the raw schema, refused as a whole if
a REQUIRED column holds a NULL (the query stops, the batch is not committed
and is retried after a fix), and written to its own ``load_batch=<id>``
folder with overwrite, so a retried batch replaces its own output and
nothing is loaded twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shipgauge.session import shared_dir
from shipgauge.sources.events import conform
from shipgauge.sources.sinks import RequiredColumnError, required_violations


def ingest_stream(spark: SparkSession, source_path: str, source_schema: T.StructType,
                  schema: T.StructType, target_path: str, checkpoint: str | None = None,
                  transform: Callable[[DataFrame], DataFrame] | None = None,
                  source_format: str = "parquet", available_now: bool = True,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the load; with ``available_now`` it processes what is there and stops."""
    reader = spark.readStream.schema(source_schema).format(source_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(source_path)
    if transform is not None:
        stream = transform(stream)
    typed = conform(stream, schema)

    def load(batch: DataFrame, batch_id: int) -> None:
        bad = required_violations(batch, schema)
        if bad:
            raise RequiredColumnError(f"batch {batch_id}: NULL in REQUIRED columns {bad}")
        batch.write.mode("overwrite").parquet(f"{target_path.rstrip('/')}/load_batch={batch_id}")

    if checkpoint is None:
        # stable across processes, so a restarted load resumes from its own checkpoint
        digest = hashlib.sha1(target_path.encode()).hexdigest()[:16]
        checkpoint = f"{shared_dir(spark)}/shipgauge/checkpoints/ingest-{digest}"
    writer = typed.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_loaded(spark: SparkSession, target_path: str, schema: T.StructType) -> DataFrame:
    """The loaded table, all batches, in the raw schema."""
    return conform(spark.read.parquet(target_path), schema)
