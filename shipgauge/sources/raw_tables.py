"""Raw event tables as catalog tables: partitioned by day, bucketed by team.

A query over some days reads those days' files only, and what is grouped or
windowed by team (the daily rollups, the rolling windows, joins on day and team)
keeps the files' division into buckets instead of shuffling the events. The
price is that a team's rows of all days are read by one task unless the plan
aggregates them first, so a log in which one team holds much of the rows is
better left without buckets (``buckets=None``): partitioned only, and shuffled.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shipgauge.session import require_utc
from shipgauge.sources.events import conform

DAY = "event_day"
PIECES = 8  # files that the rows of one (day, team) are spread over when written


def save_raw_table(df: DataFrame, schema: T.StructType, name: str, path: str, buckets: int | None = 32,
                   pieces: int = PIECES) -> None:
    """Write ``df``, cast to ``schema``, as the table ``name`` at ``path``, replacing it.

    Rows are dealt to the writers by day, team and a piece of the event id, so
    that a team with a third of a day's rows is written by several tasks.
    """
    require_utc(df.sparkSession)
    typed = conform(df, schema).withColumn(DAY, F.to_date("event_date"))
    dealt = typed.repartition(F.col(DAY), F.col("team"), F.pmod(F.xxhash64("event_id"), F.lit(pieces)))
    writer = dealt.write.format("parquet").mode("overwrite").option("path", path).partitionBy(DAY)
    if buckets:
        writer = writer.bucketBy(buckets, "team")
    writer.saveAsTable(name)


def read_raw_table(spark: SparkSession, name: str, schema: T.StructType, since: str | dt.date | None = None,
                   until: str | dt.date | None = None) -> DataFrame:
    """The table's events from day ``since`` to day ``until`` (inclusive), with the declared columns.

    The types are the declared ones, fixed when the table was written, so filters
    reach the scan without casts; the days prune partitions. Events without a
    time are read only if no day is asked for.
    """
    require_utc(spark)
    rows = spark.table(name)
    if since is not None:
        rows = rows.where(F.col(DAY) >= F.lit(str(since)).cast("date"))
    if until is not None:
        rows = rows.where(F.col(DAY) <= F.lit(str(until)).cast("date"))
    return rows.select(*schema.fieldNames())
