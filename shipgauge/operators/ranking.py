"""Places in an order over a whole table, without a task that holds the table.

Rows are dealt to tasks by ranges of the order, sorted there and numbered within;
a range starts from the count of the ranges before it, of which there are as
many as shuffle partitions. The sorted ranges are written once to the shared
folder, so that the numbers and the counts come from the same division.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shipgauge.session import scratch_path

_WITHIN = 33  # bits of Spark's monotonically increasing id below the partition's number


def with_place(df: DataFrame, order: Sequence[Column], out: str = "place") -> DataFrame:
    """Append ``out`` (bigint): each row's place, from 1, in the given order.

    Like ``row_number()`` over the whole table: rows equal in ``order`` get
    different places, in any order; add a key to have it repeatable. NULLs go
    where ``order`` says (first when ascending). No rows give no rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "places")
    ranged = df.drop(out).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ranged.write.parquet(path)
    rows = spark.read.schema(ranged.schema).parquet(path).withColumn("_range", F.shiftright("_at", _WITHIN))
    # one row for each range
    sizes = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    within = F.col("_at") - F.shiftleft(F.col("_range"), _WITHIN)
    return (rows.join(F.broadcast(starts), "_range")
            .select(*[c for c in df.columns if c != out], (F.col("_before") + within + 1).cast("bigint").alias(out)))
