"""Rolling aggregates over daily rows.

"Last N days" here means the last N *rows* of the partition (days with
activity), which is what the original pipeline computes; a calendar-day
variant is offered beside it. Every spec of one call shares a single window
specification, so Spark evaluates them in one sort and one window pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_AGGS = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count}


@dataclass(frozen=True)
class Rolling:
    name: str
    agg: str
    column: str
    rows: int  # frame is (rows - 1) preceding .. current row


def add_rolling(df: DataFrame, partition_by: Sequence[str], order_by: str,
                specs: Sequence[Rolling]) -> DataFrame:
    """Append one column per spec: ``agg(column)`` over the last ``rows`` rows.

    NULL inputs are skipped by the aggregate, so an average over a frame of
    only NULLs is NULL. The partition holds one row per (key, day), so a task
    never holds more rows than one key has days.
    """
    base = Window.partitionBy(*partition_by).orderBy(order_by)
    return df.select(
        "*",
        *[_AGGS[s.agg](s.column).over(base.rowsBetween(-(s.rows - 1), Window.currentRow)).alias(s.name)
          for s in specs],
    )


def add_calendar_rolling(df: DataFrame, partition_by: Sequence[str], day_col: str,
                         specs: Sequence[Rolling]) -> DataFrame:
    """Same as :func:`add_rolling` but over the last ``rows`` calendar days,
    ending at the current row's day (``rows`` = days)."""
    day_number = F.unix_date(F.col(day_col))
    base = Window.partitionBy(*partition_by).orderBy(day_number)
    return df.select(
        "*",
        *[_AGGS[s.agg](s.column).over(base.rangeBetween(-(s.rows - 1), 0)).alias(s.name)
          for s in specs],
    )
