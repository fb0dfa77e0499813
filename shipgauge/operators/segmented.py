"""Skew-tolerant ordered scans: next-event pairing and in-group sequence numbers.

Both are running scans over events sorted by time within a key. A window
partitioned by the key alone puts all of one key's events into one task;
with one key holding a third of all rows, that task is the whole job.

Both operators therefore scan over a hierarchy of time buckets, coarse to fine
(``units``, e.g. hour and second). The finest buckets are scanned event by
event. What a bucket needs from the rest of its key is one value, the *carry*:
the first close in any later bucket, or the number of rows in earlier buckets.
Carries go down the hierarchy. On each level a window over the children of one
bucket combines the carry of that bucket, a row that sorts first, with the
summaries of the children that come before; summaries go up by aggregates that
Spark combines map-side. So the windows of the coarsest level hold one row for
each hour of a key's time span, those below one row for each second of an hour,
and the last ones the events of one second: no window grows with the number of
a key's events, even if all of them fall in one hour.

Rows and carry rows are each hash-partitioned on key and bucket and then
unioned, which keeps the partitioning. Pairing scans distinct instants only, so
any number of events at one instant count as one row there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH = "1970-01-01 00:00:00"
UNITS = ("hour", "second")


def time_bucket(df: DataFrame, ts: str, unit: str) -> Column:
    """Whole ``unit``s elapsed since the epoch; non-decreasing in ``ts``."""
    dtype = df.schema[ts].dataType
    epoch = F.lit(_EPOCH).cast(dtype if isinstance(dtype, (T.TimestampType, T.TimestampNTZType))
                               else T.TimestampType())
    return F.timestamp_diff(unit.upper(), epoch, F.col(ts))


def _levels(bucket: str | Sequence[str] | None) -> list[str]:
    return [] if bucket is None else [bucket] if isinstance(bucket, str) else list(bucket)


def _carried(rows: DataFrame, carry: DataFrame | None, part: Sequence[str]) -> DataFrame:
    """``rows`` (``_carry`` false) and ``carry`` (true), both partitioned by ``part``."""
    rows = rows.withColumn("_carry", F.lit(False))
    if carry is None:
        return rows
    return rows.repartition(*part).unionByName(carry.withColumn("_carry", F.lit(True)).repartition(*part), allowMissingColumns=True)


def pair_next(events: DataFrame, keys: Sequence[str], ts: str, is_open: Column, is_close: Column,
              keep: Sequence[str], out: str = "next_at", bucket: str | Sequence[str] | None = UNITS,
              distinct_opens: bool = False) -> DataFrame:
    """For every open event, the earliest close event of the same ``keys``
    whose ``ts`` is strictly later; NULL when there is none.

    Equal timestamps never pair (an open and a close at the same instant do
    not match), several opens may share one close, a NULL key matches nothing
    and an open without a time has no later close. Open events that are equal
    in ``keys``, ``ts`` and ``keep`` are one event loaded twice and give one
    row. The result has ``keys``, ``ts``, ``keep`` and ``out``; with
    ``distinct_opens`` there is one row per keys and instant, with the least
    values of ``keep``.

    The scan runs over distinct instants of a key, to which Spark reduces the
    events map-side; opens get their instant's answer by an equi-join, so many
    opens at one instant are rows of a skewed join, not of one window.
    ``bucket`` names the units of the hierarchy, coarse to fine; with ``None``
    each key is one window partition (no hot keys).
    """
    keys = list(keys)
    payload = [c for c in keep if c not in keys and c != ts]
    # as in an equi-join, a NULL key matches nothing: such closes never pair
    for k in keys:
        is_close = is_close & F.col(k).isNotNull()
    least = [F.min(F.when(is_open, F.col(c))).alias(c) for c in payload] if distinct_opens else []
    instants = (events.where(is_open | is_close).groupBy(*keys, F.col(ts).alias("_ts"))
                .agg(F.max(F.coalesce(is_open, F.lit(False))).alias("_open"),
                     F.max(F.when(is_close, F.col(ts))).alias("_close"), *least))

    units = _levels(bucket)
    buckets = [f"_b{i}" for i in range(len(units))]
    for name, unit in zip(buckets, units, strict=True):
        instants = instants.withColumn(name, time_bucket(instants, "_ts", unit))
    # summaries go up: the first close of every bucket, and whether anything in it asks for a carry
    sums: list[DataFrame] = []
    for i in reversed(range(len(units))):
        below = sums[0] if sums else instants
        sums.insert(0, below.groupBy(*keys, *buckets[:i + 1]).agg(F.min("_close").alias("_close"), F.max("_open").alias("_open")))
    # carries go down: the first close of any later bucket
    carry = None
    for i, summary in enumerate(sums):
        part = [*keys, *buckets[:i]]
        rows = _carried(summary, carry, part)
        later = (Window.partitionBy(*part).orderBy(F.col("_carry").desc(), F.col(buckets[i]).desc())
                 .rowsBetween(Window.unboundedPreceding, -1))
        carry = (rows.select(*part, buckets[i], "_carry", "_open", F.min("_close").over(later).alias("_close"))
                 .where(~F.col("_carry") & F.col("_open") & F.col("_close").isNotNull()).select(*part, buckets[i], "_close"))
    part = [*keys, *buckets]
    if carry is not None:
        carry = carry.withColumn("_open", F.lit(False))
    # Latest first, the carry row (the future beyond this bucket) before all; the frame ends
    # before the instant itself, whose own close is not later.
    ahead = (Window.partitionBy(*part).orderBy(F.col("_carry").desc(), F.col("_ts").desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    answer = F.when(F.col("_ts").isNotNull(), F.min("_close").over(ahead)).alias(out)
    answers = _carried(instants, carry, part).select(*keys, F.col("_ts").alias(ts), answer, "_open",
                                                     *(payload if distinct_opens else []))
    answers = answers.where(F.col("_open")).drop("_open")
    if distinct_opens:
        return answers.select(*keys, ts, *payload, out)
    opens = events.where(is_open).select(*keys, ts, *payload).distinct()
    return opens.join(answers.where(F.col(out).isNotNull()), [*keys, ts], "left").select(*keys, ts, *payload, out)


def sequence_number(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], out: str,
                    ts: str | None = None, bucket: str | Sequence[str] | None = UNITS,
                    attach: Sequence[tuple[DataFrame, Sequence[str]]] = ()) -> DataFrame:
    """``row_number()`` over (partition by ``keys`` order by ``order_by``), as bigint.

    With ``bucket`` the numbering goes down a hierarchy of time buckets of
    ``ts`` (the first ``order_by`` column must be ``ts``): each bucket counts
    its own rows and starts from a carried-in count of its key's earlier ones.

    ``attach`` left-joins per-key tables (``(table, join keys)``, join keys a
    subset of ``keys``) onto every row. In the bucketed form they are joined
    onto one row per key, from which carries go down, and spread along the
    windows, so the numbered rows are never shuffled for a join.
    """
    keys = list(keys)
    order = [F.col(c) for c in order_by]
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        out_df = df.withColumn(out, F.row_number().over(w).cast("bigint"))
        for table, on in attach:
            out_df = out_df.join(table, list(on), "left")
        return out_df
    ts = ts or order_by[0]
    if order_by[0] != ts:
        raise ValueError("bucketed numbering needs the bucket time as first order column")
    units = _levels(bucket)
    buckets = [f"_b{i}" for i in range(len(units))]
    base = df
    for name, unit in zip(buckets, units, strict=True):
        base = base.withColumn(name, time_bucket(df, ts, unit))
    # counts go up
    counts: list[DataFrame] = []
    for i in reversed(range(len(units))):
        n = F.sum("_n") if counts else F.count(F.lit(1))
        counts.insert(0, (counts[0] if counts else base).groupBy(*keys, *buckets[:i + 1]).agg(n.alias("_n")))
    # one row per key, with a count of nothing before it and the attached values
    carry = counts[0].groupBy(*keys).agg(F.lit(0).cast("bigint").alias("_n"))
    attached: list[str] = []
    for table, on in attach:
        extra = [c for c in table.columns if c not in on]
        carry = carry.join(table.select(*on, *[F.col(c).alias(f"_a_{c}") for c in extra]), list(on), "left")
        attached += extra
    if not attached:
        carry = None
    spread = [f"_a_{c}" for c in attached]

    def along(part: Sequence[str], by: Sequence[Column]):
        # the carry row sorts first, so the frame's first values are its values
        window = Window.partitionBy(*part).orderBy(F.col("_carry").desc(), *by)
        first = [F.first(c).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(c) for c in spread]
        return window, first

    for i, count in enumerate(counts):
        part = [*keys, *buckets[:i]]
        rows = _carried(count, carry, part)
        window, first = along(part, [F.col(buckets[i]).asc()])
        before = F.coalesce(F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("bigint")
        carry = (rows.select(*part, buckets[i], "_carry", before.alias("_before"), *first).where(~F.col("_carry"))
                 .select(*part, buckets[i], F.col("_before").alias("_n"), *spread))
    part = [*keys, *buckets]
    rows = _carried(base.withColumn("_n", F.lit(1).cast("bigint")), carry, part)
    window, first = along(part, order)
    number = F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("bigint")
    numbered = rows.select(*df.columns, "_carry", number.alias(out), *first).where(~F.col("_carry"))
    return numbered.select(*df.columns, out, *[F.col(f"_a_{c}").alias(c) for c in attached])
