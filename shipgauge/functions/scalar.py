"""Column expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
code generation; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_day(ts: str | Column) -> Column:
    """Calendar day of a timestamp (UTC session) or timestamp_ntz."""
    return F.to_date(col(ts))


def whole_hours(start: str | Column, end: str | Column) -> Column:
    """Whole elapsed hours from ``start`` to ``end``, truncated toward zero.

    00:59:59 -> 01:00:00 is 0 hours: elapsed time, not hour boundaries crossed.
    NULL when either side is NULL.
    """
    return F.timestamp_diff("HOUR", col(start), col(end))


def safe_ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """``numerator / denominator`` as double; NULL when the denominator is 0 or NULL."""
    return F.try_divide(col(numerator).cast("double"),
                        F.nullif(col(denominator), F.lit(0)).cast("double"))


def safe_clamp(x: str | Column, low: float = 0.0, high: float = 100.0) -> Column:
    """Clamp into [low, high], keeping NULL as NULL.

    Spark's ``least``/``greatest`` skip NULL arguments, so an unguarded clamp
    turns a missing input into ``high``; the guard keeps it missing.
    """
    x = col(x)
    return F.when(x.isNotNull(), F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), x)))


def step_at_least(x: str | Column, steps: Iterable[tuple[float, float]], floor: float) -> Column:
    """First ``score`` whose ``x >= threshold``, else ``floor`` (NULL x -> floor)."""
    x = col(x)
    out = None
    for threshold, score in steps:
        cond = x >= F.lit(threshold)
        out = F.when(cond, F.lit(float(score))) if out is None else out.when(cond, F.lit(float(score)))
    return out.otherwise(F.lit(float(floor)))


def step_at_most(x: str | Column, steps: Iterable[tuple[float, float]], floor: float,
                 zero_score: float | None = None) -> Column:
    """First ``score`` whose ``x <= threshold``, else ``floor`` (NULL x -> floor).

    ``zero_score`` is checked first for ``x = 0``.
    """
    x = col(x)
    out = None
    if zero_score is not None:
        out = F.when(x == F.lit(0), F.lit(float(zero_score)))
    for threshold, score in steps:
        cond = x <= F.lit(threshold)
        out = F.when(cond, F.lit(float(score))) if out is None else out.when(cond, F.lit(float(score)))
    return out.otherwise(F.lit(float(floor)))


def psi_severity(psi: str | Column, warning_from: float, critical_above: float) -> Column:
    """stable below ``warning_from``; warning up to and including ``critical_above``;
    critical above it; NULL for NULL."""
    psi = col(psi)
    return (F.when(psi < F.lit(warning_from), F.lit("stable"))
            .when(psi.between(F.lit(warning_from), F.lit(critical_above)), F.lit("warning"))
            .when(psi > F.lit(critical_above), F.lit("critical")))


def response_tier(hours: str | Column, answered_at: str | Column, fast_max: int, medium_max: int) -> Column:
    """no_response when unanswered, else fast / medium / slow on whole hours."""
    hours = col(hours)
    return (F.when(col(answered_at).isNull(), F.lit("no_response"))
            .when(hours <= F.lit(fast_max), F.lit("fast"))
            .when(hours <= F.lit(medium_max), F.lit("medium"))
            .otherwise(F.lit("slow")))


def tier(score: str | Column, healthy_from: float, warning_from: float) -> Column:
    """healthy / warning / critical; a NULL score is critical."""
    score = col(score)
    return (F.when(score >= F.lit(healthy_from), F.lit("healthy"))
            .when(score >= F.lit(warning_from), F.lit("warning"))
            .otherwise(F.lit("critical")))


def weighted_sum(columns: Iterable[str | Column], weights: Iterable[float]) -> Column:
    """``c1 * w1 + c2 * w2 + ...`` summed left to right, in the given order.

    The order is part of the result: rounding the sum at one decimal can
    differ in the last place if the terms are added in another order.
    """
    total = None
    for c, w in zip(columns, weights):
        term = col(c) * F.lit(float(w))
        total = term if total is None else total + term
    return total


def lookup(key: str | Column, mapping: Mapping[str, str]) -> Column:
    """Value of ``mapping[key]`` as a literal map lookup; NULL for unknown keys."""
    if not mapping:
        return F.lit(None).cast("string")
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), col(key))


def team_day_key(team: str | Column, day: str | Column) -> Column:
    """Primary entity of the daily mart: ``<team>_<yyyy-mm-dd>``."""
    return F.concat(col(team), F.lit("_"), col(day).cast("string"))
