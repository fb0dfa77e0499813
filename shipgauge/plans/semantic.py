"""A small declarative metric layer over the daily health mart.

Measures name an aggregate over a mart column; metrics name a measure.
``metric_query`` compiles a request into one ``groupBy().agg()`` so every
requested metric is computed in the same pass over the mart.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shipgauge.config import SPINE_END, SPINE_START
from shipgauge.functions.scalar import team_day_key


@dataclass(frozen=True)
class Measure:
    name: str
    agg: str  # "sum" or "average"
    expr: str


@dataclass(frozen=True)
class Metric:
    name: str
    measure: str
    label: str = ""


# Measures and metrics of the health mart.
MEASURES = {m.name: m for m in (
    Measure("deployments", "sum", "deployment_count"),
    Measure("avg_lead_time", "average", "avg_lead_time_days"),
    Measure("ci_failure_rate_avg", "average", "ci_failure_rate"),
    Measure("avg_mttr", "average", "avg_mttr_hours"),
    Measure("training_runs", "sum", "training_run_count"),
    Measure("model_deployments", "sum", "model_deployment_count"),
    Measure("drift_failure_rate_avg", "average", "drift_failure_rate"),
    Measure("avg_precision", "average", "avg_precision_at_10"),
    Measure("incidents", "sum", "incident_count"),
    Measure("avg_retrain_response", "average", "avg_retrain_response_hours"),
    Measure("health_score_value", "average", "health_score"),
)}

METRICS = {m.name: m for m in (
    Metric("deployment_frequency", "deployments", "Deployment Frequency"),
    Metric("lead_time_for_change", "avg_lead_time", "Lead Time for Change (days)"),
    Metric("change_failure_rate", "ci_failure_rate_avg", "Change Failure Rate"),
    Metric("mean_time_to_recover", "avg_mttr", "MTTR (hours)"),
    Metric("model_training_frequency", "training_runs", "Model Training Frequency"),
    Metric("model_deployment_frequency", "model_deployments", "Model Deployment Frequency"),
    Metric("drift_failure_rate", "drift_failure_rate_avg", "Drift Failure Rate"),
    Metric("platform_health_score", "health_score_value", "Platform Health Score (0-100)"),
    Metric("retrain_response_time", "avg_retrain_response", "Retrain Response Time (hours)"),
)}

TIME_DIMENSION = "date_day"
CATEGORICAL_DIMENSIONS = ("team", "health_tier")
PRIMARY_ENTITY = "team_day"
GRAINS = ("day", "week", "month", "quarter", "year")


def _aggregate(measure: Measure) -> Column:
    c = F.col(measure.expr)
    return F.sum(c) if measure.agg == "sum" else F.avg(c)


def _resolve(name: str) -> Measure:
    if name in METRICS:
        return MEASURES[METRICS[name].measure]
    if name in MEASURES:
        return MEASURES[name]
    raise KeyError(f"unknown metric or measure {name!r}")


def metric_time(grain: str = "day") -> Column:
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    day = F.col(TIME_DIMENSION)
    return day if grain == "day" else F.date_trunc(grain, day).cast("date")


def with_entity(mart: DataFrame) -> DataFrame:
    """Adds the primary entity ``team_day`` = ``<team>_<date_day>``."""
    return mart.withColumn("team_day", team_day_key("team", TIME_DIMENSION))


def metric_query(mart: DataFrame, metrics: Sequence[str], group_by: Sequence[str] = ("metric_time",),
                 grain: str = "day", where: Column | str | None = None) -> DataFrame:
    """Aggregate metrics (or bare measures) by ``metric_time`` at ``grain``
    and/or categorical dimensions or the primary entity. Output columns: ``metric_time__<grain>``,
    the dimensions, then one column per requested metric."""
    src = with_entity(mart) if where is None else with_entity(mart).where(where)
    keys = []
    for g in group_by:
        if g == "metric_time":
            keys.append(metric_time(grain).alias(f"metric_time__{grain}"))
        elif g in (*CATEGORICAL_DIMENSIONS, PRIMARY_ENTITY):
            keys.append(F.col(g))
        else:
            raise KeyError(f"unknown dimension {g!r}")
    aggs = [_aggregate(_resolve(m)).alias(m) for m in metrics]
    return src.groupBy(*keys).agg(*aggs) if keys else src.agg(*aggs)


def time_spine(spark: SparkSession, start: str = SPINE_START, end: str = SPINE_END) -> DataFrame:
    """One row per day from ``start`` to ``end`` (end exclusive), as ``date_day``."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"),
                             F.date_sub(F.lit(end).cast("date"), 1))).alias("date_day"))


def spine_between(bounds: DataFrame) -> DataFrame:
    """Day spine over a one-row frame of (start, end) dates, both inclusive."""
    return bounds.select(F.explode(F.sequence(F.col("start"), F.col("end"))).alias("date_day"))


def data_spine(mart: DataFrame) -> DataFrame:
    """Day spine covering the mart's first to last day."""
    return spine_between(mart.agg(F.min(TIME_DIMENSION).alias("start"), F.max(TIME_DIMENSION).alias("end")))


def gap_filled_by(metrics: DataFrame, dimensions: Sequence[str], grain: str = "day", bounds: str = "data",
                  fill: dict | None = None) -> DataFrame:
    """Every group of ``dimensions`` with a row for every ``grain`` of time.

    ``metrics`` is grouped by ``metric_time__<grain>`` and ``dimensions``. With
    ``bounds="group"`` a group's spine runs from its own first to its last time,
    with ``"data"`` from the first to the last of all groups. A spine is made
    from its two ends, so a group costs two values before it is unfolded, in
    whatever task it falls. Missing rows have NULL metrics, or ``fill`` values;
    a NULL dimension is a group; rows without a time are left out. No rows give
    no rows.
    """
    if bounds not in ("group", "data"):
        raise ValueError("bounds is 'group' or 'data'")
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    time, dims = f"metric_time__{grain}", list(dimensions)
    known = metrics.where(F.col(time).isNotNull()).withColumn("_group", F.struct(F.lit(0).alias("_"), *dims))
    ends = [F.min(time).alias("_from"), F.max(time).alias("_to")]
    groups = known.groupBy("_group").agg(*ends)
    if bounds == "data":
        first, last = (known.select(f(time)).scalar() for f in (F.min, F.max))
        groups = groups.select("_group", first.alias("_from"), last.alias("_to"))
    step = F.expr({"day": "interval 1 day", "week": "interval 7 days", "month": "interval 1 month",
                   "quarter": "interval 3 months", "year": "interval 1 year"}[grain])
    spine = groups.select("_group", F.explode(F.sequence("_from", "_to", step)).alias(time))
    # a struct of dimensions is never NULL itself, so NULL dimensions meet in an ordinary equi-join
    values = known.drop(*dims)
    out = spine.join(values, ["_group", time], "left").select(
        time, *[F.col("_group")[d].alias(d) for d in dims], *[c for c in values.columns if c not in ("_group", time)])
    return out.fillna(fill) if fill else out


def gap_filled(metric_by_day: DataFrame, spine: DataFrame, fill: dict | None = None) -> DataFrame:
    """Every spine day with its metric values; days without data get NULL,
    or ``fill`` values. ``metric_by_day`` must be grouped by
    ``metric_time__day`` only."""
    m = metric_by_day.withColumnRenamed("metric_time__day", "date_day")
    out = spine.join(m, ["date_day"], "left").withColumnRenamed("date_day", "metric_time__day")
    return out.fillna(fill) if fill else out
