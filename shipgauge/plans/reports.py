"""Dashboard and alert queries over the health mart and the run facts.

"Latest day" filters use a scalar subquery (``DataFrame.scalar``): Spark
computes the max once and compares every row against it, and on a mart
written ``partitionBy("date_day")`` the comparison prunes partitions.
Ordering happens only here, at the presentation edge.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipgauge.operators.ranking import with_place

_BY_DAY_TEAM = ("date_day", "team")


def _on_latest_day(mart: DataFrame) -> DataFrame:
    latest = mart.select(F.max("date_day")).scalar()
    return mart.where(F.col("date_day") == latest)


def _pct(c: str, digits: int) -> Column:
    return F.round(F.col(c) * F.lit(100), digits)


def latest_day(mart: DataFrame) -> DataFrame:
    return mart.agg(F.max("date_day").alias("latest_day"))


def health_today(mart: DataFrame) -> DataFrame:
    """Scores of the latest day, worst first (NULL scores first)."""
    return (_on_latest_day(mart)
            .select("team", "health_score", "health_tier", "deployments_last_7d",
                    _pct("ci_failure_rate_7d_avg", 1).alias("ci_failure_rate_pct"),
                    _pct("drift_failure_rate_7d_avg", 1).alias("drift_failure_rate_pct"),
                    F.round("avg_mttr_hours", 1).alias("avg_mttr_hours"))
            .orderBy(F.asc("health_score")))


def health_trend(mart: DataFrame) -> DataFrame:
    return mart.select("date_day", "team", "health_score", "health_tier").orderBy(*_BY_DAY_TEAM)


def deploy_freq(mart: DataFrame) -> DataFrame:
    return (mart.select("date_day", "team", F.col("deployments_last_7d").alias("deployments_7d_rolling"))
            .orderBy(*_BY_DAY_TEAM))


def lead_time(mart: DataFrame) -> DataFrame:
    return (mart.where(F.col("avg_lead_time_days").isNotNull())
            .select("date_day", "team", "avg_lead_time_days", "p50_lead_time_days", "p95_lead_time_days")
            .orderBy(*_BY_DAY_TEAM))


def change_failure_rate(mart: DataFrame) -> DataFrame:
    return (mart.select("date_day", "team", _pct("ci_failure_rate_7d_avg", 2).alias("failure_rate_pct"))
            .orderBy(*_BY_DAY_TEAM))


def mttr(mart: DataFrame) -> DataFrame:
    """Days with at least one closed incident (zero-filled days left out)."""
    return (mart.where(F.col("incident_count") > 0)
            .select("date_day", "team", "avg_mttr_hours")
            .orderBy(*_BY_DAY_TEAM))


def precision_trend(mart: DataFrame) -> DataFrame:
    return (mart.where(F.col("avg_precision_at_10") > 0)
            .select("date_day", "team", "avg_precision_at_10")
            .orderBy(*_BY_DAY_TEAM))


def drift(mart: DataFrame) -> DataFrame:
    return (mart.select("date_day", "team", _pct("drift_failure_rate_7d_avg", 2).alias("drift_rate_pct"))
            .orderBy(*_BY_DAY_TEAM))


def ml_deploy(mart: DataFrame) -> DataFrame:
    return (mart.select("date_day", "team", "training_run_count", "model_deployment_count")
            .orderBy(*_BY_DAY_TEAM))


def psi_distribution(ml_runs: DataFrame, as_of: str | dt.date, days: int = 30) -> DataFrame:
    """Runs and mean PSI per (team, model, severity) over runs on or after
    ``as_of - days``; highest mean PSI first. ``as_of`` is a parameter (not
    the clock) so the answer repeats."""
    since = F.date_sub(F.lit(str(as_of)).cast("date"), days)
    return (ml_runs.where(F.col("run_day") >= since)
            .groupBy("team", "model_name", "psi_severity")
            .agg(F.count(F.lit(1)).alias("run_count"), F.round(F.avg("psi_score"), 3).alias("avg_psi"))
            .orderBy(F.desc("avg_psi")))


def health_report(mart: DataFrame) -> DataFrame:
    """Alert report: latest day per team, percentages, worst first."""
    return (_on_latest_day(mart)
            .select("team", "date_day", "health_score", "health_tier",
                    _pct("ci_failure_rate_7d_avg", 1).alias("ci_failure_pct"),
                    _pct("drift_failure_rate_7d_avg", 1).alias("drift_failure_pct"),
                    F.round("avg_mttr_hours", 1).alias("mttr_hours"))
            .orderBy(F.asc("health_score")))


def worst_first(mart: DataFrame) -> DataFrame:
    """The alert report's teams with their place: worst score first, no score before all, teams of one score by name."""
    return with_place(health_report(mart), [F.asc("health_score"), F.asc("team")]).select("place", "team", "health_score")


def health_trend_places(mart: DataFrame) -> DataFrame:
    """The trend's rows with their place by day and team."""
    return with_place(health_trend(mart), [F.asc(c) for c in _BY_DAY_TEAM])


def psi_places(ml_runs: DataFrame, as_of: str | dt.date, days: int = 30) -> DataFrame:
    """The PSI distribution with places, highest mean PSI first, equal ones by team, model and severity."""
    return with_place(psi_distribution(ml_runs, as_of, days),
                      [F.desc("avg_psi"), F.asc("team"), F.asc("model_name"), F.asc("psi_severity")])


def team_alerts(mart: DataFrame) -> DataFrame:
    """Every team of the latest day with tier and score, and whether it raises the alert."""
    return _on_latest_day(mart).select("team", "health_tier", "health_score",
                                       (F.col("health_tier") == "critical").alias("alert"))


def tier_counts(mart: DataFrame) -> DataFrame:
    """Number of teams per tier on the latest day, as one row (no collect)."""
    t = F.col("health_tier")
    return _on_latest_day(mart).agg(
        F.count_if(t == "critical").alias("critical_teams"),
        F.count_if(t == "warning").alias("warning_teams"),
        F.count_if(t == "healthy").alias("healthy_teams"),
        F.count(F.lit(1)).alias("teams"),
    )
