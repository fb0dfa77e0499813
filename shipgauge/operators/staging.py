"""Staging: rename, derive the event day and type flags. No row is dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipgauge.config import DEFAULT, PipelineConfig
from shipgauge.functions.scalar import event_day, psi_severity


def stage_delivery_events(raw: DataFrame) -> DataFrame:
    """Delivery events with ``event_day``, five type flags and ``is_ci_failure``.

    ``is_ci_failure`` is true only for a CI run whose ``ci_passed`` is false;
    a CI run with unknown outcome is not a failure.
    """
    et = F.col("event_type")
    return raw.select(
        "event_id",
        "team",
        "event_type",
        event_day("event_date").alias("event_day"),
        F.col("event_date").alias("event_timestamp"),
        "lead_time_days",
        "ci_passed",
        (et == "ci_run").alias("is_ci_run"),
        (et == "pr_merged").alias("is_pr_merged"),
        (et == "deployment").alias("is_deployment"),
        (et == "incident_opened").alias("is_incident_opened"),
        (et == "incident_closed").alias("is_incident_closed"),
        F.when((et == "ci_run") & (F.col("ci_passed") == F.lit(False)), F.lit(True))
         .otherwise(F.lit(False)).alias("is_ci_failure"),
    )


def stage_ml_events(raw: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """ML events with ``event_day``, type flags, PSI severity and a normalised drift flag.

    A missing ``drift_triggered`` is derived from PSI; the stored flag wins
    when present, and both missing stays NULL.
    """
    et = F.col("event_type")
    psi = F.col("psi_score")
    return raw.select(
        "event_id",
        "team",
        "model_name",
        "event_type",
        event_day("event_date").alias("event_day"),
        F.col("event_date").alias("event_timestamp"),
        "psi_score",
        "precision_at_10",
        F.coalesce(F.col("drift_triggered"), psi > F.lit(cfg.drift_psi_above)).alias("drift_triggered"),
        psi_severity(psi, cfg.psi_warning_from, cfg.psi_critical_above).alias("psi_severity"),
        (et == "training_run").alias("is_training_run"),
        (et == "model_deployed").alias("is_deployment"),
        (et == "drift_detected").alias("is_drift_detected"),
        (et == "retrain_triggered").alias("is_retrain_triggered"),
    )


def event_breakdown(raw: DataFrame) -> DataFrame:
    """Row count per event type (map-side partial count, then one small shuffle)."""
    return raw.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"))


def psi_severity_counts(staged_ml: DataFrame) -> DataFrame:
    """Number of ML events per PSI severity bucket (NULL bucket included)."""
    return staged_ml.groupBy("psi_severity").agg(F.count(F.lit(1)).alias("event_count"))
