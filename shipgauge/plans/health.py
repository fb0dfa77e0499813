"""The daily health mart: join stage, dimension scores, composite and tier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipgauge.config import DEFAULT, PipelineConfig
from shipgauge.functions.scalar import safe_clamp, step_at_least, step_at_most, tier, weighted_sum
from shipgauge.operators.rollups import (
    dora_daily,
    incidents_daily,
    ml_delivery_daily,
    ml_team_daily,
    retrain_response_daily,
    with_dora_rolling,
    with_ml_rolling,
)
from shipgauge.plans.facts import fct_incidents, retrain_response
from shipgauge.schemas import HEALTH_COLUMNS

_KEYS = ["date_day", "team"]


def platform_health_joined(dora: DataFrame, ml_team: DataFrame, incidents: DataFrame,
                           responses: DataFrame) -> DataFrame:
    """Team-day rows of the delivery rollup (which drives: an ML-only day has
    no row) with ML, incident and retrain figures; missing figures become 0.

    Every side is already reduced to one row per (date_day, team), so the
    three left joins meet on the same keys and partitioning.
    """
    z = lambda c, v=0: F.coalesce(F.col(c), F.lit(v))
    j = (dora.join(ml_team, _KEYS, "left")
         .join(incidents, _KEYS, "left")
         .join(responses, _KEYS, "left"))
    return j.select(
        "date_day", "team",
        "deployment_count", "deployments_last_7d",
        "avg_lead_time_days", "p50_lead_time_days", "p95_lead_time_days",
        "ci_run_count", "ci_failure_count", "ci_failure_rate", "ci_failure_rate_7d_avg",
        "incidents_opened", "incidents_closed",
        z("avg_precision_at_10", 0.0).alias("avg_precision_at_10"),
        z("avg_drift_failure_rate", 0.0).alias("drift_failure_rate"),
        z("drift_failure_rate_7d_avg", 0.0).alias("drift_failure_rate_7d_avg"),
        z("total_training_runs").alias("training_run_count"),
        z("total_model_deployments").alias("model_deployment_count"),
        z("total_drift_events").alias("drift_detected_count"),
        z("incident_count").alias("incident_count"),
        z("avg_mttr_hours", 0.0).alias("avg_mttr_hours"),
        z("high_mttr_count").alias("high_mttr_count"),
        z("avg_retrain_response_hours", 0.0).alias("avg_retrain_response_hours"),
        z("fast_retrain_response_count").alias("fast_retrain_response_count"),
        z("slow_retrain_response_count").alias("slow_retrain_response_count"),
    )


def health_scores(joined: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """The five dimension scores, each 0..100.

    Deploy: step on the 7-row deployment sum. CI and drift: (1 - rate) * 100
    clamped, NULL when the rate is NULL. Lead time: step, NULL counts as the
    worst step. MTTR: step, 0 counts as the best.
    """
    s = cfg.score
    return joined.select(
        "*",
        step_at_least("deployments_last_7d", s.deploy_steps, s.deploy_floor).alias("score_deploy_freq"),
        safe_clamp((F.lit(1) - F.col("ci_failure_rate_7d_avg")) * F.lit(100)).alias("score_ci_quality"),
        safe_clamp((F.lit(1) - F.col("drift_failure_rate_7d_avg")) * F.lit(100)).alias("score_drift"),
        step_at_most("avg_lead_time_days", s.lead_time_steps, s.lead_time_floor).alias("score_lead_time"),
        step_at_most("avg_mttr_hours", s.mttr_steps, s.mttr_floor, zero_score=100.0).alias("score_mttr"),
    )


def with_composite(scored: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """``health_score`` (weighted sum rounded to 1 decimal) and ``health_tier``
    (from the unrounded sum, so 89.96 shows as 90.0 yet stays ``warning``)."""
    s = cfg.score
    raw = weighted_sum(["score_deploy_freq", "score_ci_quality", "score_drift",
                        "score_lead_time", "score_mttr"], s.weights)
    with_raw = scored.withColumn("_raw_score", raw)
    out = with_raw.select(
        "*",
        F.round(F.col("_raw_score"), 1).alias("health_score"),
        tier("_raw_score", s.healthy_from, s.warning_from).alias("health_tier"),
    )
    return out.select(*HEALTH_COLUMNS)


def build_health_inputs(stg: DataFrame, stg_ml: DataFrame, cfg: PipelineConfig = DEFAULT):
    """The four team-day inputs of the mart."""
    dora = with_dora_rolling(dora_daily(stg, cfg), cfg)
    ml_team = ml_team_daily(with_ml_rolling(ml_delivery_daily(stg_ml), cfg))
    inc = incidents_daily(fct_incidents(stg, cfg), cfg)
    rr = retrain_response_daily(retrain_response(stg_ml, cfg))
    return dora, ml_team, inc, rr


def platform_health_daily(stg: DataFrame, stg_ml: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """The contract-ordered daily health mart, one row per (date_day, team)."""
    joined = platform_health_joined(*build_health_inputs(stg, stg_ml, cfg))
    return with_composite(health_scores(joined, cfg), cfg)
