"""Facts at event grain and the team dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipgauge.config import DEFAULT, PipelineConfig
from shipgauge.functions.catalog import DEFAULT_CATALOG
from shipgauge.functions.scalar import response_tier, whole_hours
from shipgauge.operators.rollups import pr_lead_time_daily
from shipgauge.operators.segmented import pair_next, sequence_number


def dim_teams(stg_ml: DataFrame, catalog=DEFAULT_CATALOG) -> DataFrame:
    """Distinct (team, model_name) with the team's domain and SLA tier."""
    return catalog.attach(stg_ml.select("team", "model_name").distinct())


def team_dimension(stg_ml: DataFrame, catalog=DEFAULT_CATALOG) -> DataFrame:
    """The dimension at team grain, one row per team.

    The dimension's grain is (team, model); joining it on team alone would
    repeat every fact once per model. Domain and tier depend on the team
    only, so dropping the model keeps every value.
    """
    return catalog.attach(stg_ml.select("team").distinct())


def fct_deployments(stg: DataFrame, stg_ml: DataFrame, catalog=DEFAULT_CATALOG,
                    cfg: PipelineConfig = DEFAULT, dim: DataFrame | None = None) -> DataFrame:
    """One row per deployment: same-day mean PR lead time (0 when none),
    team domain and SLA tier, and its sequence number within (team, day),
    ordered by time and then event id. ``dim`` is a written team dimension to
    use; without one it is derived from the ML events."""
    deployments = stg.where(F.col("is_deployment")).select(
        "event_id", "team", "event_day", "event_timestamp")
    teams = (team_dimension(stg_ml, catalog) if dim is None else
             dim.groupBy("team").agg(F.min("domain").alias("domain"), F.min("sla_tier").alias("sla_tier")))
    # the same-day lead time and the team's domain ride on the numbering's
    # carry-in rows, so the deployments themselves are shuffled only once
    joined = sequence_number(
        deployments, ["team", "event_day"], ["event_timestamp", "event_id"], "deployment_seq_in_day",
        bucket=cfg.pairing.bucket,
        attach=[(pr_lead_time_daily(stg), ["team", "event_day"]), (teams, ["team"])])
    return joined.select(
        F.col("event_id").alias("deployment_id"),
        "team",
        F.col("event_day").alias("deployment_day"),
        F.col("event_timestamp").alias("deployed_at"),
        "domain",
        "sla_tier",
        F.coalesce(F.col("avg_lead_time_days"), F.lit(0.0)).alias("lead_time_days"),
        "deployment_seq_in_day",
    )


def fct_incidents(stg: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """One row per opened incident, paired with the team's first later close.

    ``mttr_hours`` is whole elapsed hours; an incident with no later close is
    still open (NULL close and MTTR).
    """
    paired = pair_next(stg, ["team"], "event_timestamp",
                       is_open=F.col("is_incident_opened"), is_close=F.col("is_incident_closed"),
                       keep=["event_id", "event_day"], out="closed_at", bucket=cfg.pairing.bucket)
    return paired.select(
        F.col("event_id").alias("incident_id"),
        "team",
        F.col("event_day").alias("opened_day"),
        F.col("event_timestamp").alias("opened_at"),
        "closed_at",
        whole_hours("event_timestamp", "closed_at").alias("mttr_hours"),
        F.col("closed_at").isNull().alias("is_still_open"),
    )


def fct_ml_runs(stg_ml: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """One row per training run with the first later deployment of the same
    (team, model) and the whole hours to it."""
    paired = pair_next(stg_ml, ["team", "model_name"], "event_timestamp",
                       is_open=F.col("is_training_run"), is_close=F.col("is_deployment"),
                       keep=["event_id", "event_day", "precision_at_10", "psi_score",
                             "psi_severity", "drift_triggered"],
                       out="deployed_at", bucket=cfg.pairing.bucket)
    return paired.select(
        F.col("event_id").alias("run_id"),
        "team",
        "model_name",
        F.col("event_day").alias("run_day"),
        F.col("event_timestamp").alias("trained_at"),
        "deployed_at",
        "precision_at_10",
        "psi_score",
        "psi_severity",
        "drift_triggered",
        whole_hours("event_timestamp", "deployed_at").alias("time_to_deploy_hours"),
        F.col("deployed_at").isNotNull().alias("was_deployed"),
    )


def retrain_response(stg_ml: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """One row per drift detection (per team, model and instant) with the
    first later retrain, whole response hours and response tier."""
    paired = pair_next(stg_ml, ["team", "model_name"], "event_timestamp",
                       is_open=F.col("is_drift_detected"), is_close=F.col("is_retrain_triggered"),
                       keep=["event_day"], out="retrain_at", bucket=cfg.pairing.bucket,
                       distinct_opens=True)
    hours = whole_hours("event_timestamp", "retrain_at")
    return paired.select(
        F.col("event_day").alias("date_day"),
        "team",
        "model_name",
        F.col("event_timestamp").alias("drift_at"),
        "retrain_at",
        hours.alias("response_hours"),
        F.col("retrain_at").isNull().alias("no_response_yet"),
        response_tier(hours, "retrain_at", cfg.fast_response_max_hours,
                      cfg.medium_response_max_hours).alias("response_tier"),
    )
