"""Daily rollups at (day, team) and (day, team, model) grain.

Each rollup is one ``groupBy().agg()``: Spark aggregates partially inside
every scan task and shuffles only one partial row per key and task, so a
team that owns a third of all events costs no more shuffle than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipgauge.config import DEFAULT, PipelineConfig
from shipgauge.functions.scalar import safe_ratio
from shipgauge.operators.quantiles import exact_quantiles
from shipgauge.operators.rolling import Rolling, add_rolling


QUANTILES = {"p50_lead_time_days": 0.5, "p95_lead_time_days": 0.95}


_PR_LEAD = "_pr_lead_time"


def dora_inputs(stg: DataFrame) -> DataFrame:
    """The columns the delivery rollup reads, with ``date_day``."""
    return stg.select(
        F.col("event_day").alias("date_day"), "team",
        "event_timestamp",
        "is_deployment", "is_ci_run", "is_ci_failure", "is_incident_opened", "is_incident_closed",
        F.when(F.col("is_pr_merged"), F.col("lead_time_days")).alias(_PR_LEAD),
    )


def dora_aggregates(quantiles: bool = True) -> list[Column]:
    """Aggregates of the delivery rollup over :func:`dora_inputs` rows, in
    output order; ``quantiles=False`` leaves out p50 / p95, which otherwise
    keep a group's distinct lead times in one buffer (the streaming form)."""
    q = [F.expr(f"percentile_disc({p!r}) WITHIN GROUP (ORDER BY `{_PR_LEAD}`)").alias(name)
         for name, p in QUANTILES.items()] if quantiles else []
    return [
        F.count_if("is_deployment").alias("deployment_count"),
        F.avg(_PR_LEAD).alias("avg_lead_time_days"),
        *q,
        F.count_if("is_ci_run").alias("ci_run_count"),
        F.count_if("is_ci_failure").alias("ci_failure_count"),
        safe_ratio(F.count_if("is_ci_failure"), F.count_if("is_ci_run")).alias("ci_failure_rate"),
        F.count_if("is_incident_opened").alias("incidents_opened"),
        F.count_if("is_incident_closed").alias("incidents_closed"),
    ]


def dora_daily(stg: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Delivery metrics per (date_day, team): deployments, lead time mean /
    p50 / p95 over merged PRs, CI runs, failures and failure rate, incidents
    opened and closed.

    Counts and means are a plain hash aggregate over all rows, the quantiles
    are exact and split (:func:`lead_time_quantiles`). They join on a struct of
    day and team, which is unique on their side and never NULL: a NULL team or
    day keeps its quantiles, and whoever reads neither p50 nor p95 pays for
    neither, as the optimiser then drops the join.
    """
    counts = dora_inputs(stg).groupBy("date_day", "team").agg(*dora_aggregates(quantiles=False))
    quantiles = (lead_time_quantiles(stg, cfg).groupBy(F.struct("date_day", "team").alias("_day_team"))
                 .agg(*[F.first(name).alias(name) for name in QUANTILES]))
    merged = counts.withColumn("_day_team", F.struct("date_day", "team")).join(quantiles, "_day_team", "left")
    return merged.select("date_day", "team", "deployment_count", "avg_lead_time_days",
                         "p50_lead_time_days", "p95_lead_time_days", "ci_run_count", "ci_failure_count",
                         "ci_failure_rate", "incidents_opened", "incidents_closed")


def lead_time_quantiles(stg: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """p50 / p95 of merged-PR lead time per (date_day, team), days with PRs only:
    the observed value at rank ``ceil(p * n)``, exact for a group of any size.
    ``pr_count`` counts all merged PRs, those without a lead time too; a day
    without any lead time has a row with NULL quantiles."""
    prs = stg.where(F.col("is_pr_merged")).select(F.col("event_day").alias("date_day"), "team", "lead_time_days")
    return exact_quantiles(prs, ["date_day", "team"], "lead_time_days", QUANTILES, cfg.quantile_large_group, rows="pr_count")


def with_dora_rolling(daily: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Adds ``deployments_last_7d`` (sum) and ``ci_failure_rate_7d_avg`` (mean,
    NULL days skipped) over the team's last 7 daily rows."""
    n = cfg.short_window_rows
    return add_rolling(daily, ["team"], "date_day", [
        Rolling("deployments_last_7d", "sum", "deployment_count", n),
        Rolling("ci_failure_rate_7d_avg", "avg", "ci_failure_rate", n),
    ])


def ml_inputs(stg_ml: DataFrame) -> DataFrame:
    """The columns the ML rollup reads, with ``date_day``."""
    training = F.col("is_training_run")
    return stg_ml.select(
        F.col("event_day").alias("date_day"), "team", "model_name", "event_timestamp",
        "is_training_run", "is_deployment", "is_drift_detected", "is_retrain_triggered",
        F.when(training, F.col("precision_at_10")).alias("_train_precision"),
        F.when(training, F.col("psi_score")).alias("_train_psi"),
        (training & F.col("drift_triggered")).alias("_train_drift"),
    )


def ml_aggregates() -> list[Column]:
    """Aggregates of the ML rollup over :func:`ml_inputs` rows, in output order."""
    return [
        F.count_if("is_training_run").alias("training_run_count"),
        F.avg("_train_precision").alias("avg_precision_at_10"),
        F.avg("_train_psi").alias("avg_psi_score"),
        F.count_if("_train_drift").alias("drift_training_count"),
        safe_ratio(F.count_if("_train_drift"), F.count_if("is_training_run")).alias("drift_failure_rate"),
        F.count_if("is_deployment").alias("model_deployment_count"),
        F.count_if("is_drift_detected").alias("drift_detected_count"),
        F.count_if("is_retrain_triggered").alias("retrain_triggered_count"),
    ]


def ml_delivery_daily(stg_ml: DataFrame) -> DataFrame:
    """ML metrics per (date_day, team, model_name)."""
    return ml_inputs(stg_ml).groupBy("date_day", "team", "model_name").agg(*ml_aggregates())


def with_ml_rolling(daily: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """30-row precision baseline, 7-row drift-rate mean and 30-row training-run
    sum per (team, model_name)."""
    short, long_ = cfg.short_window_rows, cfg.long_window_rows
    return add_rolling(daily, ["team", "model_name"], "date_day", [
        Rolling("precision_30d_baseline", "avg", "avg_precision_at_10", long_),
        Rolling("drift_failure_rate_7d_avg", "avg", "drift_failure_rate", short),
        Rolling("training_runs_last_30d", "sum", "training_run_count", long_),
    ])


def ml_team_daily(ml_rolling: DataFrame) -> DataFrame:
    """Models re-aggregated to (date_day, team): unweighted means of the model
    means and rates, sums of the counts."""
    return ml_rolling.groupBy("date_day", "team").agg(
        F.avg("avg_precision_at_10").alias("avg_precision_at_10"),
        F.avg("drift_failure_rate").alias("avg_drift_failure_rate"),
        F.avg("drift_failure_rate_7d_avg").alias("drift_failure_rate_7d_avg"),
        F.sum("training_run_count").alias("total_training_runs"),
        F.sum("model_deployment_count").alias("total_model_deployments"),
        F.sum("drift_detected_count").alias("total_drift_events"),
    )


def incidents_daily(incidents: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Closed incidents per (opened day, team): count, mean MTTR, count above
    the high-MTTR threshold. Open incidents are left out, not counted as long."""
    closed = incidents.where(~F.col("is_still_open"))
    return closed.groupBy(F.col("opened_day").alias("date_day"), "team").agg(
        F.count(F.lit(1)).alias("incident_count"),
        F.avg("mttr_hours").alias("avg_mttr_hours"),
        F.count_if(F.col("mttr_hours") > F.lit(cfg.high_mttr_above_hours)).alias("high_mttr_count"),
    )


def retrain_response_daily(responses: DataFrame) -> DataFrame:
    """Answered drift events per (drift day, team): mean response hours
    rounded to one decimal, number of fast and of slow responses."""
    answered = responses.where(~F.col("no_response_yet"))
    return answered.groupBy("date_day", "team").agg(
        F.round(F.avg("response_hours"), 1).alias("avg_retrain_response_hours"),
        F.count_if(F.col("response_tier") == F.lit("fast")).alias("fast_retrain_response_count"),
        F.count_if(F.col("response_tier") == F.lit("slow")).alias("slow_retrain_response_count"),
    )


def pr_lead_time_daily(stg: DataFrame) -> DataFrame:
    """Mean merged-PR lead time per (team, event_day)."""
    return (stg.where(F.col("is_pr_merged"))
            .groupBy("team", "event_day")
            .agg(F.avg("lead_time_days").alias("avg_lead_time_days")))
