"""Thresholds, weights, domains and the team catalog.

Everything a caller may want to tune is a field of a frozen dataclass; the
defaults reproduce the behaviour of the pipeline this library re-implements.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. These must equal the original pipeline's for equal results.
# ---------------------------------------------------------------------------

# Delivery event types, in declared order.
DELIVERY_EVENT_TYPES = ("ci_run", "pr_merged", "deployment", "incident_opened", "incident_closed")

# ML lifecycle event types, in declared order.
ML_EVENT_TYPES = ("training_run", "model_deployed", "drift_detected", "retrain_triggered")

# Accepted teams and model names of the original data set.
TEAMS = ("team-reco", "team-pricing", "team-churn", "team-search")
MODEL_NAMES = ("als_reco", "price_elasticity", "churn_pred", "search_rank")

# Team catalog: team -> (domain, sla_tier).
TEAM_CATALOG = {
    "team-reco": ("Personalisation", "tier-1"),
    "team-pricing": ("Commercial", "tier-1"),
    "team-churn": ("CRM", "tier-2"),
    "team-search": ("Discovery", "tier-1"),
}

# Domains of categorical outputs.
PSI_SEVERITIES = ("stable", "warning", "critical")
RESPONSE_TIERS = ("no_response", "fast", "medium", "slow")
HEALTH_TIERS = ("healthy", "warning", "critical")
SLA_TIERS = ("tier-1", "tier-2")

# PSI buckets: stable < 0.10 <= warning <= 0.20 < critical; drift flag when PSI > 0.20.
PSI_WARNING_FROM = 0.10
PSI_CRITICAL_ABOVE = 0.20
DRIFT_PSI_ABOVE = 0.20

# Retrain response tiers on whole hours: <= 24 fast, <= 72 medium, otherwise slow.
FAST_RESPONSE_MAX_HOURS = 24
MEDIUM_RESPONSE_MAX_HOURS = 72

# An incident counts as "high MTTR" when its whole-hour MTTR is above 24.
HIGH_MTTR_ABOVE_HOURS = 24

# Rolling windows, in rows (days with activity), not calendar days.
SHORT_WINDOW_ROWS = 7
LONG_WINDOW_ROWS = 30

# Health score. Step scores are (threshold, score) pairs checked in order.
DEPLOY_STEPS = ((7, 100.0), (3, 75.0), (1, 50.0))  # deployments_last_7d >= threshold
DEPLOY_FLOOR = 25.0
LEAD_TIME_STEPS = ((1, 100.0), (3, 75.0), (7, 50.0))  # avg_lead_time_days <= threshold
LEAD_TIME_FLOOR = 25.0
MTTR_STEPS = ((1, 100.0), (4, 75.0), (24, 50.0))  # avg_mttr_hours <= threshold (0 also 100)
MTTR_FLOOR = 25.0
# Weights of deploy, CI quality, drift, lead time and MTTR, in the order they are summed.
SCORE_WEIGHTS = (0.25, 0.20, 0.20, 0.20, 0.15)
HEALTHY_FROM = 90
WARNING_FROM = 70

# Source freshness on event_date: warn after 24 h, error after 48 h.
FRESHNESS_WARN_HOURS = 24
FRESHNESS_ERROR_HOURS = 48

# Metric time spine, end exclusive.
SPINE_START = "2020-01-01"
SPINE_END = "2030-01-01"

# Output naming: the production target writes to clean names, others are prefixed.
PROD_TARGET = "prod"

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class ScoreConfig:
    deploy_steps: tuple = DEPLOY_STEPS
    deploy_floor: float = DEPLOY_FLOOR
    lead_time_steps: tuple = LEAD_TIME_STEPS
    lead_time_floor: float = LEAD_TIME_FLOOR
    mttr_steps: tuple = MTTR_STEPS
    mttr_floor: float = MTTR_FLOOR
    weights: tuple = SCORE_WEIGHTS
    healthy_from: float = HEALTHY_FROM
    warning_from: float = WARNING_FROM


@dataclass(frozen=True)
class PairingConfig:
    """How next-event pairing and numbering split their work.

    ``bucket`` names ``timestamp_diff`` units, coarse to fine (one unit may
    stand alone). The largest window partition then holds one key's instants of
    one of the finest buckets, or as many rows as a bucket has children, however
    skewed the keys are and wherever their events fall. ``None`` scans each key
    in a single window, which is faster when no key is hot.
    """

    bucket: str | tuple[str, ...] | None = ("hour", "second")


@dataclass(frozen=True)
class PipelineConfig:
    psi_warning_from: float = PSI_WARNING_FROM
    psi_critical_above: float = PSI_CRITICAL_ABOVE
    drift_psi_above: float = DRIFT_PSI_ABOVE
    fast_response_max_hours: int = FAST_RESPONSE_MAX_HOURS
    medium_response_max_hours: int = MEDIUM_RESPONSE_MAX_HOURS
    high_mttr_above_hours: int = HIGH_MTTR_ABOVE_HOURS
    short_window_rows: int = SHORT_WINDOW_ROWS
    long_window_rows: int = LONG_WINDOW_ROWS
    # a (day, team) with more merged PRs than this finds its quantiles by way of a sketch; changes no result
    quantile_large_group: float = 50_000
    score: ScoreConfig = field(default_factory=ScoreConfig)
    pairing: PairingConfig = field(default_factory=PairingConfig)


DEFAULT = PipelineConfig()
