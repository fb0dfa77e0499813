"""Schemas of the raw event tables and the contract of the health mart."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw software-delivery events. ``nullable=False`` marks REQUIRED columns.
DELIVERY_EVENTS = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("team", T.StringType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("event_date", T.TimestampType(), False),
    T.StructField("lead_time_days", T.DoubleType(), True),
    T.StructField("ci_passed", T.BooleanType(), True),
])

# Raw ML lifecycle events.
ML_EVENTS = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("team", T.StringType(), False),
    T.StructField("model_name", T.StringType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("event_date", T.TimestampType(), False),
    T.StructField("psi_score", T.DoubleType(), True),
    T.StructField("precision_at_10", T.DoubleType(), True),
    T.StructField("drift_triggered", T.BooleanType(), True),
])

_L, _D, _S = T.LongType(), T.DoubleType(), T.StringType()

# The enforced contract of the daily health mart, in contract order.
# (name, type, not_null)
HEALTH_CONTRACT = (
    ("date_day", T.DateType(), True),
    ("team", _S, True),
    ("health_score", _D, True),
    ("health_tier", _S, True),
    ("deployment_count", _L, True),
    ("deployments_last_7d", _L, True),
    ("avg_lead_time_days", _D, False),
    ("p50_lead_time_days", _D, False),
    ("p95_lead_time_days", _D, False),
    ("ci_run_count", _L, True),
    ("ci_failure_count", _L, True),
    ("ci_failure_rate", _D, False),
    ("ci_failure_rate_7d_avg", _D, False),
    ("incidents_opened", _L, True),
    ("incidents_closed", _L, True),
    ("incident_count", _L, True),
    ("avg_mttr_hours", _D, True),
    ("high_mttr_count", _L, True),
    ("avg_precision_at_10", _D, True),
    ("drift_failure_rate", _D, True),
    ("drift_failure_rate_7d_avg", _D, True),
    ("training_run_count", _L, True),
    ("model_deployment_count", _L, True),
    ("drift_detected_count", _L, True),
    ("avg_retrain_response_hours", _D, True),
    ("fast_retrain_response_count", _L, True),
    ("slow_retrain_response_count", _L, True),
    ("score_deploy_freq", _D, True),
    ("score_ci_quality", _D, True),
    ("score_drift", _D, True),
    ("score_lead_time", _D, True),
    ("score_mttr", _D, True),
)

HEALTH_COLUMNS = tuple(name for name, _, _ in HEALTH_CONTRACT)

TIMESTAMP_TYPES = (T.TimestampType, T.TimestampNTZType)


def same_type(actual: T.DataType, expected: T.DataType) -> bool:
    """Type equality that treats timestamp and timestamp_ntz as one family."""
    if isinstance(expected, TIMESTAMP_TYPES):
        return isinstance(actual, TIMESTAMP_TYPES)
    return actual == expected
