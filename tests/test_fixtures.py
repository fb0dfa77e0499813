"""Hand-computed cases: every semantic trap with its expected rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import as_dicts, at, delivery, empty_ml, ml
from shipgauge.operators import quality, rollups
from shipgauge.operators.rolling import Rolling, add_calendar_rolling
from shipgauge.operators.staging import stage_delivery_events, stage_ml_events
from shipgauge.plans import facts, semantic
from shipgauge.plans.health import health_scores, platform_health_daily, with_composite


def _dep(i, team, ts, et="deployment", lead=None, ci=None):
    return (f"e{i:03d}", team, et, ts, lead, ci)


def test_t1_rolling_is_rows_not_calendar_days(spark):
    ev = [_dep(i, "t", at(day=i)) for i in range(7)] + [_dep(99, "t", at(day=19))]
    daily = rollups.dora_daily(stage_delivery_events(delivery(spark, ev)))
    rows = {r["date_day"]: r for r in as_dicts(rollups.with_dora_rolling(daily))}
    last = rows[at(day=19).date()]
    assert last["deployments_last_7d"] == 7
    cal = add_calendar_rolling(daily, ["team"], "date_day",
                               [Rolling("deployments_last_7d", "sum", "deployment_count", 7)])
    cal_rows = {r["date_day"]: r for r in as_dicts(cal)}
    assert cal_rows[at(day=19).date()]["deployments_last_7d"] == 1


def test_t2_no_ci_run_gives_null_score_and_critical(spark):
    ev = [_dep(1, "t", at(hour=1))]
    mart = platform_health_daily(stage_delivery_events(delivery(spark, ev)), stage_ml_events(empty_ml(spark)))
    (r,) = as_dicts(mart)
    assert r["ci_failure_rate_7d_avg"] is None
    assert r["score_ci_quality"] is None
    assert r["health_score"] is None
    assert r["health_tier"] == "critical"


def test_t3_whole_hours_truncate_elapsed_time(spark):
    ev = [("o", "t", "incident_opened", at(hour=0, minute=59, second=59), None, None),
          ("c", "t", "incident_closed", at(hour=1), None, None)]
    (r,) = as_dicts(facts.fct_incidents(stage_delivery_events(delivery(spark, ev))))
    assert r["mttr_hours"] == 0 and r["is_still_open"] is False


@pytest.mark.parametrize("bucket", [None, "hour", "day"])
def test_t4_response_tiers(spark, bucket):
    from shipgauge.config import PairingConfig, PipelineConfig

    gaps = {"m1": dt.timedelta(hours=24, minutes=59), "m2": dt.timedelta(hours=25),
            "m3": dt.timedelta(hours=72, minutes=59), "m4": dt.timedelta(hours=73), "m5": None}
    rows = []
    for i, (model, gap) in enumerate(gaps.items()):
        rows.append((f"d{i}", "t", model, "drift_detected", at(hour=3), 0.3, None, True))
        if gap is not None:
            rows.append((f"r{i}", "t", model, "retrain_triggered", at(hour=3) + gap, None, None, None))
    cfg = PipelineConfig(pairing=PairingConfig(bucket=bucket))
    out = {r["model_name"]: r for r in as_dicts(facts.retrain_response(stage_ml_events(ml(spark, rows)), cfg))}
    assert {m: r["response_tier"] for m, r in out.items()} == {
        "m1": "fast", "m2": "medium", "m3": "medium", "m4": "slow", "m5": "no_response"}
    assert out["m1"]["response_hours"] == 24 and out["m5"]["no_response_yet"] is True


def _incidents(spark, opens, closes, bucket="hour"):
    from shipgauge.config import PairingConfig, PipelineConfig

    ev = [(f"o{i}", "t", "incident_opened", ts, None, None) for i, ts in enumerate(opens)]
    ev += [(f"c{i}", "t", "incident_closed", ts, None, None) for i, ts in enumerate(closes)]
    cfg = PipelineConfig(pairing=PairingConfig(bucket=bucket))
    return {r["opened_at"]: r["closed_at"]
            for r in as_dicts(facts.fct_incidents(stage_delivery_events(delivery(spark, ev)), cfg))}


@pytest.mark.parametrize("bucket", [None, "hour", "minute"])
def test_t10_strictly_later_close(spark, bucket):
    got = _incidents(spark, [at(hour=10), at(hour=11), at(hour=13)],
                     [at(hour=11), at(hour=12, minute=30)], bucket)
    assert got == {at(hour=10): at(hour=11), at(hour=11): at(hour=12, minute=30), at(hour=13): None}


@pytest.mark.parametrize("bucket", [None, "hour"])
def test_t10_opens_share_a_close(spark, bucket):
    got = _incidents(spark, [at(hour=10), at(hour=10, minute=30)], [at(hour=11)], bucket)
    assert got == {at(hour=10): at(hour=11), at(hour=10, minute=30): at(hour=11)}


def test_t5_two_models_one_deployment_one_row(spark):
    ev = [_dep(1, "team-reco", at(hour=2))]
    mlev = [("a", "team-reco", "m1", "training_run", at(hour=1), 0.1, 0.8, None),
            ("b", "team-reco", "m2", "training_run", at(hour=1), 0.1, 0.8, None)]
    out = as_dicts(facts.fct_deployments(stage_delivery_events(delivery(spark, ev)),
                                         stage_ml_events(ml(spark, mlev))))
    assert len(out) == 1
    assert out[0]["domain"] == "Personalisation" and out[0]["sla_tier"] == "tier-1"
    assert out[0]["lead_time_days"] == 0.0


def test_psi_severity_edges(spark):
    psis = [0.0999, 0.10, 0.20, 0.2001, None]
    rows = [(f"e{i}", "t", "m", "training_run", at(), p, None, None) for i, p in enumerate(psis)]
    got = {r["event_id"]: r["psi_severity"] for r in as_dicts(stage_ml_events(ml(spark, rows)))}
    assert [got[f"e{i}"] for i in range(5)] == ["stable", "warning", "warning", "critical", None]


def test_drift_flag_normalisation(spark):
    cases = [(None, 0.21), (False, 0.5), (None, None)]
    rows = [(f"e{i}", "t", "m", "training_run", at(), p, None, f) for i, (f, p) in enumerate(cases)]
    got = {r["event_id"]: r["drift_triggered"] for r in as_dicts(stage_ml_events(ml(spark, rows)))}
    assert [got["e0"], got["e1"], got["e2"]] == [True, False, None]


def test_ci_rates_and_unknown_outcome(spark):
    ev = [_dep(1, "a", at(), "ci_run", ci=False), _dep(2, "a", at(), "ci_run", ci=True),
          _dep(3, "a", at(), "ci_run", ci=True), _dep(4, "a", at(), "ci_run", ci=None),
          _dep(5, "b", at(), "deployment")]
    got = {r["team"]: r for r in as_dicts(rollups.dora_daily(stage_delivery_events(delivery(spark, ev))))}
    assert got["a"]["ci_run_count"] == 4 and got["a"]["ci_failure_count"] == 1
    assert got["a"]["ci_failure_rate"] == 0.25
    assert got["b"]["ci_failure_rate"] is None


@pytest.mark.parametrize("large", [0, 1000])
def test_t9_quantiles(spark, large):
    from shipgauge.config import PipelineConfig

    ev = [_dep(i, "a", at(), "pr_merged", lead=float(v)) for i, v in enumerate([1, 2, 3, 4])]
    ev += [_dep(9, "b", at(), "pr_merged", lead=None)]
    stg = stage_delivery_events(delivery(spark, ev))
    got = {r["team"]: r for r in as_dicts(rollups.dora_daily(stg, PipelineConfig(quantile_large_group=large)))}
    assert (got["a"]["p50_lead_time_days"], got["a"]["p95_lead_time_days"]) == (2.0, 4.0)
    assert (got["b"]["p50_lead_time_days"], got["b"]["p95_lead_time_days"]) == (None, None)


@pytest.mark.parametrize("d7,ci,drift,lead,mttr,score,tier", [
    (7, 0.07, 0.0, 0.8, 0.0, 98.6, "healthy"),
    (3, 0.40, 0.25, None, 71.0, 54.5, "critical"),
    (7, 0.314, 0.0, 1.0, 4.0, 90.0, "warning"),
    (0, 1.0, 1.0, None, 100.0, 15.0, "critical"),
])
def test_composite_score(spark, d7, ci, drift, lead, mttr, score, tier):
    df = spark.createDataFrame(
        [(d7, ci, drift, lead, mttr)],
        "deployments_last_7d bigint, ci_failure_rate_7d_avg double, drift_failure_rate_7d_avg double, "
        "avg_lead_time_days double, avg_mttr_hours double")
    scored = health_scores(df)
    from shipgauge.functions.scalar import tier as tier_of, weighted_sum
    from shipgauge.config import SCORE_WEIGHTS

    raw = weighted_sum(["score_deploy_freq", "score_ci_quality", "score_drift", "score_lead_time",
                        "score_mttr"], SCORE_WEIGHTS)
    (r,) = scored.select(F.round(raw, 1).alias("s"), tier_of(raw, 90, 70).alias("t")).collect()
    assert r["s"] == score and r["t"] == tier


def test_t11_open_incident_excluded_from_mean(spark):
    ev = [("o1", "t", "incident_opened", at(hour=1), None, None),
          ("c1", "t", "incident_closed", at(hour=11), None, None),
          ("o2", "t", "incident_opened", at(hour=12), None, None)]
    stg = stage_delivery_events(delivery(spark, ev))
    (daily,) = as_dicts(rollups.incidents_daily(facts.fct_incidents(stg)))
    assert daily["incident_count"] == 1 and daily["avg_mttr_hours"] == 10.0
    (mart,) = as_dicts(platform_health_daily(stg, stage_ml_events(empty_ml(spark))))
    assert mart["incidents_opened"] == 2 and mart["incident_count"] == 1


def test_t12_ml_only_day_has_no_mart_row(spark):
    ev = [_dep(1, "t", at(day=0))]
    mlev = [("a", "t", "m", "training_run", at(day=1), 0.1, 0.8, False)]
    mart = as_dicts(platform_health_daily(stage_delivery_events(delivery(spark, ev)),
                                          stage_ml_events(ml(spark, mlev))))
    assert [r["date_day"] for r in mart] == [at(day=0).date()]


def test_t14_team_rate_is_mean_of_model_rates(spark):
    mlev = [("x0", "t", "m1", "training_run", at(), 0.5, 0.8, True)]
    mlev += [(f"y{i}", "t", "m2", "training_run", at(), 0.01, 0.8, False) for i in range(9)]
    ml_roll = rollups.with_ml_rolling(rollups.ml_delivery_daily(stage_ml_events(ml(spark, mlev))))
    (r,) = as_dicts(rollups.ml_team_daily(ml_roll))
    assert r["avg_drift_failure_rate"] == 0.5 and r["total_training_runs"] == 10


def test_accepted_values_and_unique_null_rules(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",), ("a",), ("b",)], "v string")
    assert quality.accepted_values(df, "v", ["a", "b"]).count() == 0
    dups = as_dicts(quality.unique(df, "v"))
    assert dups == [{"v": "a", "n_records": 2}]


@pytest.mark.parametrize("hours,status", [(12, "ok"), (36, "warn"), (60, "error"), (24, "ok"), (48, "warn")])
def test_freshness(spark, hours, status):
    ev = delivery(spark, [_dep(1, "t", at(hour=5))])
    (r,) = as_dicts(quality.freshness(ev, "event_date", at(hour=5) + dt.timedelta(hours=hours)))
    assert r["status"] == status and r["age_hours"] == hours


def test_time_spine(spark):
    spine = semantic.time_spine(spark)
    r = spine.agg(F.count(F.lit(1)).alias("n"), F.min("date_day").alias("lo"),
                  F.max("date_day").alias("hi")).first()
    assert (r["n"], r["lo"], r["hi"]) == (3653, dt.date(2020, 1, 1), dt.date(2029, 12, 31))


@pytest.mark.parametrize("bucket", [None, "hour"])
def test_t15_sequence_ties_broken_by_event_id(spark, bucket):
    from shipgauge.config import PairingConfig, PipelineConfig

    ev = [_dep(2, "t", at(hour=4)), _dep(1, "t", at(hour=4)), _dep(3, "t", at(hour=2)),
          _dep(4, "t", at(day=1))]
    cfg = PipelineConfig(pairing=PairingConfig(bucket=bucket))
    stg = stage_delivery_events(delivery(spark, ev))
    got = {r["deployment_id"]: r["deployment_seq_in_day"]
           for r in as_dicts(facts.fct_deployments(stg, stage_ml_events(empty_ml(spark)), cfg=cfg))}
    assert got == {"e003": 1, "e001": 2, "e002": 3, "e004": 1}


def test_duplicate_drift_instants_collapse(spark):
    rows = [("d1", "t", "m", "drift_detected", at(hour=1), 0.3, None, True),
            ("d2", "t", "m", "drift_detected", at(hour=1), 0.3, None, True),
            ("r1", "t", "m", "retrain_triggered", at(hour=2), None, None, None)]
    out = as_dicts(facts.retrain_response(stage_ml_events(ml(spark, rows))))
    assert len(out) == 1 and out[0]["response_hours"] == 1


def test_composite_uses_unrounded_sum_for_tier(spark):
    df = spark.createDataFrame(
        [(7, 0.314, 0.0, 1.0, 4.0)],
        "deployments_last_7d bigint, ci_failure_rate_7d_avg double, drift_failure_rate_7d_avg double, "
        "avg_lead_time_days double, avg_mttr_hours double")
    scored = health_scores(df)
    for c in ("date_day", "team"):
        scored = scored.withColumn(c, F.lit(None))
    from shipgauge.schemas import HEALTH_COLUMNS
    for c in HEALTH_COLUMNS:
        if c not in scored.columns and c not in ("health_score", "health_tier"):
            scored = scored.withColumn(c, F.lit(None))
    (r,) = as_dicts(with_composite(scored))
    assert r["health_score"] == 90.0 and r["health_tier"] == "warning"


@pytest.mark.parametrize("bucket", [None, "hour"])
def test_null_keys_never_pair(spark, bucket):
    from shipgauge.config import PairingConfig, PipelineConfig

    rows = [("o1", None, "incident_opened", at(hour=1), None, None),
            ("c1", None, "incident_closed", at(hour=2), None, None),
            ("o2", "t", "incident_opened", at(hour=1), None, None),
            ("c2", "t", "incident_closed", at(hour=3), None, None)]
    df = spark.createDataFrame(rows, "event_id string, team string, event_type string, event_date timestamp, "
                                     "lead_time_days double, ci_passed boolean")
    cfg = PipelineConfig(pairing=PairingConfig(bucket=bucket))
    got = {r["incident_id"]: r["closed_at"] for r in as_dicts(facts.fct_incidents(stage_delivery_events(df), cfg))}
    assert got == {"o1": None, "o2": at(hour=3)}


def test_t6_score_defaults(spark):
    """No PR, no ML event, no incident: lead time scores worst, drift and MTTR score best."""
    ev = [_dep(1, "t", at(hour=1)), _dep(2, "t", at(hour=2), "ci_run", ci=True)]
    (r,) = as_dicts(platform_health_daily(stage_delivery_events(delivery(spark, ev)),
                                          stage_ml_events(empty_ml(spark))))
    assert (r["score_lead_time"], r["score_drift"], r["score_mttr"]) == (25.0, 100.0, 100.0)
    assert (r["drift_failure_rate_7d_avg"], r["avg_mttr_hours"], r["incident_count"]) == (0.0, 0.0, 0)


def test_t13_zero_fill_dilutes_mttr_metric(spark):
    """A day without incidents enters the MTTR metric as 0."""
    ev = [("o1", "t", "incident_opened", at(day=0, hour=1), None, None),
          ("c1", "t", "incident_closed", at(day=0, hour=11), None, None),
          _dep(3, "u", at(day=0, hour=5))]
    mart = platform_health_daily(stage_delivery_events(delivery(spark, ev)), stage_ml_events(empty_ml(spark)))
    (m,) = as_dicts(semantic.metric_query(mart, ["mean_time_to_recover"], ["metric_time"]))
    assert m["mean_time_to_recover"] == 5.0
