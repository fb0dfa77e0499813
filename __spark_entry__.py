"""

Every query reads the whole ``events`` table of ``sf_dir``, maps it onto the
two raw event streams, and runs one operator or model of the pipeline.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_sql import AS_OF_DATE, FRESHNESS_AS_OF, ORACLE_SQL  # noqa: E402
from shipgauge import config as C  # noqa: E402
from shipgauge.functions.catalog import TableCatalog  # noqa: E402
from shipgauge.operators import quality, rollups, staging  # noqa: E402
from shipgauge.operators.rolling import Rolling, add_calendar_rolling  # noqa: E402
from shipgauge.plans import facts, reports, semantic  # noqa: E402
from shipgauge.plans.health import build_health_inputs, health_scores, platform_health_joined  # noqa: E402
from shipgauge.plans.pipeline import build, build_facts, generic_sources, materialize, register_views, run  # noqa: E402
from shipgauge.schemas import DELIVERY_EVENTS  # noqa: E402
from shipgauge.session import scratch_path  # noqa: E402
from shipgauge.sources.events import read_delivery_events, read_ml_events  # noqa: E402
from shipgauge.sources.raw_tables import read_raw_table, save_raw_table  # noqa: E402
from shipgauge.sources.sinks import ingest_overwrite  # noqa: E402

FLAGSHIP_DIR = "/root/testdata/sf0.001"


def _src(spark, d):
    return generic_sources(spark, d)


def _stg(spark, d):
    return staging.stage_delivery_events(_src(spark, d).delivery)


def _stg_ml(spark, d):
    return staging.stage_ml_events(_src(spark, d).ml)


def _mart(spark, d):
    return build(_src(spark, d))["platform_health_daily"]


def _health_inputs(spark, d):
    return build_health_inputs(_stg(spark, d), _stg_ml(spark, d))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the daily platform-health mart at sf0.001."""
    return _mart(spark, FLAGSHIP_DIR)


def _ingest(spark, d):
    path = scratch_path(spark, "raw_delivery_events")
    ingest_overwrite(spark, _src(spark, d).delivery, DELIVERY_EVENTS, path)
    return spark.read.parquet(path)


def _calendar7(spark, d):
    daily = rollups.dora_daily(_stg(spark, d))
    return add_calendar_rolling(daily, ["team"], "date_day", [
        Rolling("deployments_last_7d", "sum", "deployment_count", 7),
        Rolling("ci_failure_rate_7d_avg", "avg", "ci_failure_rate", 7),
    ])


def _metric(name):
    return lambda spark, d: semantic.metric_query(_mart(spark, d), [name], ["metric_time"], "day")


def _gap_filled(spark, d):
    mart = _mart(spark, d)
    healthy = semantic.metric_query(mart, ["deployment_frequency", "platform_health_score"],
                                    ["metric_time"], "day", where=F.col("health_tier") == "healthy")
    return semantic.gap_filled(healthy, semantic.data_spine(mart))


def _freshness(spark, d):
    src = _src(spark, d)
    out = None
    for as_of in FRESHNESS_AS_OF:
        for name, df in (("delivery_events", src.delivery), ("ml_events", src.ml)):
            f = quality.freshness(df, "event_date", as_of, name)
            out = f if out is None else out.unionByName(f)
    return out


def _dq_report(spark, d):
    src = _src(spark, d)
    tables = {"raw_delivery_events": src.delivery, "raw_ml_events": src.ml, **build_facts(src)}
    tests = quality.declared_tests(C.TEAMS, C.MODEL_NAMES, C.DELIVERY_EVENT_TYPES, C.ML_EVENT_TYPES,
                                   C.PSI_SEVERITIES, C.SLA_TIERS)
    return quality.run_tests(tables, tests)


def _ml_rolling(spark, d):
    return rollups.with_ml_rolling(rollups.ml_delivery_daily(_stg_ml(spark, d)))


def _replayed(spark, d):
    """Incidents of a log in which every third event was loaded twice."""
    stg = _stg(spark, d)
    return facts.fct_incidents(stg.unionByName(stg.where(F.col("event_id").cast("bigint") % 3 == 0)))


def _built(spark, d):
    src = _src(spark, d)
    root = scratch_path(spark, "warehouse")
    return run(spark, src, root=root, as_of=FRESHNESS_AS_OF[-1])


def _typed_events(spark, d, which):
    """The typed reader over a typed raw table that Spark has written from the log."""
    src, path = _src(spark, d), scratch_path(spark, f"typed_{which}")
    getattr(src, which).write.parquet(path)
    return (read_delivery_events if which == "delivery" else read_ml_events)(spark, path)


def _sql_over_views(spark, d):
    register_views(build_facts(_src(spark, d)))
    return spark.sql("""select t.domain, count(*) as deployments, min(f.deployed_at) as first_at
                        from fct_deployments f join (select distinct team, domain from dim_teams) t on t.team = f.team
                        group by t.domain""")


def _dim_from_table(spark, d):
    """The dimension from a catalog kept as a table, written from the log: every seventh team is missing."""
    src, path = _src(spark, d), scratch_path(spark, "team_catalog")
    teams = src.ml.select("team").distinct().where(F.substring_index("team", "-", -1).cast("bigint") % 7 != 0)
    src.catalog.attach(teams).write.parquet(path)
    return facts.dim_teams(staging.stage_ml_events(src.ml), TableCatalog(spark.read.parquet(path)))


def _raw_table_rolling(spark, d):
    """Rolling deployments of some days from a raw table partitioned by day and bucketed by team."""
    path = scratch_path(spark, "raw_table")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    save_raw_table(_src(spark, d).delivery, DELIVERY_EVENTS, name, path, buckets=8, pieces=1)
    stg = staging.stage_delivery_events(read_raw_table(spark, name, DELIVERY_EVENTS, since="2024-01-10"))
    return rollups.with_dora_rolling(rollups.dora_daily(stg)).select(
        "date_day", "team", "deployment_count", "deployments_last_7d", "ci_failure_rate_7d_avg")


def _written_mart(spark, d):
    """The mart as ``materialize`` writes it, partitioned by day."""
    models = {"platform_health_daily": _mart(spark, d)}
    return materialize(spark, models, root=scratch_path(spark, "warehouse"), tables=("platform_health_daily",))["platform_health_daily"]


def _named_tables(spark, d):
    """The dimension written for development and for production, read back from the folders that the naming gives."""
    models = {"dim_teams": facts.dim_teams(_stg_ml(spark, d), _src(spark, d).catalog)}
    root, out = scratch_path(spark, "warehouse"), None
    for target, folder in (("dev", "analytics_dev_marts"), ("prod", "marts")):
        materialize(spark, models, target, f"analytics_{target}", root, ("dim_teams",))
        part = spark.read.parquet(f"{root}/{folder}/dim_teams").withColumn("target", F.lit(target))
        out = part if out is None else out.unionByName(part)
    return out


def _gap_filled_by_team(spark, d):
    """Incidents and scores by team and week, every team over the weeks of the data."""
    weekly = semantic.metric_query(_mart(spark, d), ["incidents", "platform_health_score"], ["metric_time", "team"], "week")
    return semantic.gap_filled_by(weekly, ["team"], "week", fill={"incidents": 0})


def _fixed_spine(spark, d):
    daily = semantic.metric_query(_mart(spark, d), ["incidents"], ["metric_time"], "day")
    return semantic.gap_filled(daily, semantic.time_spine(spark, "2023-12-25", "2024-02-05"), {"incidents": 0})


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources, sinks, staging
    "src_delivery_events": lambda s, d: _src(s, d).delivery,
    "src_ml_events": lambda s, d: _src(s, d).ml,
    "ingest_overwrite": _ingest,
    "stg_delivery_events": _stg,
    "stg_ml_events": _stg_ml,
    "event_breakdown_delivery": lambda s, d: staging.event_breakdown(_src(s, d).delivery),
    "event_breakdown_ml": lambda s, d: staging.event_breakdown(_src(s, d).ml),
    "psi_severity_counts": lambda s, d: staging.psi_severity_counts(_stg_ml(s, d)),
    # rollups and rolling windows
    "dora_daily": lambda s, d: rollups.dora_daily(_stg(s, d)),
    "dora_daily_rolling": lambda s, d: rollups.with_dora_rolling(rollups.dora_daily(_stg(s, d))),
    "dora_daily_calendar7": _calendar7,
    "lead_time_quantiles": lambda s, d: rollups.lead_time_quantiles(_stg(s, d)),
    "ml_delivery_daily": lambda s, d: rollups.ml_delivery_daily(_stg_ml(s, d)),
    "ml_delivery_rolling": _ml_rolling,
    "ml_team_daily": lambda s, d: rollups.ml_team_daily(_ml_rolling(s, d)),
    # next-event pairing and facts
    "fct_incidents": lambda s, d: facts.fct_incidents(_stg(s, d)),
    "incidents_daily": lambda s, d: rollups.incidents_daily(facts.fct_incidents(_stg(s, d))),
    "retrain_response": lambda s, d: facts.retrain_response(_stg_ml(s, d)),
    "retrain_response_daily": lambda s, d: rollups.retrain_response_daily(facts.retrain_response(_stg_ml(s, d))),
    "fct_ml_runs": lambda s, d: facts.fct_ml_runs(_stg_ml(s, d)),
    "fct_deployments": lambda s, d: facts.fct_deployments(_stg(s, d), _stg_ml(s, d), _src(s, d).catalog),
    "dim_teams": lambda s, d: facts.dim_teams(_stg_ml(s, d), _src(s, d).catalog),
    # health mart
    "platform_health_joined": lambda s, d: platform_health_joined(*_health_inputs(s, d)),
    "health_scores": lambda s, d: health_scores(platform_health_joined(*_health_inputs(s, d))).select(
        "date_day", "team", "score_deploy_freq", "score_ci_quality", "score_drift",
        "score_lead_time", "score_mttr"),
    "platform_health_daily": _mart,
    # data quality
    "dq_health_score_bounds": lambda s, d: quality.health_score_bounds(_mart(s, d)),
    "dq_contract": lambda s, d: quality.contract(_mart(s, d)),
    # key check before a team-grain join: the dimension repeats a team once per model
    "dq_unique": lambda s, d: quality.unique(facts.dim_teams(_stg_ml(s, d), _src(s, d).catalog), "team"),
    # the rows the contract's not_null on health_score rejects (no CI run in the 7-row window)
    "dq_not_null": lambda s, d: quality.not_null(_mart(s, d), "health_score").select(
        "date_day", "team", "health_score", "ci_failure_rate_7d_avg"),
    "dq_accepted_values": lambda s, d: quality.accepted_values(_src(s, d).delivery, "team", C.TEAMS),
    "dq_freshness": _freshness,
    "dq_report": _dq_report,
    # dashboards and alert report
    "dash_latest_day": lambda s, d: reports.latest_day(_mart(s, d)),
    "dash_health_today": lambda s, d: reports.health_today(_mart(s, d)),
    "dash_health_trend": lambda s, d: reports.health_trend(_mart(s, d)),
    "dash_deploy_freq": lambda s, d: reports.deploy_freq(_mart(s, d)),
    "dash_lead_time": lambda s, d: reports.lead_time(_mart(s, d)),
    "dash_cfr": lambda s, d: reports.change_failure_rate(_mart(s, d)),
    "dash_mttr": lambda s, d: reports.mttr(_mart(s, d)),
    "dash_precision_trend": lambda s, d: reports.precision_trend(_mart(s, d)),
    "dash_drift": lambda s, d: reports.drift(_mart(s, d)),
    "dash_ml_deploy": lambda s, d: reports.ml_deploy(_mart(s, d)),
    "dash_psi_dist": lambda s, d: reports.psi_distribution(facts.fct_ml_runs(_stg_ml(s, d)), AS_OF_DATE),
    "report_health": lambda s, d: reports.health_report(_mart(s, d)),
    "report_tier_counts": lambda s, d: reports.tier_counts(_mart(s, d)),
    # metric layer
    "metric_deployment_frequency": _metric("deployment_frequency"),
    "metric_lead_time": _metric("lead_time_for_change"),
    "metric_change_failure_rate": _metric("change_failure_rate"),
    "metric_mttr": _metric("mean_time_to_recover"),
    "metric_training_frequency": _metric("model_training_frequency"),
    "metric_model_deployment_frequency": _metric("model_deployment_frequency"),
    "metric_drift_failure_rate": _metric("drift_failure_rate"),
    "metric_health_score": _metric("platform_health_score"),
    "metric_retrain_response": _metric("retrain_response_time"),
    "measure_precision": _metric("avg_precision"),
    "measure_incidents": _metric("incidents"),
    "metric_gap_filled": _gap_filled,
    "time_spine": lambda s, d: semantic.data_spine(_mart(s, d)),
    "metric_team_month": lambda s, d: semantic.metric_query(
        _mart(s, d), ["deployment_frequency", "platform_health_score", "drift_failure_rate"], ["metric_time", "team"], "month"),
    "metric_tier_busy_weeks": lambda s, d: semantic.metric_query(
        _mart(s, d), ["mean_time_to_recover", "incidents"], ["metric_time", "health_tier"], "week",
        where=F.col("deployments_last_7d") >= 3),
    "metric_by_entity": lambda s, d: semantic.metric_query(_mart(s, d), ["model_training_frequency"], ["team_day"]),
    "metric_fixed_spine": _fixed_spine,
    # pairing of a log with rows loaded twice; sources, views and tables as a caller uses them
    "fct_incidents_replayed": _replayed,
    "typed_delivery_events": lambda s, d: _typed_events(s, d, "delivery"),
    "typed_ml_events": lambda s, d: _typed_events(s, d, "ml"),
    "sql_over_views": _sql_over_views,
    "pipeline_tests": lambda s, d: _built(s, d)["tests"],
    "mart_table_today": lambda s, d: reports.health_today(_built(s, d)["platform_health_daily"]),
    "report_worst_first": lambda s, d: reports.worst_first(_mart(s, d)),
    # report orders as places
    "dash_health_trend_places": lambda s, d: reports.health_trend_places(_mart(s, d)),
    "dash_psi_places": lambda s, d: reports.psi_places(facts.fct_ml_runs(_stg_ml(s, d)), AS_OF_DATE),
    # a catalog that users edit, tables by target, raw and mart tables read by day, gaps filled per team
    "dim_teams_from_table": _dim_from_table,
    "dim_teams_by_target": _named_tables,
    "raw_table_rolling": _raw_table_rolling,
    "mart_table_latest_day": lambda s, d: reports.latest_day(_written_mart(s, d)),
    "metric_gap_filled_by_team": _gap_filled_by_team,
    "metric_gap_filled_own_days": lambda s, d: semantic.gap_filled_by(
        semantic.metric_query(_mart(s, d), ["deployment_frequency"], ["metric_time", "team"]), ["team"], bounds="group"),
    "report_team_alerts": lambda s, d: reports.team_alerts(_mart(s, d)),
    # the bounds check on scores of which some are out of bounds
    "dq_bounds_violated": lambda s, d: quality.health_score_bounds(
        _mart(s, d).withColumn("health_score", F.col("health_score") * 2 - 60)),
}


# The training-data operators are a part that can be left out.
try:
    from shipgauge.llm.queries import ORACLE_SQL as _LLM_SQL
    from shipgauge.llm.queries import QUERIES as _LLM_QUERIES
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith("shipgauge.llm"):
        raise
    _LLM_QUERIES, _LLM_SQL = {}, {}
try:
    import corpus_pipeline as _pipeline
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith(("shipgauge.llm", "corpus_pipeline")):
        raise
else:
    _LLM_QUERIES = {**_LLM_QUERIES, "pipeline": _pipeline.run}
    if _pipeline.ORACLE_SQL:
        _LLM_SQL = {**_LLM_SQL, "pipeline": _pipeline.ORACLE_SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_LLM_QUERIES}


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in {**ORACLE_SQL, **_LLM_SQL}.items() if k in queries()}
