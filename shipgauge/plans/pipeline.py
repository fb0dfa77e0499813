"""The whole pipeline as one composition of DataFrame functions.

``build`` returns lazy DataFrames for every model. ``materialize`` writes
the marts as full-refresh parquet tables into the shared folder (or a
given root), named by target like the original's schema naming, and
returns them re-read from disk so later queries start from files, not
from the lineage.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipgauge import config as C
from shipgauge.config import DEFAULT, PipelineConfig
from shipgauge.functions.catalog import DEFAULT_CATALOG, NUMBERED_CATALOG
from shipgauge.operators.rollups import (
    dora_daily,
    incidents_daily,
    ml_delivery_daily,
    ml_team_daily,
    retrain_response_daily,
    with_dora_rolling,
    with_ml_rolling,
)
from shipgauge.operators import quality
from shipgauge.operators.staging import stage_delivery_events, stage_ml_events
from shipgauge.plans.facts import dim_teams, fct_deployments, fct_incidents, fct_ml_runs, retrain_response
from shipgauge.plans.health import health_scores, platform_health_joined, with_composite
from shipgauge.schemas import HEALTH_COLUMNS
from shipgauge.session import configure, require_utc, shared_dir
from shipgauge.sources.events import adapt_delivery_events, adapt_ml_events
from shipgauge.sources.sinks import publish, table_path, write_table


@dataclass
class Sources:
    delivery: DataFrame
    ml: DataFrame
    catalog: object = DEFAULT_CATALOG


def generic_sources(spark: SparkSession, data_dir: str) -> Sources:
    """Both raw streams adapted from ``<data_dir>/events.parquet``."""
    configure(spark)
    events = spark.read.parquet(f"{data_dir.rstrip('/')}/events.parquet")
    return Sources(adapt_delivery_events(events), adapt_ml_events(events), NUMBERED_CATALOG)


# Layer of every model, for output naming.
LAYERS = {
    "stg_delivery_events": "staging", "stg_ml_events": "staging",
    "dora_daily": "intermediate", "ml_delivery_daily": "intermediate",
    "retrain_response": "intermediate",
    "dim_teams": "marts", "fct_deployments": "marts", "fct_incidents": "marts",
    "fct_ml_runs": "marts", "platform_health_daily": "marts",
}


def build_facts(src: Sources, cfg: PipelineConfig = DEFAULT) -> dict[str, DataFrame]:
    """Staging, the dimension and the event-grain facts, lazily: what the declared tests read."""
    require_utc(src.delivery.sparkSession)
    stg = stage_delivery_events(src.delivery)
    stg_ml = stage_ml_events(src.ml, cfg)
    return {
        "stg_delivery_events": stg,
        "stg_ml_events": stg_ml,
        "dim_teams": dim_teams(stg_ml, src.catalog),
        "fct_deployments": fct_deployments(stg, stg_ml, src.catalog, cfg),
        "fct_incidents": fct_incidents(stg, cfg),
        "fct_ml_runs": fct_ml_runs(stg_ml, cfg),
    }


def build(src: Sources, cfg: PipelineConfig = DEFAULT) -> dict[str, DataFrame]:
    """Every model of the pipeline, lazily."""
    facts = build_facts(src, cfg)
    stg, stg_ml, incidents = facts["stg_delivery_events"], facts["stg_ml_events"], facts["fct_incidents"]
    dora = with_dora_rolling(dora_daily(stg, cfg), cfg)
    ml = with_ml_rolling(ml_delivery_daily(stg_ml), cfg)
    responses = retrain_response(stg_ml, cfg)
    joined = platform_health_joined(dora, ml_team_daily(ml), incidents_daily(incidents, cfg),
                                    retrain_response_daily(responses))
    return {
        **facts,
        "dora_daily": dora,
        "ml_delivery_daily": ml,
        "retrain_response": responses,
        "platform_health_daily": with_composite(health_scores(joined, cfg), cfg),
    }


# Fixed value: the table name dashboard SQL uses for the health mart. Every
# other model is registered under its own key.
VIEW_NAMES = {"platform_health_daily": "fct_platform_health_daily"}


def register_views(models: dict[str, DataFrame]) -> dict[str, str]:
    """Register every model as a temporary view, so dashboard SQL runs as is
    through ``spark.sql``; views stay lazy (Catalyst plans each query whole)."""
    names = {}
    for key, df in models.items():
        name = VIEW_NAMES.get(key, key)
        df.createOrReplaceTempView(name)
        names[key] = name
    return names


def materialize(spark: SparkSession, models: dict[str, DataFrame], target: str = "dev",
                target_schema: str = "analytics_dev", root: str | None = None,
                tables: tuple[str, ...] = ("dim_teams", "fct_deployments", "fct_incidents",
                                           "fct_ml_runs", "platform_health_daily")) -> dict[str, DataFrame]:
    """Write the given models as tables and return them read back.

    The health mart is partitioned by ``date_day`` so day filters prune
    files. Views (the rest) stay lazy and are returned unchanged.
    """
    root = root or f"{shared_dir(spark)}/warehouse"
    out = dict(models)
    for name in tables:
        path = table_path(root, target, target_schema, LAYERS[name], name)
        part = ["date_day"] if name == "platform_health_daily" else None
        write_table(models[name], path, partition_by=part)
        out[name] = spark.read.parquet(path)
    return out


class BuildFailed(RuntimeError):
    """A declared test, the mart contract or the freshness of a source failed; says which."""


def _gate(found: DataFrame, on_failure: str, what: str) -> None:
    if on_failure == "fail":
        failing = found.where(F.col("failures") > 0)
        if not failing.isEmpty():
            first = failing.orderBy(F.desc("failures")).first()
            raise BuildFailed(f"{failing.count()} {what} failed, most rows in: {first.asDict()}")


def source_freshness(src: Sources, as_of: str | None = None) -> DataFrame:
    """One row per source; ``as_of`` defaults to now."""
    moment = as_of or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    return (quality.freshness(src.delivery, "event_date", moment, "delivery_events")
            .unionByName(quality.freshness(src.ml, "event_date", moment, "ml_events")))


def _freshness_tests(fresh: DataFrame) -> DataFrame:
    model = F.concat(F.lit("raw_"), F.col("source"))
    return fresh.select(F.concat(F.lit("freshness_"), model).alias("test_name"), model.alias("model"),
                        F.lit("event_date").alias("column_name"), F.lit("freshness").alias("test"),
                        F.when(F.col("status") == "error", 1).otherwise(0).cast("bigint").alias("failures"))


def run(spark: SparkSession, src: Sources, cfg: PipelineConfig = DEFAULT, target: str = "dev",
        target_schema: str = "analytics_dev", root: str | None = None,
        with_tests: bool = True, on_failure: str = "report", as_of: str | None = None) -> dict[str, DataFrame]:
    """Build and write every table in dependency order, and test them.

    Each table is computed once: the health mart reads the written
    ``fct_incidents`` and the deployments the written ``dim_teams``. Views stay
    lazy. With ``with_tests`` the result also holds ``tests`` (every declared
    column test and the freshness of both sources, one row each), ``contract``
    (violations of the mart contract) and ``freshness``.

    ``on_failure="fail"`` raises :class:`BuildFailed` as soon as a level fails:
    sources and staging before any table is written, the contract before the
    new mart takes the place of the old one, the tables' tests at the end. An
    ageing source is only a warning until it is an error.
    """
    if on_failure not in ("report", "fail"):
        raise ValueError("on_failure is 'report' or 'fail'")
    require_utc(spark)
    root = root or f"{shared_dir(spark)}/warehouse"

    def path_of(name: str) -> str:
        return table_path(root, target, target_schema, LAYERS[name], name)

    def write(name: str, df: DataFrame) -> DataFrame:
        write_table(df, path_of(name))
        return spark.read.parquet(path_of(name))

    stg = stage_delivery_events(src.delivery)
    stg_ml = stage_ml_events(src.ml, cfg)
    out: dict[str, DataFrame] = {"stg_delivery_events": stg, "stg_ml_events": stg_ml}
    declared = quality.declared_tests(C.TEAMS, C.MODEL_NAMES, C.DELIVERY_EVENT_TYPES, C.ML_EVENT_TYPES,
                                      C.PSI_SEVERITIES, C.SLA_TIERS)
    first = {"raw_delivery_events": src.delivery, "raw_ml_events": src.ml, "stg_delivery_events": stg, "stg_ml_events": stg_ml}
    early = None
    if with_tests:
        out["freshness"] = source_freshness(src, as_of)
        early = write_results(spark, quality.run_tests(first, [t for t in declared if t.model in first])
                              .unionByName(_freshness_tests(out["freshness"])), root, "tests_sources")
        _gate(early, on_failure, "tests of sources and staging")
    out["dim_teams"] = write("dim_teams", dim_teams(stg_ml, src.catalog))
    out["fct_deployments"] = write("fct_deployments", fct_deployments(stg, stg_ml, src.catalog, cfg, dim=out["dim_teams"]))
    out["fct_ml_runs"] = write("fct_ml_runs", fct_ml_runs(stg_ml, cfg))
    out["fct_incidents"] = write("fct_incidents", fct_incidents(stg, cfg))
    out["dora_daily"] = with_dora_rolling(dora_daily(stg, cfg), cfg)
    out["ml_delivery_daily"] = with_ml_rolling(ml_delivery_daily(stg_ml), cfg)
    out["retrain_response"] = retrain_response(stg_ml, cfg)
    joined = platform_health_joined(out["dora_daily"], ml_team_daily(out["ml_delivery_daily"]),
                                    incidents_daily(out["fct_incidents"], cfg),
                                    retrain_response_daily(out["retrain_response"]))
    mart = path_of("platform_health_daily")
    staged = f"{mart}.building"
    write_table(with_composite(health_scores(joined, cfg), cfg), staged, partition_by=["date_day"])
    built = spark.read.parquet(staged).select(*HEALTH_COLUMNS)
    if with_tests:
        out["contract"] = write_results(spark, quality.contract(built), root, "contract")
        _gate(out["contract"], on_failure, "columns of the mart contract")
    publish(spark, staged, mart)
    out["platform_health_daily"] = spark.read.parquet(mart)
    if with_tests:
        late = {k: out[k] for k in ("dim_teams", "fct_deployments", "fct_incidents", "fct_ml_runs")}
        tests = quality.run_tests(late, [t for t in declared if t.model in late]).unionByName(
            quality.health_score_bounds(out["platform_health_daily"])
            .agg(F.count(F.lit(1)).alias("failures"))
            .select(F.lit("health_score_bounds").alias("test_name"),
                    F.lit("platform_health_daily").alias("model"), F.lit("health_score").alias("column_name"),
                    F.lit("singular").alias("test"), "failures"))
        tests = write_results(spark, tests, root, "tests_tables")
        _gate(tests, on_failure, "tests of tables")
        out["tests"] = early.unionByName(tests)
    return out


def write_results(spark: SparkSession, df: DataFrame, root: str, name: str) -> DataFrame:
    """Results of a build as a small table beside its tables, computed once."""
    path = f"{root}/_results/{name}"
    write_table(df.coalesce(1), path)
    return spark.read.schema(df.schema).parquet(path)
