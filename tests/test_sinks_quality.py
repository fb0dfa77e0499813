"""Sinks, naming, contract and declared-test runner."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from helpers import at, delivery
from shipgauge.operators import quality
from shipgauge.schemas import DELIVERY_EVENTS, HEALTH_CONTRACT
from shipgauge.sources.sinks import RequiredColumnError, ingest_overwrite, output_schema


def test_output_schema_naming():
    assert output_schema("prod", "analytics_prod", "marts") == "marts"
    assert output_schema("dev", "analytics_dev", "marts") == "analytics_dev_marts"
    assert output_schema("ci", "analytics_ci", " staging ") == "analytics_ci_staging"
    assert output_schema("dev", "analytics_dev", None) == "analytics_dev"


def test_ingest_overwrite_replaces_and_rejects_nulls(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="sg-ingest-"), "t")
    a = delivery(spark, [("1", "t", "ci_run", at(), None, True), ("2", "t", "ci_run", at(), None, False)])
    assert ingest_overwrite(spark, a, DELIVERY_EVENTS, path) == 2
    b = delivery(spark, [("3", "t", "deployment", at(), None, None)])
    assert ingest_overwrite(spark, b, DELIVERY_EVENTS, path) == 1
    bad = spark.createDataFrame([("4", None, "ci_run", at(), None, None)],
                                "event_id string, team string, event_type string, event_date timestamp, "
                                "lead_time_days double, ci_passed boolean")
    with pytest.raises(RequiredColumnError):
        ingest_overwrite(spark, bad, DELIVERY_EVENTS, path)
    assert spark.read.parquet(path).count() == 1  # old table kept


def test_contract_reports_and_fails(spark):
    cols = ", ".join(f"{n} {t.simpleString()}" for n, t, _ in HEALTH_CONTRACT)
    row = tuple(None if n == "health_score" else (1 if t.simpleString() == "bigint" else None)
                for n, t, _ in HEALTH_CONTRACT)
    df = spark.createDataFrame([row], cols)
    found = {(r["column_name"], r["check_name"]) for r in quality.contract(df).collect()}
    assert ("health_score", "not_null") in found and ("date_day", "not_null") in found
    with pytest.raises(quality.ContractError):
        quality.contract(df, mode="fail")
    renamed = df.withColumnRenamed("team", "team_name").withColumn("ci_run_count", F.lit("x"))
    found = {(r["column_name"], r["check_name"]) for r in quality.contract(renamed).collect()}
    assert {("team", "missing"), ("team_name", "unexpected"), ("ci_run_count", "type")} <= found


def test_run_tests_counts_failures(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "z")], "k string, v string")
    tests = [quality.ColumnTest("m", "k", "unique"), quality.ColumnTest("m", "v", "not_null"),
             quality.ColumnTest("m", "v", "accepted_values", ("x", "y"))]
    got = {r["test"]: r["failures"] for r in quality.run_tests({"m": df}, tests).collect()}
    assert got == {"unique": 1, "not_null": 1, "accepted_values": 1}


def test_health_score_bounds(spark):
    df = spark.createDataFrame([(at().date(), "t", 101.0), (at().date(), "u", 50.0)],
                               "date_day date, team string, health_score double")
    assert [r["team"] for r in quality.health_score_bounds(df).collect()] == ["t"]


def test_team_catalogs(spark):
    from shipgauge.functions.catalog import DEFAULT_CATALOG, NUMBERED_CATALOG

    df = spark.createDataFrame([("team-reco",), ("team-churn",), ("team-6",), ("team-x",), (None,)], "team string")
    t = F.col("team")
    got = {r["team"]: (r["d"], r["s"], r["nd"], r["ns"]) for r in df.select(
        "team", DEFAULT_CATALOG.domain(t).alias("d"), DEFAULT_CATALOG.sla_tier(t).alias("s"),
        NUMBERED_CATALOG.domain(t).alias("nd"), NUMBERED_CATALOG.sla_tier(t).alias("ns")).collect()}
    assert got["team-reco"][:2] == ("Personalisation", "tier-1")
    assert got["team-churn"][:2] == ("CRM", "tier-2")
    assert got["team-6"] == (None, None, "CRM", "tier-2")  # 6 mod 4 = 2
    assert got["team-x"] == (None, None, None, None)
    assert got[None] == (None, None, None, None)
