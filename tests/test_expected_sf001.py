"""Counts at sf0.01 measured independently (with DuckDB) when the build was planned."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shipgauge.plans.pipeline import build, generic_sources

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def models(spark):
    return build(generic_sources(spark, SF))


def _counts(df, col):
    return {r[col]: r["n"] for r in df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).collect()}


def test_row_counts(models):
    assert models["dora_daily"].count() == 4006
    assert models["ml_delivery_daily"].count() == 6015
    assert models["fct_deployments"].count() == 1982
    assert models["platform_health_daily"].count() == 4006


def test_incidents_and_runs(models):
    inc = models["fct_incidents"]
    assert inc.count() == 2014 and inc.where("is_still_open").count() == 163
    runs = models["fct_ml_runs"]
    assert runs.count() == 4023 and runs.where("not was_deployed").count() == 570


def test_response_tiers(models):
    rr = models["retrain_response"]
    assert rr.count() == 2014
    assert _counts(rr, "response_tier") == {"fast": 401, "medium": 540, "slow": 744, "no_response": 329}


def test_tiers_and_null_scores(models):
    mart = models["platform_health_daily"]
    assert _counts(mart, "health_tier") == {"critical": 3427, "warning": 574, "healthy": 5}
    assert mart.where(F.col("health_score").isNull()).count() == 241


def test_psi_buckets(models):
    # k = 25 and k = 50 put PSI exactly on 0.10 and 0.20: both edges are warning
    assert _counts(models["stg_ml_events"], "psi_severity") == {
        "critical": 3993, "warning": 1021, "stable": 1023, None: 3963}


def test_rows_whose_7_row_window_spans_more_than_7_days(models):
    """T1: among rows with a full 7-row window, those covering more than 7 calendar days."""
    d = models["dora_daily"]
    frame = Window.partitionBy("team").orderBy("date_day").rowsBetween(-6, 0)
    spans = d.select(F.datediff("date_day", F.first("date_day").over(frame)).alias("span"),
                     F.count(F.lit(1)).over(frame).alias("rows"))
    assert spans.where("rows = 7 and span >= 7").count() == 1568


def test_naive_dimension_join_would_double_deployments(models, spark):
    """T5: the dimension has two models per team; joined on team alone it repeats every deployment."""
    dep = models["stg_delivery_events"].where("is_deployment")
    naive = dep.join(models["dim_teams"], "team", "left")
    assert naive.count() == 3964 and models["fct_deployments"].count() == 1982


def test_contract_reports_the_null_scores(models):
    """T2 at sf0.01: the contract's not_null on health_score reports 241 rows, not hides them."""
    from shipgauge.operators import quality

    found = {(r["column_name"], r["check_name"]): r["failures"]
             for r in quality.contract(models["platform_health_daily"]).collect()}
    assert found == {("health_score", "not_null"): 241, ("score_ci_quality", "not_null"): 241}
