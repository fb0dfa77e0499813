"""What the plans read and shuffle: pruned branches, bucketed tables, single passes."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from shipgauge.operators import quality, rollups, staging
from shipgauge.plans import reports
from shipgauge.schemas import DELIVERY_EVENTS
from shipgauge.session import scratch_path
from shipgauge.sources.raw_tables import read_raw_table, save_raw_table

SF = "/root/testdata/sf0.001"


def planned(df):
    """The plan before adaptive execution."""
    return df._jdf.queryExecution().executedPlan().toString()


def counts(df):
    plan = planned(df)
    return len(re.findall("FileScan", plan)), len(re.findall(r"(?<!Reused)(?<!Broadcast)Exchange", plan))


@pytest.mark.parametrize("name, scans, exchanges", [
    ("dash_latest_day", 1, 1), ("dash_cfr", 1, 3), ("metric_change_failure_rate", 1, 3), ("dash_deploy_freq", 1, 3),
    ("lead_time_quantiles", 2, 3), ("dora_daily", 3, 6)])
def test_quantiles_are_computed_only_where_read(spark, name, scans, exchanges):
    found = counts(E.queries()[name](spark, SF))
    assert found[0] <= scans and found[1] <= exchanges


def test_declared_tests_read_each_table_once(spark):
    src = E._src(spark, SF)
    stg = staging.stage_delivery_events(src.delivery)
    tests = quality.declared_tests((), (), (), (), (), ())
    plan = quality.run_tests({"raw_delivery_events": src.delivery, "stg_delivery_events": stg}, tests)
    assert counts(plan)[0] == 2  # one scan a table
    assert len(re.findall(r"Exchange hashpartitioning\(id#\d+, value#\d+", planned(plan))) == 1


def test_bucketed_raw_table_prunes_days_and_keeps_the_team_partitioning(spark):
    path = scratch_path(spark, "raw_table")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    raw = E._src(spark, SF).delivery
    save_raw_table(raw, DELIVERY_EVENTS, name, path, buckets=4, pieces=2)
    some = read_raw_table(spark, name, DELIVERY_EVENTS, since="2024-01-10", until="2024-01-20")
    day = F.to_date("event_date")
    want = raw.where((day >= F.lit("2024-01-10").cast("date")) & (day <= F.lit("2024-01-20").cast("date")))
    assert some.count() == want.count() > 0
    assert some.exceptAll(want).count() == 0
    assert some.schema.fieldNames() == DELIVERY_EVENTS.fieldNames()
    assert re.search(r"PartitionFilters: \[[^\]]*event_day[^\]]*2024-01-10", planned(some))
    ci = some.where(F.col("event_type") == "ci_run")
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(event_type,ci_run\)", planned(ci))
    daily = rollups.dora_daily(staging.stage_delivery_events(read_raw_table(spark, name, DELIVERY_EVENTS)))
    rolling = rollups.with_dora_rolling(daily).select("date_day", "team", "deployments_last_7d")
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        assert counts(rolling) == (1, 0)
        whole = rollups.with_dora_rolling(rollups.dora_daily(staging.stage_delivery_events(raw)))
        assert rolling.exceptAll(whole.select("date_day", "team", "deployments_last_7d")).count() == 0
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


def test_latest_day_of_the_written_mart_reads_no_column(spark):
    mart = E._written_mart(spark, SF)
    plan = planned(reports.latest_day(mart))
    assert "ReadSchema: struct<>" in plan
    assert reports.latest_day(mart).collect() == E._mart(spark, SF).agg(F.max("date_day").alias("latest_day")).collect()
