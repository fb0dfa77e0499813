"""Rows loaded twice, rows without a time, keys that are NULL, and groups too large for a sketch."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shipgauge.config import PairingConfig, PipelineConfig
from shipgauge.operators import rollups
from shipgauge.operators.quantiles import exact_quantiles
from shipgauge.operators.segmented import pair_next
from shipgauge.operators.staging import stage_delivery_events, stage_ml_events
from shipgauge.plans import facts
from shipgauge.schemas import DELIVERY_EVENTS, ML_EVENTS
from helpers import at


BUCKETS = [None, "day", "hour", "minute"]


def _nullable(schema):
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def delivery(spark, rows):
    return spark.createDataFrame(rows, _nullable(DELIVERY_EVENTS))


def ml(spark, rows):
    return spark.createDataFrame(rows, _nullable(ML_EVENTS))


def _cfg(bucket):
    return PipelineConfig(pairing=PairingConfig(bucket=bucket))


@pytest.mark.parametrize("bucket", BUCKETS)
def test_incident_loaded_twice_is_one_row(spark, bucket):
    rows = [("1", "a", "incident_opened", at(hour=1), None, None)] * 2 + [
        ("2", "a", "incident_closed", at(hour=5), None, None), ("2", "a", "incident_closed", at(hour=5), None, None),
        ("3", "a", "incident_opened", at(hour=1), None, None)]
    got = facts.fct_incidents(stage_delivery_events(delivery(spark, rows)), _cfg(bucket)).collect()
    assert sorted((r.incident_id, r.mttr_hours) for r in got) == [("1", 4), ("3", 4)]


@pytest.mark.parametrize("bucket", BUCKETS)
def test_run_loaded_twice_is_one_row(spark, bucket):
    rows = [("1", "a", "m", "training_run", at(hour=1), 0.1, 0.5, None)] * 3 + [
        ("2", "a", "m", "model_deployed", at(day=2), None, None, None)]
    got = facts.fct_ml_runs(stage_ml_events(ml(spark, rows)), _cfg(bucket)).collect()
    assert [(r.run_id, r.time_to_deploy_hours) for r in got] == [("1", 47)]


@pytest.mark.parametrize("bucket", BUCKETS)
def test_open_without_time_has_no_later_close(spark, bucket):
    rows = [("1", "a", "incident_opened", None, None, None), ("2", "a", "incident_opened", at(hour=1), None, None),
            ("3", "a", "incident_closed", at(hour=5), None, None), ("4", "a", "incident_closed", None, None, None)]
    got = facts.fct_incidents(stage_delivery_events(delivery(spark, rows)), _cfg(bucket)).collect()
    assert sorted((r.incident_id, r.closed_at, r.is_still_open) for r in got) == [
        ("1", None, True), ("2", at(hour=5), False)]


@pytest.mark.parametrize("bucket", BUCKETS)
def test_drift_without_time_stays(spark, bucket):
    rows = [("1", "a", "m", "drift_detected", at(hour=1), 0.3, None, True),
            ("2", "a", "m", "drift_detected", None, 0.3, None, True),
            ("3", "a", "m", "retrain_triggered", at(hour=9), None, None, None)]
    got = facts.retrain_response(stage_ml_events(ml(spark, rows)), _cfg(bucket)).collect()
    assert sorted((r.drift_at is None, r.response_hours) for r in got) == [(False, 8), (True, None)]


def test_many_opens_at_one_instant(spark):
    t = dt.datetime(2024, 1, 1)
    events = spark.range(20000).select(F.lit("k").alias("key"), F.col("id").alias("eid"), F.lit(t).alias("ts"), F.lit("open").alias("kind"))
    events = events.unionByName(spark.createDataFrame([("k", -1, t, "close"), ("k", -2, t + dt.timedelta(hours=30), "close")],
                                                      "key string, eid long, ts timestamp, kind string"))
    got = pair_next(events, ["key"], "ts", F.col("kind") == "open", F.col("kind") == "close", ["eid"])
    assert got.groupBy("next_at").count().collect() == [(t + dt.timedelta(hours=30), 20000)]


def test_quantiles_of_a_null_team(spark):
    rows = [(str(i), None, "pr_merged", at(), float(v), None) for i, v in enumerate([1, 2, 3])]
    got = rollups.dora_daily(stage_delivery_events(delivery(spark, rows))).collect()
    assert [(r.team, r.avg_lead_time_days, r.p50_lead_time_days, r.p95_lead_time_days) for r in got] == [(None, 2.0, 2.0, 3.0)]


@pytest.mark.parametrize("n, large", [(200_000, 0), (2_000_000, 50_000), (50_000, 1e9), (50_000, 100), (1, 0)])
def test_quantiles_are_exact_at_any_size(spark, n, large):
    value = (F.pmod(F.xxhash64("id"), F.lit(10_000_019)) / 200_000.0 - 7.0).alias("v")
    df = spark.range(n).select(F.lit("g").alias("g"), value)
    got = exact_quantiles(df, ["g"], "v", {"p50": 0.5, "p95": 0.95, "p100": 1.0}, large, count="n").collect()
    values = sorted(r.v for r in df.select("v").toLocalIterator()) if n <= 200_000 else df.toPandas()["v"].sort_values().tolist()
    want = [values[math.ceil(p * n) - 1] for p in (0.5, 0.95, 1.0)]
    assert [tuple(r) for r in got] == [("g", n, *want)]


def test_quantiles_with_ties_and_nulls(spark):
    rows = [("a", v) for v in [1.0, 1.0, 1.0, 2.0, None, -3.5]] + [("b", None), (None, 4.0), (None, 4.0)]
    got = exact_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", {"p": 0.5}, 0.5).collect()
    assert sorted((r.g or "", r.p) for r in got) == [("", 4.0), ("a", 1.0)]


@pytest.mark.parametrize("large", [0, 1000])
def test_quantiles_with_nan_and_infinity(spark, large):
    inf, nan = float("inf"), float("nan")
    rows = ([("a", v) for v in (1.0, 2.0, 3.0, nan, nan)] + [("b", v) for v in (inf, inf, nan, -inf, 0.0)] + [("c", nan)]
            + [("d", 7.0)] * 300 + [("e", None)])
    got = {r.g: (r.p50, r.p95) for r in exact_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v",
                                                        {"p50": 0.5, "p95": 0.95}, large).collect()}
    same = lambda x, y: x == y or (math.isnan(x) and math.isnan(y))
    want = {"a": (3.0, nan), "b": (inf, nan), "c": (nan, nan), "d": (7.0, 7.0)}
    assert got.keys() == want.keys()
    assert all(same(x, y) for g in want for x, y in zip(got[g], want[g], strict=True))


@pytest.mark.parametrize("large", [0, 1000])
def test_quantiles_count_rows_without_value(spark, large):
    rows = [("a", 1.0), ("a", None), ("b", None), (None, 2.0)]
    got = exact_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", {"p": 0.5}, large, count="n", rows="all")
    assert sorted((r.g or "", r.n, r["all"], r.p) for r in got.collect()) == [("", 1, 1, 2.0), ("a", 1, 2, 1.0), ("b", 0, 1, None)]
