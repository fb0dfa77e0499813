"""Ordered scans against brute force: random events with ties, several keys, a hot key."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shipgauge.operators.segmented import pair_next, sequence_number

T0 = dt.datetime(2024, 1, 1)


def _random_events(seed, n_cases=12, max_events=40):
    rng = random.Random(seed)
    rows = []
    for case in range(n_cases):
        # few distinct instants -> many ties; spans several hours and days
        instants = [T0 + dt.timedelta(minutes=rng.choice([0, 1, 30, 59, 60, 61, 600, 1439, 1440, 3000]))
                    + dt.timedelta(minutes=rng.randrange(0, 5)) for _ in range(6)]
        for i in range(rng.randrange(0, max_events)):
            key = rng.choice(["a", "b"]) if case % 3 else "hot"
            kind = rng.choice(["open", "close", "other"])
            rows.append((case, key, f"{case}-{i:03d}", rng.choice(instants), kind))
    return rows


def _brute_pairs(rows, distinct):
    out = {}
    for case, key, eid, ts, kind in rows:
        if kind != "open":
            continue
        later = [t for c, k, _, t, kd in rows if c == case and k == key and kd == "close" and t > ts]
        ident = (case, key, ts) if distinct else eid
        out[ident] = min(later) if later else None
    return out


@pytest.mark.parametrize("bucket", [None, "hour", "day", "minute", ("hour", "second"), ("day", "hour", "minute")])
@pytest.mark.parametrize("distinct", [False, True])
def test_pair_next_matches_brute_force(spark, bucket, distinct):
    rows = _random_events(seed=7 + len(bucket or "x"))
    df = spark.createDataFrame(rows, "case int, key string, eid string, ts timestamp, kind string")
    got = pair_next(df, ["case", "key"], "ts", F.col("kind") == "open", F.col("kind") == "close",
                    keep=["eid"], out="nxt", bucket=bucket, distinct_opens=distinct).collect()
    want = _brute_pairs(rows, distinct)
    if distinct:
        assert {(r["case"], r["key"], r["ts"]): r["nxt"] for r in got} == want
        assert len(got) == len(want)
    else:
        assert {r["eid"]: r["nxt"] for r in got} == want
        assert len(got) == len(want)


@pytest.mark.parametrize("bucket", [None, "hour", "minute", ("hour", "second"), ("day", "hour", "minute")])
def test_sequence_number_matches_row_number(spark, bucket):
    rows = _random_events(seed=11)
    df = spark.createDataFrame(rows, "case int, key string, eid string, ts timestamp, kind string")
    got = {r["eid"]: r["seq"] for r in
           sequence_number(df, ["case", "key"], ["ts", "eid"], "seq", bucket=bucket).collect()}
    want = {}
    groups = {}
    for case, key, eid, ts, _ in rows:
        groups.setdefault((case, key), []).append((ts, eid))
    for members in groups.values():
        for i, (_, eid) in enumerate(sorted(members), start=1):
            want[eid] = i
    assert got == want


def test_hot_key_bucketed_equals_single_window(spark):
    """All sf0.01 incidents forced onto one team: both plans give the same pairs."""
    from shipgauge.config import PairingConfig, PipelineConfig
    from shipgauge.operators.staging import stage_delivery_events
    from shipgauge.plans.facts import fct_incidents
    from shipgauge.sources.events import adapt_delivery_events

    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet").withColumn("user_id", F.lit(1))
    stg = stage_delivery_events(adapt_delivery_events(ev))
    a = fct_incidents(stg, PipelineConfig(pairing=PairingConfig(bucket=None)))
    for bucket in ("hour", ("hour", "second")):
        b = fct_incidents(stg, PipelineConfig(pairing=PairingConfig(bucket=bucket)))
        assert a.count() == b.count() == 2014
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_attached_tables_reach_every_numbered_row(spark):
    rows = _random_events(seed=5)
    df = spark.createDataFrame(rows, "case int, key string, eid string, ts timestamp, kind string")
    per_key = spark.createDataFrame([("a", 1.5), ("hot", 2.5)], "key string, weight double")
    per_case = spark.createDataFrame([(c, f"case {c}") for c in range(0, 12, 2)], "case int, label string")
    plain, split = (sequence_number(df, ["case", "key"], ["ts", "eid"], "seq", bucket=bucket,
                                    attach=[(per_key, ["key"]), (per_case, ["case"])])
                    .select("case", "key", "eid", "ts", "kind", "seq", "weight", "label")
                    for bucket in (None, ("hour", "second")))
    assert plain.count() == split.count() == len(rows)
    assert plain.exceptAll(split).count() == 0


def test_no_window_holds_a_hot_hour(spark):
    """One key, one hour, 20,000 instants: no task of the finest windows reads more than a small share of them."""
    ts = F.timestamp_micros(F.lit(1_704_880_800_000_000) + F.pmod(F.xxhash64("id"), F.lit(3_600_000_000)))
    df = spark.range(20_000).select(F.lit("hot").alias("key"), F.col("id").alias("eid"), ts.alias("ts"), (F.col("id") % 2).alias("kind"))
    paired = {b: pair_next(df, ["key"], "ts", F.col("kind") == 0, F.col("kind") == 1, ["eid"], out="nxt", bucket=b)
              for b in (None, ("hour", "second"))}
    assert paired[None].exceptAll(paired[("hour", "second")]).count() == 0
    held = (df.groupBy("key", F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp"), "ts").alias("second")).count())
    assert held.agg(F.max("count")).first()[0] < 40  # what one window partition of the finest level holds
