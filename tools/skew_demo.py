"""Hot-key demonstration: one team holds a third of all events.

Builds (once) a scaled copy of the sf0.1 event log -- ``copies`` copies with
fresh event ids; every third event is moved onto user 0, the rest keep one
user per copy -- then pairs incidents with the single-window plan, with hour
buckets and with the hierarchy of hours and seconds, checks that they give the
same rows, and reads Spark's event log for the largest task of each run. With
``one-hour`` all of user 0's events fall in one hour.

Usage: python tools/skew_demo.py <scratch_dir> [copies] [one-hour]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import shipgauge.session as S  # noqa: E402


def build_copy(spark, src, dst, copies, one_hour=False):
    ev = spark.read.parquet(src)
    n = ev.count()
    users = ev.agg(F.max("user_id")).first()[0] + 1
    replicated = ev.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)).cast("array<bigint>")))
    hot = (F.col("event_id") + F.col("copy") * n) % 3 == 0
    ts = F.col("ts")
    if one_hour:
        spot = F.pmod(F.xxhash64("event_id", "copy"), F.lit(3_600_000_000))
        hour = F.lit("2024-01-10 12:00:00").cast("timestamp_ntz")
        ts = F.when(hot, hour + F.make_dt_interval(secs=(spot / 1_000_000).cast("decimal(18,6)"))).otherwise(ts.cast("timestamp_ntz"))
    big = replicated.select(
        (F.col("event_id") + F.col("copy") * n).alias("event_id"), ts.alias("ts"),
        F.when(hot, F.lit(0))
         .otherwise(F.col("user_id") + F.col("copy") * users).alias("user_id"),
        "event_type", "value", "props")
    big.write.option("maxRecordsPerFile", 250_000).parquet(dst)


def task_stats(log_dir, t_from, t_to):
    import zstandard

    out = {"max_task_shuffle_read_records": 0, "max_task_ms": 0, "tasks": 0}
    for d in glob.glob(f"{log_dir}/eventlog_v2_*"):
        for f in sorted(glob.glob(d + "/events_*")):
            raw = open(f, "rb").read()
            if f.endswith(".zstd"):
                raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
            for line in raw.decode().splitlines():
                e = json.loads(line)
                if e.get("Event") != "SparkListenerTaskEnd":
                    continue
                ti = e["Task Info"]
                if not (t_from <= ti["Launch Time"] <= t_to):
                    continue
                m = e.get("Task Metrics") or {}
                rd = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                out["tasks"] += 1
                out["max_task_shuffle_read_records"] = max(out["max_task_shuffle_read_records"], rd)
                out["max_task_ms"] = max(out["max_task_ms"], ti["Finish Time"] - ti["Launch Time"])
    return out


def main():
    scratch = sys.argv[1]
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 30
    one_hour = sys.argv[3:] == ["one-hour"]
    data = f"{scratch}/events_x{copies}{'_one_hour' if one_hour else ''}"
    logs = f"{scratch}/eventlog"
    os.makedirs(logs, exist_ok=True)
    b = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g")
         .config("spark.sql.shuffle.partitions", "64").config("spark.eventLog.enabled", "true")
         .config("spark.eventLog.dir", logs))
    for k, v in S.RUNTIME_CONF.items():
        b = b.config(k, v)
    # keep AQE from merging small partitions, so task sizes show how keys spread
    b = b.config("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not os.path.exists(data):
        build_copy(spark, "/root/testdata/sf0.1/events.parquet", data, copies, one_hour)

    from shipgauge.config import PairingConfig, PipelineConfig
    from shipgauge.operators.staging import stage_delivery_events
    from shipgauge.plans.facts import fct_incidents
    from shipgauge.sources.events import adapt_delivery_events

    ev = spark.read.parquet(data)
    stg = stage_delivery_events(adapt_delivery_events(ev))
    result = {"events": ev.count(), "hot_team_share": round(ev.where("user_id = 0").count() / ev.count(), 3)}
    runs = {}
    for label, bucket in (("single_window", None), ("hour", "hour"), ("hour_second", ("hour", "second"))):
        df = fct_incidents(stg, PipelineConfig(pairing=PairingConfig(bucket=bucket)))
        t0 = time.time()
        df.write.format("noop").mode("overwrite").save()
        t1 = time.time()
        runs[label] = {"sec": round(t1 - t0, 2), "window": (int(t0 * 1000), int(t1 * 1000))}
    a = fct_incidents(stg, PipelineConfig(pairing=PairingConfig(bucket=None)))
    b2 = fct_incidents(stg, PipelineConfig(pairing=PairingConfig()))
    result["same_rows"] = a.exceptAll(b2).count() == 0 and b2.exceptAll(a).count() == 0
    result["incidents"] = a.count()
    spark.stop()
    for label, r in runs.items():
        r.update(task_stats(logs, *r.pop("window")))
    result["runs"] = runs
    print(json.dumps(result))


if __name__ == "__main__":
    main()
