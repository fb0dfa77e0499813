"""Typed scans of the raw event tables and the adapter from a generic event log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shipgauge.session import require_utc
from shipgauge.schemas import DELIVERY_EVENTS, ML_EVENTS, TIMESTAMP_TYPES


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast ``df`` to ``schema`` (by name, in schema order).

    Timestamps keep their flavour: timestamp and timestamp_ntz both count as
    the event-time type, so a UTC wall-clock table is not shifted.
    """
    cols = []
    present = {f.name: f.dataType for f in df.schema.fields}
    for f in schema.fields:
        if f.name not in present:
            raise ValueError(f"column {f.name!r} missing; have {sorted(present)}")
        c = F.col(f.name)
        if isinstance(f.dataType, TIMESTAMP_TYPES) and isinstance(present[f.name], TIMESTAMP_TYPES):
            cols.append(c)
        elif present[f.name] == f.dataType:
            cols.append(c)
        else:
            cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def read_events(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet scan of the schema's columns only, cast to their types (a timestamp keeps the file's flavour)."""
    require_utc(spark)
    return conform(spark.read.parquet(path), schema)


def read_delivery_events(spark: SparkSession, path: str) -> DataFrame:
    return read_events(spark, path, DELIVERY_EVENTS)


def read_ml_events(spark: SparkSession, path: str) -> DataFrame:
    return read_events(spark, path, ML_EVENTS)


# ---------------------------------------------------------------------------
# Adapter: a generic event log (event_id, ts, user_id, event_type, value, props)
# mapped row by row onto both raw schemas. One user is one team; each user
# runs two models, chosen by event id parity.
# ---------------------------------------------------------------------------

# Generic event type -> delivery / ML event type.
DELIVERY_TYPE_OF = {
    "click": "ci_run",
    "signup": "pr_merged",
    "view": "deployment",
    "error": "incident_opened",
    "purchase": "incident_closed",
}
ML_TYPE_OF = {
    "click": "training_run",
    "signup": "training_run",
    "view": "model_deployed",
    "error": "drift_detected",
    "purchase": "retrain_triggered",
}


def _mapped(c: Column, mapping: dict[str, str]) -> Column:
    out = None
    for src, dst in mapping.items():
        out = F.when(c == F.lit(src), F.lit(dst)) if out is None else out.when(c == F.lit(src), F.lit(dst))
    return out


def _with_k(events: DataFrame) -> DataFrame:
    """Adds ``_k`` = integer ``props.k``, parsed once per row.

    Kept in its own projection: the mapping below uses it in several CASE
    branches, where Spark would otherwise parse the JSON once per branch.
    """
    return events.withColumn("_k", F.get_json_object(F.col("props"), "$.k").cast("int"))


def _team() -> Column:
    return F.concat(F.lit("team-"), F.col("user_id").cast("string"))


def adapt_delivery_events(events: DataFrame) -> DataFrame:
    """Delivery events from the generic log.

    click -> ci_run (passed when k >= 30), signup -> pr_merged (lead time
    value / 10 days), view -> deployment, error -> incident_opened,
    purchase -> incident_closed.
    """
    et = F.col("event_type")
    return _with_k(events).select(
        F.col("event_id").cast("string").alias("event_id"),
        _team().alias("team"),
        _mapped(et, DELIVERY_TYPE_OF).alias("event_type"),
        F.col("ts").alias("event_date"),
        F.when(et == "signup", F.col("value") / F.lit(10.0)).alias("lead_time_days"),
        F.when(et == "click", F.col("_k") >= F.lit(30)).alias("ci_passed"),
    )


def adapt_ml_events(events: DataFrame) -> DataFrame:
    """ML lifecycle events from the generic log.

    click/signup -> training_run (PSI k / 250, precision
    min(0.99, 0.4 + value / 200), drift flag NULL for every third event id,
    else k > 50); view -> model_deployed; error -> drift_detected
    (PSI 0.21 + k / 400, flag true); purchase -> retrain_triggered.
    """
    et = F.col("event_type")
    training = et.isin("click", "signup")
    k = F.col("_k").cast("double")
    return _with_k(events).select(
        F.col("event_id").cast("string").alias("event_id"),
        _team().alias("team"),
        F.concat(F.lit("model-"), F.col("user_id").cast("string"), F.lit("-"),
                 (F.col("event_id") % F.lit(2)).cast("string")).alias("model_name"),
        _mapped(et, ML_TYPE_OF).alias("event_type"),
        F.col("ts").alias("event_date"),
        F.when(training, k / F.lit(250.0))
         .when(et == "error", F.lit(0.21) + k / F.lit(400.0)).alias("psi_score"),
        F.when(training, F.least(F.lit(0.99), F.lit(0.4) + F.col("value") / F.lit(200.0)))
         .alias("precision_at_10"),
        F.when(training & (F.col("event_id") % F.lit(3) == F.lit(0)), F.lit(None).cast("boolean"))
         .when(training, F.col("_k") > F.lit(50))
         .when(et == "error", F.lit(True)).alias("drift_triggered"),
    )
