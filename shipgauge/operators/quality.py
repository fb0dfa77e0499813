"""Data-quality checks. Each returns its violations as a DataFrame: no rows = pass.

The declared tests of a table share one pass over it, and all uniqueness tests
of all tables one shuffle (:func:`run_tests`).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shipgauge.config import FRESHNESS_ERROR_HOURS, FRESHNESS_WARN_HOURS
from shipgauge.schemas import HEALTH_CONTRACT, same_type


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` seen more than once (NULLs are not checked)."""
    return (df.where(F.col(column).isNotNull())
            .groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside ``values`` with their row counts (NULL passes)."""
    c = F.col(column)
    return (df.where(c.isNotNull() & ~c.isin(*values))
            .groupBy(column).agg(F.count(F.lit(1)).alias("n_records")))


def health_score_bounds(mart: DataFrame) -> DataFrame:
    """Rows with a health score outside [0, 100]."""
    s = F.col("health_score")
    return mart.where((s < 0) | (s > 100)).select("date_day", "team", "health_score")


def freshness(df: DataFrame, loaded_at: str, as_of: str | dt.datetime, source: str = "",
              warn_after_hours: int = FRESHNESS_WARN_HOURS,
              error_after_hours: int = FRESHNESS_ERROR_HOURS) -> DataFrame:
    """One row: newest ``loaded_at``, its age in whole hours at ``as_of`` and
    ``ok`` / ``warn`` / ``error`` (over ``warn_after_hours`` / ``error_after_hours``).

    The age is measured in microseconds so a source exactly at a threshold
    is not yet stale.
    """
    dtype = df.schema[loaded_at].dataType
    at = F.lit(str(as_of)).cast(dtype)
    newest = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    age_us = F.timestamp_diff("MICROSECOND", F.col("max_loaded_at"), at)
    hour_us = 3_600_000_000
    return newest.select(
        F.lit(source).alias("source"),
        "max_loaded_at",
        at.alias("snapshotted_at"),
        F.timestamp_diff("HOUR", F.col("max_loaded_at"), at).alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
         .when(age_us > F.lit(error_after_hours * hour_us), F.lit("error"))
         .when(age_us > F.lit(warn_after_hours * hour_us), F.lit("warn"))
         .otherwise(F.lit("ok")).alias("status"),
    )


class ContractError(ValueError):
    pass


def contract(df: DataFrame, spec=HEALTH_CONTRACT, mode: str = "report") -> DataFrame:
    """Check ``df`` against a (name, type, not_null) contract.

    Violations as rows (column_name, check_name, failures): ``missing``,
    ``unexpected``, ``type`` (schema, read from the plan, no data touched),
    and ``not_null`` (NULL counts, one aggregate pass). ``mode="fail"``
    raises :class:`ContractError` when any violation exists.
    """
    spark = df.sparkSession
    actual = {f.name: f.dataType for f in df.schema.fields}
    schema_rows = []
    for name, dtype, _ in spec:
        if name not in actual:
            schema_rows.append((name, "missing", 1))
        elif not same_type(actual[name], dtype):
            schema_rows.append((name, "type", 1))
    expected = {name for name, _, _ in spec}
    schema_rows += [(name, "unexpected", 1) for name in actual if name not in expected]

    required = [name for name, _, nn in spec if nn and name in actual]
    out_schema = T.StructType([T.StructField("column_name", T.StringType()),
                               T.StructField("check_name", T.StringType()),
                               T.StructField("failures", T.LongType())])
    if required:
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
        stacked = counts.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.lit("not_null").alias("check_name"),
                     F.col(c).alias("failures")) for c in required])).alias("v")).select("v.*")
        nulls = stacked.where(F.col("failures") > 0)
    else:
        nulls = spark.createDataFrame([], out_schema)
    result = nulls
    if schema_rows:
        result = spark.createDataFrame(schema_rows, out_schema).unionByName(nulls)
    if mode == "fail":
        found = result.limit(1).collect()
        if found:
            raise ContractError(f"contract violated, e.g. {found[0].asDict()}")
    return result


# ---------------------------------------------------------------------------
# Declared tests, run like a test suite: one row per test with its failures.
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class ColumnTest:
    model: str
    column: str
    test: str  # "unique", "not_null" or "accepted_values"
    values: tuple = field(default=())

    @property
    def name(self) -> str:
        return f"{self.test}_{self.model}_{self.column}"


def _findings(df: DataFrame, tests: Sequence[tuple[int, ColumnTest]]) -> DataFrame:
    """One pass over a table: (id, value) for every value that a unique test must compare, (id, NULL) for every other failure."""
    found = []
    for number, t in tests:
        c = F.col(t.column)
        if t.test == "unique":
            wanted, value = c.isNotNull(), c.cast("string")
        elif t.test == "not_null":
            wanted, value = c.isNull(), F.lit(None).cast("string")
        elif t.test == "accepted_values":
            wanted, value = c.isNotNull() & ~c.isin(*t.values), F.lit(None).cast("string")
        else:
            raise ValueError(t.test)
        found.append(F.when(wanted, F.struct(F.lit(number).alias("id"), value.alias("value"))))
    return df.select(F.explode(F.array_compact(F.array(*found))).alias("f")).select("f.*")


def run_tests(tables: dict[str, DataFrame], tests: Sequence[ColumnTest]) -> DataFrame:
    """Every test's failure count (rows for not_null / accepted_values,
    duplicated values for unique), one row per test.

    Each table is read once, whatever the number of its tests. The values to
    compare of all tables share one shuffle, by test and value; rows that fail
    another test are counted in the same aggregate, combined before the shuffle.
    """
    asked = [(i, t) for i, t in enumerate(t for t in tests if t.model in tables)]
    if not asked:
        raise ValueError("no test for these tables")
    spark = next(iter(tables.values())).sparkSession
    findings = None
    for model, df in tables.items():
        mine = [(i, t) for i, t in asked if t.model == model]
        if mine:
            part = _findings(df, mine)
            findings = part if findings is None else findings.unionByName(part)
    unique = [i for i, t in asked if t.test == "unique"]
    counted = findings.groupBy("id", "value").agg(F.count(F.lit(1)).alias("n"))
    failures = F.sum(F.when(~F.col("id").isin(*unique), F.col("n")).when(F.col("n") > 1, 1).otherwise(0))
    totals = counted.groupBy("id").agg(failures.alias("found"))
    names = spark.createDataFrame([(i, t.name, t.model, t.column, t.test) for i, t in asked],
                                  "id int, test_name string, model string, column_name string, test string")
    return names.join(totals, "id", "left").select("test_name", "model", "column_name", "test",
                                                   F.coalesce("found", F.lit(0)).cast("bigint").alias("failures"))


def declared_tests(teams: Sequence[str], models: Sequence[str], delivery_types: Sequence[str],
                   ml_types: Sequence[str], severities: Sequence[str],
                   sla_tiers: Sequence[str]) -> list[ColumnTest]:
    """The column tests declared on sources, staging and marts (fixed values: which test on which column)."""
    T_ = ColumnTest
    tests = []
    for m in ("raw_delivery_events", "raw_ml_events"):
        tests += [T_(m, "event_id", "unique"), T_(m, "event_id", "not_null"),
                  T_(m, "team", "not_null"), T_(m, "team", "accepted_values", tuple(teams)),
                  T_(m, "event_type", "not_null"), T_(m, "event_date", "not_null")]
    tests += [T_("raw_delivery_events", "event_type", "accepted_values", tuple(delivery_types)),
              T_("raw_ml_events", "event_type", "accepted_values", tuple(ml_types)),
              T_("raw_ml_events", "model_name", "not_null"),
              T_("raw_ml_events", "model_name", "accepted_values", tuple(models))]
    for m in ("stg_delivery_events", "stg_ml_events"):
        tests += [T_(m, "event_id", "unique"), T_(m, "event_id", "not_null"),
                  T_(m, "team", "not_null"), T_(m, "event_type", "not_null"),
                  T_(m, "event_day", "not_null")]
    tests += [T_("stg_delivery_events", "event_timestamp", "not_null"),
              T_("stg_ml_events", "model_name", "not_null"),
              T_("stg_ml_events", "psi_severity", "accepted_values", tuple(severities)),
              T_("dim_teams", "team", "not_null"), T_("dim_teams", "model_name", "not_null"),
              T_("dim_teams", "sla_tier", "accepted_values", tuple(sla_tiers)),
              T_("fct_deployments", "deployment_id", "unique"),
              T_("fct_deployments", "deployment_id", "not_null"),
              T_("fct_deployments", "team", "not_null"),
              T_("fct_deployments", "lead_time_days", "not_null"),
              T_("fct_incidents", "incident_id", "unique"), T_("fct_incidents", "incident_id", "not_null"),
              T_("fct_incidents", "team", "not_null"), T_("fct_incidents", "opened_at", "not_null"),
              T_("fct_ml_runs", "run_id", "unique"), T_("fct_ml_runs", "run_id", "not_null"),
              T_("fct_ml_runs", "team", "not_null"), T_("fct_ml_runs", "model_name", "not_null"),
              T_("fct_ml_runs", "psi_severity", "accepted_values", tuple(severities))]
    return tests
