"""Sinks: checked batch ingest, table materialisation and output naming."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shipgauge.config import PROD_TARGET
from shipgauge.sources.events import conform


class RequiredColumnError(ValueError):
    """Raised when a REQUIRED column holds NULLs; nothing is written then."""


def output_schema(target: str, target_schema: str, custom_schema: str | None) -> str:
    """Where a model lands.

    No custom schema -> the target's own schema. The production target uses
    the custom name as is; every other target prefixes it with its schema,
    e.g. ``dev`` + ``marts`` -> ``analytics_dev_marts`` when the target schema is
    ``analytics_dev``.
    """
    if custom_schema is None:
        return target_schema
    if target == PROD_TARGET:
        return custom_schema.strip()
    return f"{target_schema}_{custom_schema.strip()}"


def table_path(root: str, target: str, target_schema: str, custom_schema: str | None,
               table: str) -> str:
    return f"{root.rstrip('/')}/{output_schema(target, target_schema, custom_schema)}/{table}"


def required_violations(df: DataFrame, schema: T.StructType) -> dict[str, int]:
    """NULL counts of every REQUIRED column, in one aggregate pass."""
    required = [f.name for f in schema.fields if not f.nullable]
    if not required:
        return {}
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required]).first()
    return {c: int(row[c]) for c in required if row[c]}


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    """Materialise a full-refresh table as parquet (idempotent on retry)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Put the finished table at ``staged`` in the place of the one at ``path`` (two renames and a delete)."""
    jvm = spark.sparkContext._jvm
    new, old, aside = (jvm.org.apache.hadoop.fs.Path(p) for p in (staged, path, f"{path}.replaced"))
    fs = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(old.getParent())
    if fs.exists(aside):
        fs.delete(aside, True)
    if fs.exists(old) and not fs.rename(old, aside):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, old):
        fs.rename(aside, old)
        raise OSError(f"cannot move {staged} to {path}")
    fs.delete(aside, True)


def ingest_overwrite(spark: SparkSession, df: DataFrame, schema: T.StructType, path: str) -> int:
    """Truncate-and-replace load with an explicit schema, in one pass over the source.

    Casts ``df`` to ``schema`` and writes it beside ``path``, counting rows and
    the NULLs of REQUIRED columns on the way. The load is refused if there are
    such NULLs; the old table is replaced only by a complete new one. Returns
    the number of rows.
    """
    typed = conform(df, schema)
    required = [f.name for f in schema.fields if not f.nullable]
    seen = Observation()
    counted = typed.observe(seen, F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    staged = f"{path}.loading-{uuid.uuid4().hex[:12]}"
    write_table(counted, staged)
    bad = {c: int(seen.get[c]) for c in required if seen.get[c]}
    if bad:
        old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staged)
        old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)
        raise RequiredColumnError(f"NULL in REQUIRED columns: {bad}")
    publish(spark, staged, path)
    return int(seen.get["_rows"])
