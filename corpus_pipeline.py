"""The training-data pipeline over ``documents``: five stages, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipgauge.llm import decontaminate, packing, pii, quality, simhash
from shipgauge.llm.common import unused, written
from shipgauge.llm.queries import PII_KEY, tokenizer_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. A null text is scored as an empty one."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = unused("_quality", docs)
    scored = quality.score_quality(docs, model, name=name)
    return scored.filter(F.col(name) >= quality.THRESHOLD).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, the one with the smallest id; empty texts are a group."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    name = unused("_hits", docs)
    found = decontaminate.find_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), name=name)
    return found.filter(F.size(name) == 0).select(*docs.columns)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced in their texts; ``n_chars`` follows the new text."""
    new = pii.replace_entities(docs, PII_KEY, count=unused("_entities", docs))
    return new.select(*(F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c)
                        for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents that are left, with their places in sequences."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [("quality", keep_good), ("near_duplicates", keep_one_of_each), ("decontamination", drop_contaminated),
          ("pii", replace_personal_data), ("packing", pack)]

ORACLE_SQL = None  # classifier, automata and tokenizer: tested against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
