"""Document fingerprints by winnowing.

Every run of ``GRAM`` code points is hashed; of every ``WINDOW`` consecutive
hashes the smallest is chosen, the rightmost one on ties, and kept with its
position. Two texts that share ``GRAM + WINDOW - 1`` code points in a row share
a chosen hash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import add_columns

GRAM = 16  # a power of two: hashes of longer grams are joined from those of half the length
WINDOW = 16
BASE = 0x9E3779B97F4A7C15  # any odd 64-bit number
RANGES_PER_PARTITION = 8


def gram_hashes(points: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """32-bit hashes of all ``gram``-long runs; a shorter text has one, of all of it."""
    power, out = BASE, (points.astype(np.uint64) + np.uint64(1)) * np.uint64(BASE)
    length = 1
    while length < gram and len(out) > length:
        out = out[:-length] * np.uint64(power) + out[length:]
        power = power * power % (1 << 64)
        length *= 2
    if length < gram and len(points):
        out = np.array([xxhash.xxh64_intdigest(points.tobytes())], np.uint64)
    out = (out ^ (out >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return out >> np.uint64(32)


def winnow(text: str | None, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Chosen hashes and their positions, by position; a null or empty text has none."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes = gram_hashes(points, gram)
    # the smaller of two keys is the smaller hash, then the one further right
    least = (hashes << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - np.arange(len(hashes), dtype=np.uint64))
    covered, window = 1, min(window, len(hashes))
    while covered < window:
        step = min(covered, window - covered)
        least = np.minimum(least[:-step], least[step:])
        covered += step
    chosen = least[np.concatenate(([True], least[1:] != least[:-1]))]
    return chosen >> np.uint64(32), (0xFFFFFFFF - (chosen & np.uint64(0xFFFFFFFF))).astype(np.int64)


def digest(hashes: np.ndarray, positions: np.ndarray) -> str:
    return xxhash.xxh64_hexdigest(hashes.tobytes() + positions.tobytes())


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of two sets of chosen hashes (sorted, distinct); two empty ones are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append ``hashes`` and ``positions``, arrays of equal length, for each whole text.

    A null or empty text has empty arrays; a text shorter than a gram has one
    hash, of all of it. Rows are independent, equal texts have equal arrays.
    """
    def make():
        def work(texts):
            found = [winnow(t) for t in texts]
            return [[h.astype(np.int64) for h, _ in found], [p for _, p in found]]
        return work

    numbers = T.ArrayType(T.LongType())
    return add_columns(docs, [text], [T.StructField("hashes", numbers), T.StructField("positions", numbers)], make, keep)


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, int]:
    """Rows in runs of descending ``key``, each run ended by a guest: the row that follows it.

    Columns ``_range``, ``_guest``, key, text. Keys are cut into ranges at
    their quantiles; one shuffle brings a range together, and only the first
    row of each range is copied. After the last row the first one follows. A
    null key comes last, rows of one key are ordered by a hash of their text.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = partitions * RANGES_PER_PARTITION
    cuts = docs.agg(F.percentile_approx(key, [i / n for i in range(1, n)], 10 * n)).head()[0] or []
    bounds = np.unique(np.array(cuts, np.int64))

    @F.pandas_udf(T.IntegerType())
    def range_of(keys: pd.Series) -> pd.Series:
        known = keys.notna()
        out = pd.Series(-1, keys.index, dtype="int32")
        out[known] = np.searchsorted(bounds, keys[known].astype("int64"), side="left")
        return out

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    ranged = rows.withColumn("_range", range_of("key"))
    # only keys are read here: one row per range comes to the driver
    first = {r["_range"]: r["top"] for r in
             docs.select(F.col(key).alias("key")).withColumn("_range", range_of("key"))
             .groupBy("_range").agg(F.max("key").alias("top")).collect()}
    order = sorted(first, reverse=True)
    before = {r: order[i - 1] for i, r in enumerate(order)}  # the first range follows the last
    tops = [k for k in first.values() if k is not None]
    heads = (ranged.filter(F.col("key").isin(tops) | F.col("key").isNull())
             .groupBy("_range").agg(F.min_by("text", F.xxhash64("text")).alias("text")))
    follows = F.create_map(*(F.lit(x) for pair in before.items() for x in pair)) if before else None
    ranged = ranged.withColumn("_guest", F.lit(0))
    if before:
        guests = heads.select(F.lit(None).cast("long").alias("key"), "text",
                              follows[F.col("_range")].alias("_range"), F.lit(1).alias("_guest"))
        ranged = ranged.unionByName(guests)
    runs = (ranged.repartition(partitions, "_range")
            .sortWithinPartitions("_range", "_guest", F.desc_nulls_last("key"), F.xxhash64("text")))
    return runs.select("_guest", F.col("key").alias(key), F.col("text").alias(text)), len(order)


FIELDS = [T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
          T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
          T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())]


def compare_with_edited(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited form, and how alike they are.

    The edited form has its last third of code points replaced by as many of
    the next document's first ones, in descending order of ``key`` (see
    ``with_next`` for ties and nulls). A null text counts as an empty one; two
    empty fingerprints have likeness 1, one empty fingerprint has likeness 0.
    """
    runs, _ = with_next(docs, key, text)
    schema = T.StructType([T.StructField(key, T.LongType()), *FIELDS])
    arrow = to_arrow_schema(schema)

    def run(batches):
        held = None  # the row whose next one has not come yet
        for batch in batches:
            out = []
            for guest, name, body in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                body = body or ""
                found = winnow(body)
                kinds = np.unique(found[0])
                if held is not None:
                    k, own, chosen, mine = held
                    third = len(own) // 3
                    edited = own[:len(own) - third] + body[:third]
                    other = winnow(edited)
                    out.append((k, len(own), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                                digest(*chosen), digest(*other), likeness(mine, np.unique(other[0])), likeness(mine, kinds)))
                held = None if guest else (name, body, found, kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * len(arrow),
                                                                                  arrow, strict=True)], schema=arrow)

    return runs.mapInArrow(run, schema)
