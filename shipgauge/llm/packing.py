"""Packing by column generation for the cutting-stock problem.

Every document's ids are cut into whole sequences and one remainder. Remainder
lengths are counted in classes of ``GRAIN`` tokens; that histogram has a fixed
size. On the driver a linear program over patterns (how many remainders of
each class share a sequence) is solved by column generation: the simplex
method's prices go to a knapsack dynamic program that returns the pattern
worth adding. Patterns are used a whole number of times, what rounding leaves
is filled first-fit. Spark then ranks the remainders of each class and gives
rank k the k-th place that the patterns have for the class.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, written
from .tokenise import encoder

SEQUENCE = 2048
GRAIN = 8
SEPARATOR = 1
RANKED_TOGETHER = 256  # pieces of a class that one window group ranks, about
GAP = 1e-4  # the linear program stops this close (relative) to its lower bound


def cut_documents(docs: DataFrame, tokenizer: str, text: str = "text", size: int = SEQUENCE,
                  keep: list[str] | None = None) -> DataFrame:
    """Rows of pieces: the kept columns, ``start``, ``length``, ``ids_crc32`` and ``doc_tokens``.

    A document's ids are its tokens and the separator id; they are cut every
    ``size`` ids. A null or empty text is the separator alone. Repeated rows
    are cut one by one.
    """
    piece = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32")]))
    fields = [T.StructField("doc_tokens", T.LongType()), T.StructField("pieces", piece)]
    end = np.array([SEPARATOR], "<u4").tobytes()

    def make():
        encode = encoder(tokenizer).encode

        def work(texts):
            tokens, cuts = [], []
            for t in texts:
                ids = memoryview(encode(t) + end)
                tokens.append(len(ids) // 4)
                cuts.append([{"start": a // 4, "length": len(ids[a:a + 4 * size]) // 4,
                              "ids_crc32": zlib.crc32(ids[a:a + 4 * size])} for a in range(0, len(ids), 4 * size)])
            return [tokens, cuts]
        return work

    cut = add_columns(docs, [text], fields, make, keep)
    own = [c for c in cut.columns if c not in ("pieces", "start", "length", "ids_crc32")]
    return cut.select(*own, F.inline("pieces"))


def knapsack(values: np.ndarray, units: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of ``units`` that fits ``room``; how often each is in it."""
    best, last = np.zeros(room + 1), np.full(room + 1, -1)
    for w in range(1, room + 1):
        best[w] = best[w - 1]
        n = int(np.searchsorted(units, w, side="right"))
        if n:
            worth = best[w - units[:n]] + values[:n]
            i = int(worth.argmax())
            if worth[i] > best[w]:
                best[w], last[w] = worth[i], i
    counts, w = np.zeros(len(units), np.int64), room
    while w > 0:
        if last[w] < 0:
            w -= 1
        else:
            counts[last[w]] += 1
            w -= int(units[last[w]])
    return float(best[room]), counts


def solve_patterns(demand: dict[int, int], room: int) -> list[tuple[np.ndarray, int, np.ndarray]]:
    """Patterns for ``demand`` (units -> pieces): [(counts by class, times)], classes in ascending units."""
    units = np.array(sorted(demand), np.int64)
    need = np.array([demand[int(u)] for u in units], float)
    m = len(units)
    patterns = [np.where(np.arange(m) == i, room // units[i], 0) for i in range(m)]
    inverse = np.diag([1.0 / (room // u) for u in units])
    used = inverse @ need
    while True:
        prices = inverse.sum(axis=0)
        worth, column = knapsack(np.maximum(prices, 0), units, room)
        if worth <= 1 + 1e-9 or used.sum() * (1 - 1 / worth) <= max(GAP * used.sum(), 1e-9):
            break
        step = inverse @ column
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(step > 1e-9, used / step, np.inf)
        out = int(ratio.argmin())
        amount = ratio[out]
        used = np.maximum(used - amount * step, 0)
        used[out] = amount
        inverse[out] /= step[out]
        others = np.arange(m) != out
        inverse[others] -= np.outer(step[others], inverse[out])
        patterns[out] = column
    times = np.floor(used + 1e-9).astype(np.int64)
    left = need.astype(np.int64) - sum((t * p for t, p in zip(times, patterns, strict=True)), np.zeros(m, np.int64))
    plan = [(p, int(t)) for p, t in zip(patterns, times, strict=True) if t]
    left = np.maximum(left, 0)
    while left.any():  # what rounding left: a few pieces a class
        pattern, free = np.zeros(m, np.int64), room
        for i in range(m - 1, -1, -1):
            n = min(int(left[i]), free // int(units[i]))
            pattern[i] = n
            free -= n * int(units[i])
        repeat = int((left[pattern > 0] // pattern[pattern > 0]).min())
        plan.append((pattern, repeat))
        left -= repeat * pattern
    return [(p, t, units) for p, t in plan]


@dataclass
class Places:
    """For each class the first rank, sequence and repetition of every pattern that has it."""

    first_rank: dict[int, np.ndarray]
    each: dict[int, np.ndarray]
    first_sequence: dict[int, np.ndarray]

    @staticmethod
    def of(plan) -> Places:
        ranks, each, sequences, nxt, at = {}, {}, {}, {}, 0
        for pattern, times, units in plan:
            for i in np.flatnonzero(pattern):
                u = int(units[i])
                ranks.setdefault(u, []).append(nxt.get(u, 0))
                each.setdefault(u, []).append(int(pattern[i]))
                sequences.setdefault(u, []).append(at)
                nxt[u] = nxt.get(u, 0) + times * int(pattern[i])
            at += times
        return Places(*({u: np.array(x, np.int64) for u, x in d.items()} for d in (ranks, each, sequences)))

    def sequence(self, unit: int, rank: np.ndarray) -> np.ndarray:
        j = np.searchsorted(self.first_rank[unit], rank, side="right") - 1
        return self.first_sequence[unit][j] + (rank - self.first_rank[unit][j]) // self.each[unit][j]


def pack(pieces: DataFrame, size: int = SEQUENCE, order: tuple[str, ...] = ("doc_id", "start")) -> DataFrame:
    """Give every piece a ``sequence_id`` and its ``offset`` there.

    ``pieces`` has ``length`` (1 to ``size``) and the ``order`` columns, which
    rank pieces of one class (longest first; nulls first; equal rows are
    interchangeable). Only the class histogram and the plan, both of fixed
    size, pass through the driver. No table of pieces gives no sequences.
    """
    spark = pieces.sparkSession
    room = size // GRAIN
    classed = pieces.withColumn("_units", F.ceil(F.col("length") / GRAIN).cast("int"))
    demand = {r["_units"]: r["count"] for r in classed.groupBy("_units").count().collect()}
    if not demand:
        return pieces.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    places = Places.of(solve_patterns(demand, room))
    buckets = min(1 << 16, 1 + max(demand.values()) // RANKED_TOGETHER)
    classed = classed.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = classed.groupBy("_units", "_bucket").count()
    before = Window.partitionBy("_units").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_units", "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_units", "_bucket").orderBy(F.desc("length"), *order)
    ranked = (classed.withColumn("_rank", F.row_number().over(within) - 1)
              .join(bases, ["_units", "_bucket"])
              .withColumn("_rank", F.col("_base") + F.col("_rank")))

    def make():
        def work(units, ranks):
            units, ranks = np.array(units, np.int64), np.array(ranks, np.int64)
            out = np.zeros(len(units), np.int64)
            for u in np.unique(units):
                here = units == u
                out[here] = places.sequence(int(u), ranks[here])
            return [out.tolist()]
        return work

    placed = add_columns(ranked.drop("_base", "_bucket"), ["_units", "_rank"],
                         [T.StructField("sequence_id", T.LongType())], make)
    ahead = (Window.partitionBy("sequence_id").orderBy(F.desc("_units"), "_rank")
             .rowsBetween(Window.unboundedPreceding, -1))
    return (placed.withColumn("offset", F.coalesce(F.sum("length").over(ahead), F.lit(0)))
            .drop("_units", "_rank"))


def pack_documents(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Pieces of all documents with their places; see ``cut_documents`` and ``pack``."""
    pieces = written(cut_documents(docs, tokenizer, text, keep=[key]), "pieces")
    return pack(pieces, order=(key, "start", "ids_crc32")).select(
        key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
