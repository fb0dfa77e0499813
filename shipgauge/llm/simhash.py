"""SimHash near-duplicates by tiled exact comparison.

A tile holds the fingerprints whose four 16-bit quarters have the same
population counts. Two fingerprints that differ in ``r`` bits lie in tiles
whose counts differ by ``r`` at most in sum, so only such tile pairs are
compared, bit by bit: exclusive-or and bit counts over numpy matrices. Equal
fingerprints are compared once, tiles are cut into blocks, and a comparison
returns links that keep its blocks connected rather than all its pairs.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import add_columns, unused, written
from .components import components

SHINGLE = 3
RADIUS = 2
SEED = 42
QUARTERS = 4
BASE_BLOCK = 1024   # fingerprints of a tile that one comparison holds
PROBE_BLOCK = 4096  # fingerprints that pass along them
AT_ONCE = 1 << 16   # shingles whose bits are counted at once


def fingerprint(text: str | None, shingle: int = SHINGLE) -> bytes:
    """Eight bytes, highest bit first; zero without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII letters and blanks only
    if not words:
        return bytes(8)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_digest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-shingle] + 1)).tolist()
    digest, n = xxhash.xxh64_digest, len(starts)
    counts = np.zeros(64, np.int64)
    stops = ends[shingle - 1:].tolist()
    for at in range(0, n, AT_ONCE):
        raw = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[at:at + AT_ONCE], stops[at:at + AT_ONCE], strict=True)])
        counts += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > n).tobytes()


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, keep: list[str] | None = None) -> DataFrame:
    """Append ``fingerprint`` (16 hex digits) of each whole text; null, empty or blank: zero."""
    def make():
        return lambda texts: [[fingerprint(t, shingle).hex() for t in texts]]

    return add_columns(docs, [text], [T.StructField("fingerprint", T.StringType())], make, keep)


def _steps(radius: int) -> list[tuple[int, ...]]:
    """Differences of quarter counts within ``radius``, one of each opposite pair, and zero."""
    found = [d for d in product(range(-radius, radius + 1), repeat=QUARTERS) if sum(map(abs, d)) <= radius]
    return [d for d in found if d >= (0,) * QUARTERS]


def tile_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``print``, long) within ``radius`` bits.

    Every pair within ``radius`` is connected through the links returned, and
    every link joins fingerprints connected by such pairs.
    """
    spark = prints.sparkSession
    size = 64 // QUARTERS
    counts = [F.bit_count(F.shiftrightunsigned("print", q * size).bitwiseAND((1 << size) - 1)) for q in range(QUARTERS)]
    scale = [(size + 1 + 2 * radius) ** q for q in range(QUARTERS)]
    number = sum((c + radius) * s for c, s in zip(counts, scale, strict=True))
    tiled = prints.select("print", number.cast("int").alias("tile"))
    # at most 17^4 tiles, whatever the number of fingerprints
    held = {r["tile"]: r["count"] for r in tiled.groupBy("tile").count().collect()}
    steps = [sum(x * s for x, s in zip(d, scale, strict=True)) for d in _steps(radius)]
    plan = [(t, 1 + n // BASE_BLOCK, 1 + sum(held.get(t - s, 0) for s in steps) // PROBE_BLOCK) for t, n in held.items()]
    blocks = F.broadcast(spark.createDataFrame(plan, "tile int, bases int, probes int"))
    pick = lambda n: F.pmod(F.xxhash64("print"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    bases = (tiled.join(blocks, "tile").select("tile", F.lit(0).alias("probe"), "print", pick("bases").alias("i"), "probes")
             .select("tile", "probe", "print", "i", each("probes").alias("j")))
    probes = (tiled.select("print", F.explode(F.array(*(F.col("tile") + s for s in steps))).alias("tile"))
              .join(blocks, "tile").select("tile", F.lit(1).alias("probe"), "print", pick("probes").alias("j"), "bases")
              .select("tile", "probe", "print", each("bases").alias("i"), "j"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    work = (bases.unionByName(probes).repartition(parts, "tile", "i", "j")
            .sortWithinPartitions("tile", "i", "j", "probe"))
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        unit, base = None, _Block(radius)
        for batch in batches:
            tile, probe, value, i, j = (batch.column(c).to_numpy() for c in ("tile", "probe", "print", "i", "j"))
            if not len(tile):
                continue
            cuts = np.flatnonzero((np.diff(tile) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
            out = []
            for a, b in zip([0, *cuts], [*cuts, len(tile)], strict=True):
                if unit != (now := (tile[a], i[a], j[a])):
                    out.append(base.close())
                    unit = now
                mid = a + int(np.searchsorted(probe[a:b], 1))
                base.add(value[a:mid].view(np.uint64))
                out.append(base.compare(value[mid:b].view(np.uint64)))
            yield _links(out, arrow)
        yield _links([base.close()], arrow)

    return work.mapInArrow(run, schema)


def _links(pairs: list, arrow: pa.Schema) -> pa.RecordBatch:
    both = [np.concatenate([p[k] for p in pairs]).view(np.int64) for k in (0, 1)]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in both], schema=arrow)


class _Block:
    """The base fingerprints of one unit and what the probes have connected among them."""

    def __init__(self, radius: int):
        self.radius = radius
        self.close()

    def close(self) -> tuple[np.ndarray, np.ndarray]:
        """Links of the unit's bases to their groups' first ones; begins a new unit."""
        none = np.zeros(0, np.uint64)
        prints, group = getattr(self, "prints", none), getattr(self, "group", np.zeros(0, np.int64))
        apart = group != np.arange(len(group))
        self.prints, self.group = none, np.zeros(0, np.int64)
        return prints[apart], prints[group[apart]]

    def add(self, prints: np.ndarray) -> None:
        self.group = np.concatenate([self.group, np.arange(len(prints)) + len(self.prints)])
        self.prints = np.concatenate([self.prints, prints])

    def compare(self, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One link for every probe that is near a base; its other near bases join that base's group.

        ``group`` names each base's root, the smallest of its group, before and after.
        """
        links = [(np.zeros(0, np.uint64), np.zeros(0, np.uint64))]
        for at in range(0, len(probes) if len(self.prints) else 0, 512):
            some = probes[at:at + 512]
            apart = np.bitwise_count(some[:, None] ^ self.prints[None, :])
            row, col = np.nonzero((apart <= self.radius) & (apart > 0))
            if not len(row):
                continue
            first = np.concatenate(([0], np.flatnonzero(np.diff(row)) + 1))
            of = np.repeat(np.arange(len(first)), np.diff([*first, len(row)]))
            links.append((some[row[first]], self.prints[col[first]]))
            while True:
                roots = self.group[col]
                least = np.minimum.reduceat(roots, first)[of]
                if (roots == least).all():
                    break  # every probe's bases share one root
                np.minimum.at(self.group, roots, least)  # only roots are hooked: what was grouped before stays together
                while (self.group != (above := self.group[self.group])).any():
                    self.group = above
        return tuple(np.concatenate(x) for x in zip(*links, strict=True))


def near_duplicates(prints: DataFrame, key: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """Append ``component_id`` to rows with a ``fingerprint``: the smallest key reachable by links.

    ``component_print`` names the component too, by its smallest fingerprint as a signed number.

    Fingerprints (zero included) link at ``radius`` or fewer differing bits.
    Repeated rows share a component; null keys don't count as smallest, a
    component of null keys only has a null id. No rows give no rows.
    """
    value = F.conv("fingerprint", 16, -10).cast("long")
    rows = prints.drop("component_id", "component_print")
    own = unused("_print", rows)
    rows = rows.withColumn(own, value)
    firsts = written(rows.groupBy(F.col(own).alias("print")).agg(F.min(key).alias("first")), "prints")
    roots = components(written(tile_links(firsts, radius), "tile-links"))
    rooted = (firsts.join(roots.withColumnRenamed("node", "print"), "print", "left")
              .select("print", "first", F.coalesce("root", "print").alias("root")))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select(F.col("print").alias(own), "component_id", F.col("root").alias("component_print"))
    return rows.join(named, own).drop(own)


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one with the smallest key.

    Among rows of one key the smaller hash of the text decides, of equal rows
    one stays; a null key counts as larger than any other.
    """
    # a null key compares as the largest, and joins, under a number and a flag
    none, own, body = names = [unused(n, docs) for n in ("_none", "_key", "_text")]
    ident = [F.col(key).isNull().alias(none), F.coalesce(F.col(key), F.lit(0)).alias(own), F.xxhash64(text).alias(body)]
    found = written(near_duplicates(written(fingerprints(docs.select(key, text, *ident), text, shingle, [key, *names]), "fingerprints"),
                                    key, radius), "groups")
    best = found.groupBy("component_print").agg(F.min(F.struct(*names)).alias("best")).select("best.*")
    kept = docs.select("*", *ident).join(best, names, "left_semi")
    if not found.groupBy(*names).count().filter("count > 1").isEmpty():
        kept = kept.dropDuplicates(names)
    return kept.select(*docs.columns)
