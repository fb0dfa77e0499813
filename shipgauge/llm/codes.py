"""Product codes of vectors by ball k-means, in whole numbers.

Each entry owns a ball: the parts assigned to it, out to the farthest one. Only
entries whose centres lie within twice that radius are its neighbours. Parts
nearer to the centre than half the way to the first neighbour form the stable
core and stay; those in the ring between half the ways to the k-th and the next
neighbour are compared with the k nearest neighbours only. A ball none of whose
neighbours (nor itself) moved since the last round is skipped as a whole. All
comparisons are of integers, so the result is that of comparing every part
with every entry.

Rounds leave nothing behind: a pass over the vectors replays the codebooks of
the rounds before it, block by block, and adds up sums per part and entry. A
task that is lost is done again from the vectors, and no table of assignments
is written. A ball is cut into the blocks' shares; a share's radius is its own.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import unused, written
from .vectors import EXACT, dimension, exact, exact_column, floors, matrices, partial_rows

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
FEW_LABELS = 100_000  # error sums of so many labels are broadcast, 3 MB at most
SALTS = 64            # pieces of a label's rows where there are more labels


@dataclass(frozen=True)
class Codebooks:
    """``rounds``: the codebooks at the start and after each round, [part][entry, position] each."""

    size: int
    rounds: tuple

    @property
    def final(self):
        return self.rounds[-1]

    def digest(self) -> str:
        """SHA-256 of all final entries' components by part, entry and position, comma-joined."""
        numbers = (str(int(x)) for book in self.final for x in book.ravel())
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def cuts(size: int, parts: int) -> list[int]:
    """Where parts begin and end; equal, or the first ones longer by one."""
    return [0, *np.cumsum([len(x) for x in np.array_split(np.arange(size), parts)]).tolist()]


def squared(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return ((points - centre) ** 2).sum(axis=-1)


class Balls:
    """One part position of a block: which entry each part belongs to, and its squared distance."""

    def __init__(self, points: np.ndarray, book: np.ndarray):
        self.points, self.book = points, book
        self.code = np.zeros(len(points), np.int64)
        self.apart = squared(points, book[0]) if len(book) else np.zeros(len(points), np.int64)
        self._search(np.ones(len(book), bool), fresh=True)

    def move(self, book: np.ndarray) -> None:
        """The assignment under the next round's codebook."""
        moved = (book != self.book).any(axis=1)
        self.book = book
        self._search(moved)

    def _search(self, moved: np.ndarray, fresh: bool = False) -> None:
        book, old = self.book, self.code
        between = squared(book[:, None, :], book[None, :, :])
        code, apart = old.copy(), self.apart.copy()
        order = np.argsort(old, kind="stable")
        edges = np.searchsorted(old[order], np.arange(len(book) + 1))
        for i in range(len(book)):
            rows = order[edges[i]:edges[i + 1]]
            if not len(rows):
                continue
            mine = squared(self.points[rows], book[i]) if moved[i] and not fresh else self.apart[rows]
            near = [j for j in np.argsort(between[i], kind="stable").tolist()
                    if j != i and between[i, j] <= 4 * mine.max()]
            if not fresh and not moved[i] and not moved[near].any():
                continue  # neither the ball nor a neighbour has moved
            far = np.argsort(-mine, kind="stable")
            rows, mine = rows[far], mine[far]
            best, name = mine.copy(), np.full(len(rows), i)
            for j in near:
                # parts beyond half the way; the others keep to rings further in
                ring = int(np.count_nonzero(4 * mine >= between[i, j]))
                other = squared(self.points[rows[:ring]], book[j])
                better = (other < best[:ring]) | ((other == best[:ring]) & (j < name[:ring]))
                best[:ring] = np.where(better, other, best[:ring])
                name[:ring] = np.where(better, j, name[:ring])
            code[rows], apart[rows] = name, best
        self.code, self.apart = code, apart


def _replayed(values: np.ndarray, rounds: tuple, size: int) -> list[Balls]:
    """Every part position of a block under the last codebooks, by replaying all rounds."""
    largest = max([int(np.abs(values).max(initial=0)), *(int(abs(x)) for books in rounds for b in books for x in b.ravel())])
    values = exact(values, 16 * (largest + 1) ** 2 * max(size, 1) * 4)
    edges, out = cuts(size, len(rounds[0])), []
    for p, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        books = [r[p].astype(values.dtype) for r in rounds]
        balls = Balls(values[:, a:b], books[0])
        for book in books[1:]:
            balls.move(book)
        out.append(balls)
    return out


def _first_entries(df: DataFrame, key: str, vector: str, size: int, parts: int, entries: int) -> tuple:
    """The parts of the ``entries`` smallest keys' vectors; of one key's rows the smaller vector comes first."""
    schema = T.StructType([T.StructField("key", df.schema[key].dataType), T.StructField("values", T.ArrayType(T.LongType()))])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for part, found in matrices(batch, "vector", size):
                yield pa.RecordBatch.from_arrays([part.column("key").cast(arrow[0].type),
                                                  pa.array(list(floors(found, SCALE)), arrow[1].type)], schema=arrow)

    rows = (df.select(F.col(key).alias("key"), F.col(vector).alias("vector")).mapInArrow(run, schema)
            .orderBy(F.asc_nulls_last("key"), "values").limit(entries).collect())
    values = np.array([r["values"] for r in rows], np.int64).reshape(len(rows), size)
    edges = cuts(size, parts)
    return tuple(values[:, a:b] for a, b in zip(edges, edges[1:], strict=False))


def train_codebooks(df: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = PARTS,
                    entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks after ``rounds`` rounds of assigning all parts and replacing entries by floored means.

    Rows with a null or unfit vector (``vectors``) take no part; a null key
    counts as the largest; with fewer rows than ``entries`` there are as many
    entries as rows, without any row none. An entry without parts stays.
    """
    size = dimension(df, vector)
    history = (_first_entries(df, key, vector, size, parts, entries),)
    width = max((b.shape[1] for b in history[0]), default=0)
    fields = [T.StructField("part", T.IntegerType()), T.StructField("entry", T.IntegerType()),
              T.StructField("n", T.LongType()), *(T.StructField(f"s{i}", EXACT) for i in range(width))]
    for _ in range(rounds if size and len(history[0][0]) else 0):
        def make(history=history):
            count = [np.zeros(len(b), np.int64) for b in history[-1]]
            total = [np.zeros(b.shape, object) for b in history[-1]]

            def add(batch):
                for _, found in matrices(batch, vector, size):
                    for p, balls in enumerate(_replayed(floors(found, SCALE), history, size)):
                        count[p] += np.bincount(balls.code, minlength=len(count[p]))
                        order = np.argsort(balls.code, kind="stable")
                        for e, rows in enumerate(np.split(order, np.cumsum(np.bincount(balls.code, minlength=len(count[p])))[:-1])):
                            total[p][e] += balls.points[rows].sum(axis=0)

            def finish():
                for p, (n, sums) in enumerate(zip(count, total, strict=True)):
                    used = np.flatnonzero(n)
                    more = [np.zeros(len(used), object)] * (width - sums.shape[1])
                    yield [[p] * len(used), used, n[used], *(exact_column(c) for c in [*sums[used].T, *more])]
            return add, finish

        sums = (partial_rows(df, [vector], fields, make).groupBy("part", "entry")
                .agg(F.sum("n").alias("n"), *(F.sum(f"s{i}").alias(f"s{i}") for i in range(width))).collect())
        new = [b.copy() for b in history[-1]]
        for r in sums:
            book = new[r["part"]]
            book[r["entry"]] = [int(r[f"s{i}"]) // r["n"] for i in range(book.shape[1])]
        history = (*history, tuple(new))
    return Codebooks(size, history)


def encode(df: DataFrame, books: Codebooks, vector: str = "embedding", keep: list[str] | None = None) -> DataFrame:
    """Rows with a fit vector, with ``code`` (entry of each part) and ``error`` (sum of squared distances).

    Output columns replace input columns of those names; an error beyond a long is null.
    """
    made = [T.StructField("code", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType())]
    keep = [c for c in (df.columns if keep is None else keep) if c not in ("code", "error")]
    hidden = unused("_vector", df)
    schema = T.StructType([df.schema[c] for c in keep] + made)
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for part, found in matrices(batch, hidden, books.size):
                balls = _replayed(floors(found, SCALE), books.rounds, books.size)
                codes = np.stack([b.code for b in balls], axis=1) if len(found) else np.zeros((0, len(balls)))
                error = sum(b.apart for b in balls)
                if error.dtype == object:
                    error = [int(x) if x < 1 << 63 else None for x in error]
                yield pa.RecordBatch.from_arrays([*(part.column(c).cast(arrow.field(c).type) for c in keep),
                                                  pa.array(list(codes.astype(np.int32)), arrow.field("code").type),
                                                  pa.array(error, pa.int64())], schema=arrow)

    rows = df.select(*keep, F.col(vector).alias(hidden))
    return rows.mapInArrow(run, schema) if len(books.final[0]) else rows.limit(0).mapInArrow(run, schema)


def with_label_error(coded: DataFrame, label: str = "label", few: int = FEW_LABELS) -> DataFrame:
    """Append ``label_error``: ``error`` added up over all rows of one label, null labels together.

    The sums of up to ``few`` labels are broadcast; more of them join by label
    and salt, so that a label with a third of all rows is spread. A sum beyond
    a long is null.
    """
    coded = written(coded.drop("label_error"), "codes")
    name, salt = unused("_label", coded), unused("_salt", coded)
    sums = written(coded.groupBy(F.col(label).alias(name)).agg(F.sum(F.col("error").cast(EXACT)).try_cast("long").alias("label_error")),
                   "label-errors")
    if sums.count() <= few:
        out = coded.join(F.broadcast(sums), F.col(label).eqNullSafe(F.col(name)), "left")
    else:
        spread = sums.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = coded.withColumn(salt, F.pmod(F.xxhash64(*coded.columns), F.lit(SALTS)).cast("int"))
        out = salted.join(spread, F.col(label).eqNullSafe(F.col(name)) & (salted[salt] == spread[salt]), "left")
    return out.select(*(coded[c] for c in coded.columns), "label_error")
