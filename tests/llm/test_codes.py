"""Vector codes against comparing every part with every entry."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shipgauge.llm import codes, queries
from shipgauge.llm.codes import Balls, encode, squared, train_codebooks, with_label_error


def brute(rows, parts=8, entries=16, rounds=6):
    """rows: (vec_id, vector), in order of entries. ({position: (code, error)}, codebooks) in Python's integers."""
    size = len(rows[0][1])
    values = [[math.floor(4096 * c) for c in v] for _, v in rows]
    cut = codes.cuts(size, parts)
    books = [[v[a:b] for v in values[:entries]] for a, b in zip(cut, cut[1:])]

    def nearest():
        out = []
        for v in values:
            best = [min((sum((x - c) ** 2 for x, c in zip(v[a:b], entry)), e) for e, entry in enumerate(books[p]))
                    for p, (a, b) in enumerate(zip(cut, cut[1:]))]
            out.append(best)
        return out

    for _ in range(rounds):
        found = nearest()
        for p, (a, b) in enumerate(zip(cut, cut[1:])):
            for e in range(len(books[p])):
                mine = [v[a:b] for v, f in zip(values, found) if f[p][1] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    found = nearest()
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return [([e for _, e in f], sum(d for d, _ in f)) for f in found], digest


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").limit(400)
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    want, digest = brute(rows)
    books = train_codebooks(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(6))
    got = {r["vec_id"]: (r["code"], r["error"]) for r in encode(table, books).collect()}
    assert got == {i: w for (i, _), w in zip(rows, want)} and books.digest() == digest
    assert queries.op13_codes(spark, sf).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


@pytest.mark.parametrize("seed", range(6))
def test_balls_equal_full_search_with_ties_and_unmoved_entries(seed):
    rng = np.random.default_rng(seed)
    points = rng.integers(-4, 5, size=(500, 2))
    book = rng.integers(-4, 5, size=(7, 2))
    balls = Balls(points, book)
    for _ in range(5):
        apart = np.stack([squared(points, c) for c in book], axis=1)
        assert (balls.code == apart.argmin(axis=1)).all() and (balls.apart == apart.min(axis=1)).all()
        book = book.copy()
        book[rng.integers(0, 7, size=int(rng.integers(0, 3)))] += rng.integers(-1, 2, size=2)
        balls.move(book)


def test_nulls_repeats_few_rows_and_clashing_names(spark):
    rng = random.Random(3)
    vectors = [[rng.choice([-1.0, -0.00001, 0.0, 0.5, 0.25]) for _ in range(10)] for _ in range(60)]
    rows = [(i // 2 if i % 7 else None, v) for i, v in enumerate(vectors)]
    bad = [(1, None), (2, [None] * 10), (3, [float("nan")] + [0.0] * 9), (4, [1.0]), (5, [])]
    df = spark.createDataFrame([(k, v, "c", "e", "l") for k, v in rows + bad],
                               "vec_id long, embedding array<double>, code string, error string, _vector string").repartition(4)
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, [math.floor(4096 * c) for c in r[1]]))
    want, digest = brute(ordered, parts=4, entries=5, rounds=3)
    books = train_codebooks(df, parts=4, entries=5, rounds=3)
    out = encode(df, books)
    assert out.columns == ["vec_id", "embedding", "_vector", "code", "error"] and books.digest() == digest
    key = lambda k, v: (-1 if k is None else k, tuple(v))
    assert sorted((key(r["vec_id"], r["embedding"]), r["code"], r["error"]) for r in out.collect()) == sorted(
        (key(k, v), c, e) for (k, v), (c, e) in zip(ordered, want))
    few = df.where("vec_id = 1 and _vector = 'l'")
    assert [r["error"] for r in encode(few, train_codebooks(few)).collect()] == [0] * few.where("embedding is not null").count()
    none = df.limit(0)
    assert encode(none, train_codebooks(none)).count() == 0


def test_numbers_beyond_longs_squared(spark):
    rows = [(i, [float((-1) ** i * 2.0 ** 40 * (i + 1))] * 8) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want, digest = brute(rows)
    books = train_codebooks(df)
    got = {r["vec_id"]: (r["code"], r["error"]) for r in encode(df, books).collect()}
    assert books.digest() == digest
    assert got == {i: (c, e if e < 1 << 63 else None) for (i, _), (c, e) in zip(rows, want)}


@pytest.mark.parametrize("few", [0, 100])
def test_label_errors_add_up_over_equal_labels_and_nulls(spark, few):
    rows = [(i, None if i % 5 == 0 else i % 3, i * 10) for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id long, label int, error long").withColumn("_label", F.lit("x"))
    got = with_label_error(df, few=few)
    assert got.columns == ["vec_id", "label", "error", "_label", "label_error"]
    sums = {}
    for _, label, error in rows:
        sums[label] = sums.get(label, 0) + error
    assert {(r["vec_id"], r["label_error"]) for r in got.collect()} == {(i, sums[label]) for i, label, _ in rows}
