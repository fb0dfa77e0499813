"""Quality classifier: vectors against plain sums, held-out accuracy, edge cases."""

from zlib import crc32

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shipgauge.llm.common import split_remainder
from shipgauge.llm.queries import op2_quality
from shipgauge.llm.quality import (DIMENSIONS, REACH, ROWS, Reader, corpus_vectors, fit, index_vectors, score_quality, shape_of,
                                   train)

SF = "/root/testdata/sf0.01"


def test_shapes():
    assert [shape_of(x) for x in ("Thre***", "ERHE!!", "|", "", "a1B")] == ["Aa*", "A!", "|", "", "a0A"]


def test_corpus_vectors_equal_plain_sums(spark):
    texts = ["a b a c", "b", "", None, "c C! a\na", "a b a c"]
    got = corpus_vectors(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    index, reader, want = index_vectors().astype(float), Reader(), np.zeros((ROWS, DIMENSIONS))
    for t in texts:
        words, shapes, _ = reader.read([t])
        for i in range(len(words)):
            for j in range(max(0, i - REACH), min(len(words), i + REACH + 1)):
                if i != j:
                    near = index[words[j]] + index[shapes[j]]
                    want[words[i]] += near
                    want[shapes[i]] += near
    norm = np.linalg.norm(want, axis=1, keepdims=True)
    want = np.divide(want, norm, out=np.zeros_like(want), where=norm > 0)
    assert np.abs(got - want).max() < 1e-5


def test_network_learns_and_is_calibrated():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5))
    y = (x[:, 0] * x[:, 1] + rng.normal(size=3000) * 0.1 > 0).astype(float)
    net = fit(x[:2400], y[:2400])
    p = net.score(x[2400:])
    assert ((p > 0.5) == y[2400:]).mean() > 0.85
    sure = np.maximum(p, 1 - p)
    assert abs(sure.mean() - ((p > 0.5) == y[2400:]).mean()) < 0.08


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = train(docs, labels)
    rows = (score_quality(docs, model, keep=["doc_id"]).filter(split_remainder("doc_id", 5) == 0)
            .join(labels, "doc_id").select("quality", (F.col("score") >= 0.3).cast("int").alias("p")).collect())
    assert len(rows) > 30 and sum(r.quality == r.p for r in rows) >= 0.95 * len(rows)


@pytest.mark.parametrize("labelled", [[], [(1, 1), (2, 1)], [(None, 1), (1, None)], [(i % 9, i % 2) for i in range(40)]])
def test_nulls_repeats_clashes_and_few_labels(spark, labelled):
    rows = [(1, None, "x"), (2, "", "x"), (2, "", "x"), (None, "a b", None), (4, "word " * 50000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame(labelled, "doc_id long, quality int")
    got = score_quality(docs, train(docs, labels)).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert score_quality(docs.limit(0), train(docs.limit(0), labels)).count() == 0


def plain_rows(chunk):
    word = chunk.strip(".,;:!?()\"'").lower()
    return 512 + xxhash.xxh32_intdigest(word) % (ROWS - 512), xxhash.xxh32_intdigest(shape_of(chunk)) % 512


def plain_features(chunks, vectors, index):
    """Means of vectors and how index vectors repeat, word by word."""
    out = np.zeros(2 * DIMENSIONS + 4)
    if chunks:
        rows, n = [plain_rows(c) for c in chunks], len(chunks)
        out[:DIMENSIONS] = sum(vectors[w] for w, _ in rows) / n
        out[DIMENSIONS:2 * DIMENSIONS] = sum(vectors[s] for _, s in rows) / n
        out[-4] = (((sum(index[w] for w, _ in rows) / n) ** 2).sum()) / 6
        out[-3] = (((sum(index[s] for _, s in rows) / n) ** 2).sum()) / 6
        out[-2] = sum(a[0] == b[0] for a, b in zip(rows, rows[1:])) / n
        out[-1] = np.log1p(n)
    return out


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: (r.text or "").split() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    index, vectors = index_vectors().astype(float), np.zeros((ROWS, DIMENSIONS))
    for chunks in docs.values():
        rows = [plain_rows(c) for c in chunks]
        own = [index[w] + index[s] for w, s in rows]
        for i, (w, s) in enumerate(rows):
            for j in range(max(0, i - REACH), min(len(rows), i + REACH + 1)):
                if i != j:
                    vectors[w] += own[j]
                    vectors[s] += own[j]
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = np.divide(vectors, norm, out=np.zeros_like(vectors), where=norm > 0)
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    learn = [(i, y) for i, y in labels if crc32(str(i).encode()) % 5 and y is not None and i in docs]
    place = lambda i: np.array([xxhash.xxh64_intdigest(np.int64(i).tobytes(), 42)], np.uint64).view(np.int64)[0]
    learn.sort(key=lambda r: (place(r[0]), r[1]))
    net = fit(np.array([plain_features(docs[i], vectors, index) for i, _ in learn]), np.array([y for _, y in learn], float))
    got = {r.doc_id: r for r in op2_quality(spark, sf).collect()}
    assert got.keys() == docs.keys()
    apart = []
    for i, chunks in docs.items():
        x = (plain_features(chunks, vectors, index) - net.mean) / net.scale
        hidden = [np.tanh(sum(a * b for a, b in zip(x, col)) + c) for col, c in zip(net.w1.T, net.b1)]
        z = (sum(a * b for a, b in zip(hidden, net.w2)) + net.b2) / net.temperature
        apart.append(abs(got[i].score - 1 / (1 + np.exp(-z))))
        assert got[i].predicted == int(got[i].score >= 0.3) and got[i].held_out == (crc32(str(i).encode()) % 5 == 0)
    assert max(apart) < 1e-2  # features are single precision in the query, double here


def test_words_are_remembered_up_to_a_number_of_bytes():
    from shipgauge.llm.common import Remembered

    calls = []
    known = Remembered(lambda w: calls.append(w) or len(w), budget=2000)
    words = [f"w{i}" for i in range(100)] + ["x" * 1_000_000]
    assert [known[w] for w in words * 2] == [len(w) for w in words * 2]
    assert 5 < len(known) < 20 and max(map(len, known)) <= 64 and len(calls) == 202 - len(known)
