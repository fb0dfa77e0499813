"""Packing: exact cuts, capacity, little padding, and the tokenizer wrapper."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from shipgauge.llm.packing import knapsack, pack, pack_documents, solve_patterns
from shipgauge.llm.tokenise import Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_encoder_equals_the_tokenizer_on_odd_texts(tokenizer):
    encode, rng = Encoder(PATH).encode, random.Random(3)
    parts = ["a", "B", "é", "é", "ß", "İ", "Σ", "σ", "½", "²", "1", "23", "'s", "'LL", "don't", "!", "?!", "..", " ",
             "  ", "\x1c", "\u0085", " ", "\n", "\t", "日本", "привет", "<|endoftext|>", "_", "-", "́", "​", "😀"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_knapsack_equals_exhaustive_search():
    rng = random.Random(5)
    for _ in range(50):
        units = np.array(sorted(rng.sample(range(1, 12), 3)))
        values = np.array([rng.random() for _ in units])
        best = max((a * values[0] + b * values[1] + c * values[2])
                   for a in range(21) for b in range(21) for c in range(21)
                   if a * units[0] + b * units[1] + c * units[2] <= 20)
        worth, counts = knapsack(values, units, 20)
        assert abs(worth - best) < 1e-9 and abs(counts @ values - best) < 1e-9 and counts @ units <= 20


def test_patterns_cover_the_demand_and_come_near_the_bound():
    rng = np.random.default_rng(1)
    units, counts = np.unique(rng.integers(1, 257, 20000), return_counts=True)
    plan = solve_patterns(dict(zip(units.tolist(), counts.tolist())), 256)
    covered = sum(p * t for p, t, _ in plan)
    assert (covered >= counts).all() and all(p @ u <= 256 for p, _, u in plan)
    assert sum(t for _, t, _ in plan) <= (units @ counts) / 256 * 1.02 + 5


def check_places(rows, size=2048):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return by


def test_pieces_rebuild_every_document(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = pack_documents(docs, PATH).collect()
    by = check_places(rows)
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert set(pieces) == set(texts)
    for doc_id, text in texts.items():
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    total = sum(r.length for r in rows)
    assert len(by) * 2048 - total <= 0.05 * total + 2048


def test_nulls_empties_repeats_and_clashing_columns(spark):
    rows = [(1, None, 9), (1, None, 9), (None, "", 9), (2, "a b c", 9), (2, "a b c", 9), (3, "word " * 9000, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id int")
    got = pack_documents(docs, PATH).collect()
    check_places(got)
    assert sum(r.doc_tokens == 1 and r.length == 1 for r in got) == 3
    assert sorted(r.length for r in got if r.doc_id == 2) == [4, 4]
    assert sum(r.length for r in got if r.doc_id == 3) == 9001
    assert pack_documents(docs.limit(0), PATH).count() == 0


def test_one_class_holds_most_pieces(spark):
    pieces = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(0).alias("start"),
                                      F.when(F.col("id") < 4000, 700).otherwise(300 + F.col("id") % 900).cast("long").alias("length"))
    rows = pack(pieces).collect()
    assert len(rows) == 5000
    check_places(rows)
