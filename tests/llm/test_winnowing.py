"""Winnowing against a direct reading of its definition."""

import hashlib
import random

import numpy as np

from shipgauge.llm.winnowing import GRAM, WINDOW, compare_with_edited, fingerprints, gram_hashes, winnow


def brute(text):
    hashes = gram_hashes(np.frombuffer(text.encode("utf-32-le"), np.uint32)).tolist()
    if not text:
        return []
    chosen, w = [], min(WINDOW, len(hashes))
    for a in range(len(hashes) - w + 1):
        best = min(range(a, a + w), key=lambda i: (hashes[i], -i))
        if not chosen or chosen[-1] != best:
            chosen.append(best)
    return [(hashes[i], i) for i in chosen]


def test_equals_the_definition_with_ties():
    rng = random.Random(2)
    for _ in range(400):
        text = "".join(rng.choice("abé ") for _ in range(rng.randint(0, 120))) * rng.randint(1, 3)
        h, p = winnow(text)
        assert list(zip(h.tolist(), p.tolist())) == brute(text)


def test_grams_hash_alike_wherever_they_stand():
    text = "the same sixteen points" + "x" * 9 + "the same sixteen points"
    hashes = gram_hashes(np.frombuffer(text.encode("utf-32-le"), np.uint32))
    assert hashes[0] == hashes[32] and len(hashes) == len(text) - GRAM + 1


def test_shared_run_shares_a_hash():
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    for _ in range(200):
        shared = word(GRAM + WINDOW - 1)
        a, b = word(rng.randint(0, 50)) + shared + word(40), word(rng.randint(0, 50)) + shared + word(40)
        assert set(winnow(a)[0].tolist()) & set(winnow(b)[0].tolist())


def expected(rows):
    """Rows by descending id, each with the next one's text."""
    rows = sorted(rows, key=lambda r: -r[0])
    return {k: (t or "", (rows[(i + 1) % len(rows)][1]) or "") for i, (k, t) in enumerate(rows)}


def test_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = expected([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = compare_with_edited(docs).collect()
    assert len(got) == len(want) and {r.doc_id for r in got} == set(want)
    for r in got:
        text, nxt = want[r.doc_id]
        edited = text[:len(text) - len(text) // 3] + nxt[:len(text) // 3]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = ({h for h, _ in brute(x)} if len(x) < 900 else set(winnow(x)[0].tolist()) for x in (text, edited, nxt))
        assert abs(r.near_edited - (len(a & b) / len(a | b) if a | b else 1)) < 1e-12
        assert abs(r.near_next - (len(a & c) / len(a | c) if a | c else 1)) < 1e-12


def test_edge_cases(spark):
    schema = "doc_id long, text string, hashes string"
    one = spark.createDataFrame([(5, "abcdef", "x")], schema)
    r = compare_with_edited(one).collect()
    assert len(r) == 1 and r[0].edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and r[0].near_next == 1
    rows = [(3, None, "x"), (2, "", "x"), (1, "aaaaaa", None), (1, "aaaaaa", None), (None, "zz", None)]
    docs = spark.createDataFrame(rows, schema)
    got = compare_with_edited(docs).collect()
    assert len(got) == 5 and sum(x.n_chars == 0 for x in got) == 2
    assert len({x.fingerprint for x in got if x.doc_id == 1}) == 1
    assert compare_with_edited(docs.limit(0)).count() == 0
    assert [len(x.hashes) for x in fingerprints(docs).orderBy("doc_id").collect()] == [1, 1, 1, 0, 0]
