"""Repeated passages against a plain dictionary of all windows."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from shipgauge.llm import queries
from shipgauge.llm.repeats import NO_KEY, digest, find_repeats, tree_nodes, word_hashes, words_of

SF = "/root/testdata/sf0.001"


def brute(rows, window=13):
    first, out = {}, []
    split = [(NO_KEY if k is None else k, (t or "").encode().split()) for k, t in rows]
    for k, words in split:
        for at in range(len(words) - window + 1):
            passage = tuple(words[at:at + window])
            first[passage] = min(first.get(passage, k), k)
    for k, words in split:
        gone = [False] * len(words)
        for at in range(len(words) - window + 1):
            if first[tuple(words[at:at + window])] < k:
                gone[at:at + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((k, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(df, **kw):
    return sorted((NO_KEY if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"])
                  for r in digest(find_repeats(df, **kw)).collect())


def test_query_equals_brute_force_on_the_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op12_repeats(spark, SF)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    want = brute(rows)
    assert sorted(tuple(r) for r in got.collect()) == want and any(w[2] for w in want)


def _rows():
    rng = random.Random(3)
    kinds, rows = ["a", "b", "c", "Dd", "é", "x y"], []
    for i in range(300):
        if rows and rng.random() < 0.5:
            text = " ".join((rng.choice(rows)[1] or "").split(" ")[rng.randint(0, 5):]) + " " + rng.choice(kinds)
        else:
            text = rng.choice(["", "\n", "\t "]) + " ".join(rng.choice(kinds) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice([i, i // 2, None]) if rng.random() < 0.2 else i, text if rng.random() > 0.02 else None))
    rows += [rows[5], rows[5], (1000, "a " * 3000), (1001, "a\t" * 40 + "b"), (1002, "x " * 12), (1003, ""), (1004, "y\x0b\x0cz\r" * 7)]
    return rows


@pytest.mark.parametrize("kw", [{}, {"group": 3}, {"block": 1}, {"group": 0}, {"window": 4}, {"window": 2, "group": 5}])
def test_random_texts_whatever_the_group_and_block_sizes(spark, kw):
    rows = _rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert found(df, **kw) == brute(rows, kw.get("window", 13))


def test_empty_table_clashing_names_and_kept_words(spark):
    names = ("kept", "n_words", "n_removed", "_text", "_row", "_key", "_few", "_many", "_marks")
    text = " ".join(f"w{i}" for i in range(20))
    df = spark.createDataFrame([(1, text, *"123456789"), (2, f"one {text}\n two", *"123456789")],
                               "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    out = find_repeats(df)
    assert out.columns == ["doc_id", "text", *names[3:], "kept", "n_words", "n_removed"]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert (rows[1]["kept"], rows[1]["n_removed"]) == (text, 0)
    assert (rows[2]["kept"], rows[2]["n_words"], rows[2]["n_removed"]) == ("one two", 22, 20)
    assert all(rows[2][n] == str(i) for i, n in enumerate(names, start=1) if i > 3)
    assert find_repeats(df.limit(0)).count() == 0


def test_words_and_hashes():
    texts = ["  a b\tc\x0bd\x0ce\r\nf\x1cg ", "", " ", "a"]
    number, kinds, counts = words_of(pa.array(texts))
    assert [kinds[int(i)].as_py() for i in number] == ["a", "b", "c", "d", "e", "f\x1cg", "a"] and counts.tolist() == [6, 0, 0, 1]
    long = pa.array(["", "a", "b", "ab", "ba", "é", "x" * 70_000, "x" * 70_001])
    hashes = word_hashes(long)
    assert len(set(hashes.tolist())) == len(long)
    assert (word_hashes(long.slice(2, 4)) == hashes[2:6]).all()
    assert len(word_hashes(long.slice(0, 0))) == 0


def test_tree_nodes_are_equal_for_equal_words_only():
    rng = random.Random(1)
    rows = [" ".join(rng.choice("ab") for _ in range(rng.randint(5, 9))) for _ in range(50)]
    row, offset, node = tree_nodes(pa.array(rows), 5)
    words = [tuple(rows[r].split(" ")[o:o + 5]) for r, o in zip(row.tolist(), offset.tolist())]
    assert len(words) == sum(len(r.split(" ")) - 4 for r in rows)
    by_node = {}
    for w, n in zip(words, node.tolist()):
        by_node.setdefault(n, set()).add(w)
    assert all(len(s) == 1 for s in by_node.values()) and len(by_node) == len(set(words))
    assert np.all(np.bincount(node) >= 0)
