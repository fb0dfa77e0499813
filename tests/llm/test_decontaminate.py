"""Decontamination against edit distance to all substrings."""

import random

from pyspark.sql import functions as F

from shipgauge.llm import decontaminate
from shipgauge.llm.decontaminate import Item, Matcher, find_items, normalised, pieces


def brute_distance(item, text):
    """Least edit distance of ``item`` to any substring of ``text``."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def words(rng, n):
    return " ".join("".join(rng.choice("abcde") for _ in range(rng.randint(1, 6))) for _ in range(n))


def edited(rng, text, n):
    for _ in range(n):
        at = rng.randrange(len(text))
        text = rng.choice([text[:at] + text[at + 1:], text[:at] + rng.choice("abc") + text[at:], text[:at] + "z" + text[at + 1:]])
    return text


def test_myers_equals_the_table():
    rng = random.Random(1)
    for _ in range(300):
        item, text = words(rng, rng.randint(1, 12)), words(rng, rng.randint(1, 15))
        assert Item(0, item).nearest(text)[0] == min(brute_distance(item, text), len(item))


def test_pieces_are_exact_and_one_more_than_the_budget():
    assert "".join(p for p, _ in pieces("abcdefghij", 3)) == "abcdefghij" and len(pieces("abcdefghij", 3)) == 4


def test_every_match_within_the_budget_is_found_and_no_other():
    rng = random.Random(2)
    items = [(i, words(rng, rng.randint(3, 40))) for i in range(25)]
    matcher = Matcher(items)
    for _ in range(120):
        i, text = rng.choice(items)
        budget = len(text) // decontaminate.CHARS_PER_ERROR
        doc = words(rng, 20) + " " + edited(rng, text, rng.randint(0, budget + 2)).upper() + "\n " + words(rng, 20)
        got = {x: d for x, d, _ in matcher.matches(doc)}
        plain = normalised(doc)
        want = {j: brute_distance(normalised(t), plain) for j, t in items}
        assert got == {j: d for j, d in want.items() if d <= len(normalised(items[j][1])) // decontaminate.CHARS_PER_ERROR}


def test_blocks_give_the_same(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    one = {r.doc_id: r.hits for r in find_items(docs, bench, keep=["doc_id"]).collect()}
    items = {r.item_id: normalised(r.text) for r in bench.collect()}
    exact = {r.doc_id: {i for i, t in items.items() if t in normalised(r.text)} for r in docs.select("doc_id", "text").collect()}
    assert all({h.item_id for h in one[d] if h.distance == 0} == found for d, found in exact.items())
    assert sum(map(bool, exact.values())) > 10
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 9000)
    plan = find_items(docs, bench, keep=["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1  # earlier blocks were written
    many = {r.doc_id: r.hits for r in find_items(docs, bench, keep=["doc_id"]).collect()}
    assert one == many


def test_nulls_repeats_clashes_and_empty_tables(spark):
    item = "a passage of some length that is in a test set"
    bench = spark.createDataFrame([(7, item), (8, item), (None, None), (9, ""), (10, "  "), (11, "tiny")], "item_id long, text string")
    rows = [(1, None, 0), (2, "", 0), (3, f"x {item.upper()} y", 0), (3, f"x {item.upper()} y", 0), (None, "tiny", 0), (5, "long " * 40000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hits int")
    got = find_items(docs, bench).select("doc_id", F.transform("hits", lambda h: h["item_id"]).alias("i")).collect()
    assert sorted((r.doc_id or 0, r.i) for r in got) == [(0, [11]), (1, []), (2, []), (3, [7, 8]), (3, [7, 8]), (5, [])]
    assert find_items(docs.limit(0), bench).count() == 0
    assert all(not r.hits for r in find_items(docs, bench.limit(0)).collect())
