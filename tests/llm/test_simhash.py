"""SimHash and its components against plain definitions."""

import random
import re

import numpy as np
import pytest
import xxhash

import shipgauge.llm.components as components_module
from shipgauge.llm.common import written
from shipgauge.llm.components import components
from shipgauge.llm.simhash import _Block, fingerprint, fingerprints, keep_one, near_duplicates, tile_links


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return f"{sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)):016x}"


def brute_groups(values, radius):
    """Smallest member reachable over pairs within ``radius`` bits, by plain search."""
    values = np.array(sorted(set(values)), np.uint64)
    near = [np.flatnonzero(np.bitwise_count(values ^ v) <= radius) for v in values]
    root = {}
    for i in range(len(values)):
        todo = [i]
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = i
                todo.extend(near[x].tolist())
    return {int(values[i]): int(values[r]) for i, r in root.items()}


def test_fingerprint_equals_the_definition():
    rng = random.Random(1)
    for text in [None, "", " \t\n", "One", "one TWO", "one two three", "é É A\x0bb\x1cc d", " nbsp one two three"]:
        assert fingerprint(text).hex() == brute_print(text), text
    for _ in range(200):
        text = " ".join(rng.choice(["a", "Bc", "é", "dd", "E"]) for _ in range(rng.randint(1, 40)))
        assert fingerprint(text).hex() == brute_print(text)


def test_links_connect_what_brute_force_connects(spark):
    rng = random.Random(9)
    values = [0, (1 << 64) - 1]
    for _ in range(300):
        at = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 12])):
            values.append(at)
            for _ in range(rng.randint(1, 3)):
                at ^= 1 << rng.randrange(64)
    signed = sorted({v - (1 << 64) if v >> 63 else v for v in values})
    links = tile_links(spark.createDataFrame([(v,) for v in signed], "print long"))
    for a, b in links.collect():
        assert a != b
    roots = {r.node % (1 << 64): r.root for r in components(links).collect()}
    want = brute_groups(values, 2)
    groups, expected = {}, {}
    for v in want:
        groups.setdefault(roots.get(v, ("alone", v)), set()).add(v)
        expected.setdefault(want[v], set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_dense_neighbourhood_stays_whole(spark, monkeypatch):
    monkeypatch.setattr("shipgauge.llm.simhash.BASE_BLOCK", 16)
    monkeypatch.setattr("shipgauge.llm.simhash.PROBE_BLOCK", 32)
    rng = random.Random(3)
    values = {0}
    while len(values) < 900:
        values.add(rng.choice(sorted(values)) ^ (1 << rng.randrange(20)))
    links = tile_links(spark.createDataFrame([(v,) for v in values], "print long"))
    assert {r.root for r in components(links).collect()} == {0}


def chained(rng, chains, length):
    """Chains of fingerprints of one tile: each step swaps two bits of a quarter."""
    values = set()
    for _ in range(chains):
        at = sum(sum(1 << b for b in rng.sample(range(16), 8)) << 16 * q for q in range(4))
        for _ in range(length):
            values.add(at)
            q = 16 * rng.randrange(4)
            on, off = ([b for b in range(q, q + 16) if at >> b & 1 == x] for x in (1, 0))
            at ^= 1 << rng.choice(on) | 1 << rng.choice(off)
    return values


def test_no_batch_of_probes_undoes_an_earlier_one():
    # a path of steps of two bits; P joins 2 and 3 first, then A and B pull them to different bases
    b1, a, b3, p, b2, b, b0 = (np.uint64((1 << 2 * k) - 1) for k in range(7))
    block = _Block(2)
    block.add(np.array([b0, b1, b2, b3], np.uint64))
    block.compare(np.array([p], np.uint64))
    block.compare(np.array([a, b], np.uint64))
    assert block.group.tolist() == [0, 0, 0, 0]


def test_chains_over_many_batches_of_probes_stay_whole():
    rng = random.Random(6)
    for _ in range(5):
        values = sorted(chained(rng, 6, 400))
        rng.shuffle(values)
        prints, block = np.array(values, np.uint64), _Block(2)
        bases = prints[:1000]
        block.add(bases)
        links = [block.compare(prints), block.close()]
        pairs = {(int(x), int(y)) for a, b in links for x, y in zip(a, b, strict=True)}
        # what plain search connects through pairs of a base and a probe, and nothing else
        near = [np.flatnonzero((np.bitwise_count(bases ^ v) <= 2) & (bases != v)) for v in prints]
        assert _groups(pairs) == _groups({(int(v), int(bases[k])) for v, found in zip(prints, near, strict=True) for k in found})


def _groups(pairs):
    edges, seen, out = {}, set(), []
    for a, b in pairs:
        edges.setdefault(a, set()).add(b)
        edges.setdefault(b, set()).add(a)
    for v in edges:
        if v not in seen:
            todo, group = [v], set()
            while todo:
                x = todo.pop()
                if x not in group:
                    group.add(x)
                    todo.extend(edges[x])
            seen |= group
            out.append(sorted(group))
    return sorted(out)


def test_components_of_paths_cycles_and_stars(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(-5, 7000), (7000, -9), (8, 8)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(301)) and all(got[1000 + i] == 1000 for i in range(200))
    assert got[-5] == got[7000] == got[-9] == -9
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("order", ["sorted", "reversed", "random", "zigzag", "bits"])
def test_components_of_a_long_path_take_few_steps(spark, monkeypatch, order):
    n = 1600
    names = {"sorted": list(range(n)), "reversed": list(range(n))[::-1], "random": random.Random(1).sample(range(n), n),
             "zigzag": [i // 2 if i % 2 else n - 1 - i // 2 for i in range(n)],
             "bits": sorted(range(n), key=lambda i: f"{i:011b}"[::-1])}[order]
    steps = []
    monkeypatch.setattr(components_module, "written", lambda df, name: steps.append(name) or written(df, name))
    links = spark.createDataFrame(list(zip(names, names[1:])), "a long, b long")
    got = components(links).collect()
    assert sorted(r.node for r in got) == list(range(n)) and {r.root for r in got} == {0}
    assert steps.count("links") - 1 < 12 and steps.count("hooked") < 40  # rounds, and steps of all rounds


def test_components_of_random_graphs(spark):
    rng = random.Random(12)
    links = [(rng.randrange(3000), rng.randrange(3000)) for _ in range(1800)] + [(None, 4), (5, None)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    groups = _groups({(a, b) for a, b in links if a is not None and b is not None and a != b})
    for group in groups:
        assert {got[v] for v in group} == {group[0]}
    assert all(got[a] == a for a, b in links if a == b and not any(a in g for g in groups))


def test_clashing_names_of_helpers(spark):
    names = ("_key", "_text", "_none", "_print", "component_print", "print", "root")
    df = spark.createDataFrame([(1, "a b c d", *"1234567"), (2, "a b c d", *"1234567")], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    kept = keep_one(df).collect()
    assert kept == df.where("doc_id = 1").collect()
    out = near_duplicates(fingerprints(df))
    assert all(r[n] == str(i) for r in out.collect() for i, n in enumerate(names, start=1) if n != "component_print")


def test_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r for r in near_duplicates(fingerprints(docs, keep=["doc_id"])).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    prints = {r.doc_id: brute_print(r.text) if len(r.text) < 3000 else fingerprint(r.text).hex() for r in rows}
    want = brute_groups([int(p, 16) for p in prints.values()], 2)
    least = {}
    for d in sorted(prints):
        least.setdefault(want[int(prints[d], 16)], d)
    for d, p in prints.items():
        assert got[d].fingerprint == p and got[d].component_id == least[want[int(p, 16)]]


def test_nulls_repeats_clashes_and_empty_tables(spark):
    rows = [(3, None, 1), (2, "", 1), (2, "", 1), (None, " ", 1), (7, "Same words here now", None), (9, "same WORDS here now", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = near_duplicates(fingerprints(docs)).collect()
    assert len(got) == 6
    assert all(r.component_id == 2 and r.fingerprint == "0" * 16 for r in got if r.doc_id in (None, 2, 3))
    assert {r.component_id for r in got if r.doc_id in (7, 9)} == {7}
    assert near_duplicates(fingerprints(docs.limit(0))).count() == 0
