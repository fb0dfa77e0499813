"""Toxicity grammar: composition against running the parts in turn, clause scores, held-out accuracy."""

import random
from math import log, log1p
from zlib import crc32

import numpy as np
from pyspark.sql import functions as F

from shipgauge.llm.common import split_remainder
from shipgauge.llm.queries import op5_toxicity
from shipgauge.llm.toxicity import (_TOKEN, INSULT, LISTED, NEGATION, OTHER, REPORT, TARGET, THREAT, Scorer, clause_score, grammar, insults,
                                    negation, reported, score_toxicity, targets, threats, train)

SF = "/root/testdata/sf0.1"


def in_turn(symbols, weights=None):
    """Weights times factors of the symbols that end as insults or threats, one transducer after another."""
    factors, final = list(weights or [1.0] * len(symbols)), 1.0
    for part in (negation(), reported(), insults(), threats(), targets()):
        state, out = 0, []
        for i, s in enumerate(symbols):
            state, s, f = part.step(state, s)
            factors[i] *= f
            out.append(s)
        final *= part.end(state)
        symbols = out
    return sum(f for f, s in zip(factors, symbols) if s in (INSULT, THREAT, 6, 7)) * final


def test_composition_equals_the_parts_in_turn():
    rng, machine = random.Random(4), grammar()
    for _ in range(3000):
        symbols = [rng.choice([OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT]) for _ in range(rng.randint(0, 9))]
        assert abs(clause_score(machine, [(s, 1.0) for s in symbols]) - in_turn(symbols)) < 1e-9


def test_clauses_weigh_context():
    score = lambda t: sum(Scorer({}).clauses(t)[0])
    plain = score("what an idiot")
    assert score("you are an idiot") > plain > score("you are not an idiot") > 0
    assert plain > score("he said idiot") > 0 and score("idiot moron") > 2 * plain
    assert score("they will kill you") > score("kill the process") > 0
    assert score("not now. idiot") == plain and score("nothing here") == 0


def test_listed_words_keep_their_part_when_learnt():
    score = lambda t: sum(Scorer({"kill": 4.0, "kill*": 4.0, "zog": 4.0, "neve*": 4.0}).clauses(t)[0])
    assert abs(score("kill the process") - 0.4) < 1e-9 and abs(score("they will kill")) == 4
    assert abs(score("kills the process") - 0.4) < 1e-9 and score("zog") == 4 and score("never") == 0


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = train(docs, labels)
    rows = (score_toxicity(docs, model, keep=["doc_id"]).filter(split_remainder("doc_id", 3) == 1)
            .join(labels, "doc_id").select("toxic", (F.col("score") >= 0.7).cast("int").alias("p")).collect())
    hit = sum(r.toxic and r.p for r in rows)
    assert hit >= 0.85 * sum(r.toxic for r in rows) and hit >= 0.95 * sum(r.p for r in rows)


def test_scores_follow_the_labels_share_beyond_the_sample(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "plain words here") for i in range(1500)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(1500)], "doc_id long, toxic int")
    share = labels.filter(split_remainder("doc_id", 3) != 1).agg(F.avg("toxic")).head()[0]
    scores = []
    for sample in (10_000, 300, 40):  # none cut, clean ones cut, both cut
        monkeypatch.setattr("shipgauge.llm.toxicity.SAMPLE", sample)
        scores.append(score_toxicity(docs.limit(1), train(docs, labels)).head().score)
    assert all(abs(s - share) < 0.01 for s in scores), scores


def test_nulls_repeats_clashes_and_few_labels(spark):
    rows = [(1, None, "x"), (2, "", "x"), (2, "", "x"), (None, "you idiot", None), (4, "word, " * 50000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    for labelled in ([], [(1, 0)], [(None, 1), (2, None)], [(i, i % 2) for i in range(30)]):
        labels = spark.createDataFrame(labelled, "doc_id long, toxic int")
        got = score_toxicity(docs, train(docs, labels)).collect()
        assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert score_toxicity(docs.limit(0), train(docs.limit(0), labels)).count() == 0


def plain_keys(text):
    words = {w for w in _TOKEN.findall((text or "").lower()) if w not in ".!?;:\n"}
    return words | {w[:n] + "*" for w in words for n in (4, 5, 6, 7, 8) if len(w) > n}


def plain_weights(rows):
    """Weights from (text, label) rows, key by key."""
    toxic, clean = ([plain_keys(t) for t, y in rows if y == c] for c in (1, 0))
    n, m = {}, {}
    for count, texts in ((n, toxic), (m, clean)):
        for keys in texts:
            for k in keys:
                count[k] = count.get(k, 0) + 1
    considered = {k for k in n if n[k] >= max(3, 0.01 * len(toxic))}
    share, out = len(toxic) / len(rows), {}
    for k in considered:
        a, b = n[k], m.get(k, 0)
        weight, q = log((a + 0.5) / (len(toxic) + 1)) - log((b + 0.5) / (len(clean) + 1)), a / (a + b)
        surprise = a * log(q / share) + (b * log((1 - q) / (1 - share)) if b else 0) if q > share else 0
        if surprise > log(len(considered) / 0.01) and weight > 2:
            out[k] = weight
        elif k in LISTED and weight <= 0:
            out[k] = 0.0
    return out


def plain_figures(text, weights):
    clauses, total = [[]], 0
    for token in _TOKEN.findall((text or "").lower()):
        if token in ".!?;:\n":
            clauses.append([])
            continue
        total += 1
        learnt = max([weights[k] for k in plain_keys(token) if k in weights], default=0.0)
        symbol = LISTED.get(token, INSULT if learnt > 0 else OTHER)
        clauses[-1].append((symbol, (learnt or weights.get(token, 3.0)) if symbol in (INSULT, THREAT) else 0.0))
    scored = [in_turn([s for s, _ in c], [w for _, w in c]) for c in clauses if any(s in (INSULT, THREAT) for s, _ in c)]
    return [max(scored, default=0.0), log1p(sum(scored)), log1p(len(scored)), log1p(total) if scored else 0.0, 1.0]


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    labels = [(r.doc_id, r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    learn = [(docs[i], y) for i, y in labels if crc32(str(i).encode()) % 3 != 1 and y is not None and i in docs]
    weights = plain_weights(learn)
    assert len(weights) > 3
    x, y = np.array([plain_figures(t, weights) for t, _ in learn]), np.array([c for _, c in learn], float)
    w, ridge = np.zeros(5), np.array([0.1, 0.1, 0.1, 0.1, 0.01])
    for _ in range(200):  # the curve's penalised likelihood climbed with halved Newton steps
        p = 1 / (1 + np.exp(-x @ w))
        w -= 0.5 * np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + np.diag(ridge), x.T @ (p - y) + ridge * w)
    got = {r.doc_id: r for r in op5_toxicity(spark, sf).collect()}
    assert got.keys() == docs.keys()
    for i, text in docs.items():
        score = 1 / (1 + np.exp(-np.clip(np.array(plain_figures(text, weights)) @ w, -30, 30)))
        assert abs(got[i].score - score) < 1e-6 and got[i].predicted == int(got[i].score >= 0.7), i
        assert got[i].held_out == (crc32(str(i).encode()) % 3 == 1)


def test_more_words_than_fit_a_list(spark):
    """Every toxic text brings tens of thousands of keys; none is refused, the telling one is learnt."""
    words = " ".join(f"{a}{b}{c}{d}" for a in "bcdf" for b in "aeiouy" for c in "lmnprstvwz" for d in "aeiouklmnp")
    rows = [(i, words + (" zorgling" if i % 2 else " plain")) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = train(docs, spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int"))
    assert set(model.weights) == {"zorgling", *("zorgling"[:n] + "*" for n in (4, 5, 6, 7))}
    long = spark.createDataFrame([("x" * 1_000_000 + " zorgling",)] * 3, "text string")
    assert len({r.score for r in score_toxicity(long, model).collect()}) == 1
