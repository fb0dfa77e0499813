"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols: insult, threat, target, negation, report, other. Five
transducers rewrite and weigh a clause's symbols one after another; composed,
they are one deterministic transducer. Negation and reported speech weaken the
insults and threats they govern, insults in a row add up, and a target that an
insult or a threat meets strengthens the clause. A text's clause scores give
its score through a fitted logistic curve.

Insults are learnt: words and word beginnings that labelled toxic texts have
significantly more often than clean ones, weighted by their log-odds.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Remembered, add_columns, split_remainder, summarise, unused, written

SAMPLE = 10_000        # labelled rows of each class that are learnt from, at most
SUPPORT = 0.01         # of the toxic sample texts must have a word for it to be considered
CERTAINTY = 0.01       # chance that any of the words considered is learnt by accident
BEGINNINGS = (4, 5, 6, 7, 8)  # lengths of word beginnings that may be learnt
THRESHOLD = 0.7
SEED_WEIGHT = 3.0      # of a listed word that the labels say nothing about
FIGURES = 4

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, WEAK_INSULT, WEAK_THREAT = range(8)

# The grammar's words.
_LISTED = {
    INSULT: "idiot idiots moron morons imbecile scumbag bastard asshole bitch dumbass arschloch idiotin trottel wichser "
            "connard connasse salaud imbécile gilipollas imbécil cabrón pendejo",
    THREAT: "kill kills murder strangle stab shoot hang töten umbringen erschießen tuer égorger étrangler matar "
            "apuñalar estrangular",
    TARGET: "you your yours u they them those he she him her du dich dir ihr euch sie tu toi te vous ils eux tú ti usted "
            "ustedes ellos ellas",
    NEGATION: "not no never neither nor isn aren wasn don doesn didn cannot without nicht kein keine nie niemals ohne ne "
              "pas jamais sans ni nunca jamás sin",
    REPORT: "said says say saying claimed claims wrote writes quoted quote called reported alleged sagte schrieb "
            "behauptete zitierte dit disait écrit prétend cité dijo dice escribió afirmó citó",
}
LISTED = {w: symbol for symbol, words in _LISTED.items() for w in words.split()}

_TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n]")


@dataclass
class Transducer:
    """Deterministic: ``arcs[state, symbol]`` is (next state, symbol out, factor); ``final[state]`` a factor.

    A symbol without an arc passes unchanged, with factor 1, in the same state.
    """

    arcs: dict = field(default_factory=dict)
    final: dict = field(default_factory=dict)

    def step(self, state, symbol):
        return self.arcs.get((state, symbol), (state, symbol, 1.0))

    def end(self, state):
        return self.final.get(state, 1.0)


def negation(reach: int = 3, left: float = 0.25) -> Transducer:
    """Insults and threats up to ``reach`` words after a negation become weak."""
    arcs = {}
    for k in range(reach + 1):
        arcs[k, NEGATION] = (reach, OTHER, 1.0)
        if k:
            arcs[k, INSULT], arcs[k, THREAT] = (k - 1, WEAK_INSULT, left), (k - 1, WEAK_THREAT, left)
            arcs[k, OTHER], arcs[k, TARGET], arcs[k, REPORT] = (k - 1, OTHER, 1.0), (k - 1, TARGET, 1.0), (k - 1, REPORT, 1.0)
    return Transducer(arcs)


def reported(left: float = 0.4) -> Transducer:
    """Insults and threats after a word of reporting become weak until the clause ends."""
    return Transducer({(0, REPORT): (1, OTHER, 1.0), (1, REPORT): (1, OTHER, 1.0), (1, INSULT): (1, WEAK_INSULT, left),
                       (1, THREAT): (1, WEAK_THREAT, left), (1, WEAK_INSULT): (1, WEAK_INSULT, left),
                       (1, WEAK_THREAT): (1, WEAK_THREAT, left)})


def insults(more: float = 0.3) -> Transducer:
    """Every insult after a clause's first strong one counts ``more`` on top."""
    return Transducer({(0, INSULT): (1, INSULT, 1.0), (1, INSULT): (1, INSULT, 1.0 + more)})


def threats(alone: float = 0.1, aimed: float = 1.0) -> Transducer:
    """A threat counts in full only if a target has come before it in the clause."""
    return Transducer({(0, TARGET): (1, TARGET, 1.0), (0, THREAT): (0, THREAT, alone), (1, THREAT): (1, THREAT, aimed),
                       (0, WEAK_THREAT): (0, WEAK_THREAT, alone), (1, WEAK_THREAT): (1, WEAK_THREAT, alone)})


def targets(stronger: float = 1.25) -> Transducer:
    """A clause with a target and a strong insult, in either order, is ``stronger`` as a whole."""
    return Transducer({(0, TARGET): (1, TARGET, 1.0), (0, INSULT): (2, INSULT, 1.0), (1, INSULT): (3, INSULT, 1.0),
                       (2, TARGET): (3, TARGET, 1.0)}, {3: stronger})


def compose(first: Transducer, second: Transducer) -> Transducer:
    """What ``first`` writes is what ``second`` reads; factors multiply."""
    arcs, final, todo, seen = {}, {}, [(0, 0)], {(0, 0): 0}
    while todo:
        a, b = pair = todo.pop()
        final[seen[pair]] = first.end(a) * second.end(b)
        for symbol in range(8):
            to_a, middle, x = first.step(a, symbol)
            to_b, out, y = second.step(b, middle)
            if (to_a, to_b) not in seen:
                seen[to_a, to_b] = len(seen)
                todo.append((to_a, to_b))
            arcs[seen[pair], symbol] = (seen[to_a, to_b], out, x * y)
    return Transducer(arcs, final)


def grammar() -> Transducer:
    whole = negation()
    for part in (reported(), insults(), threats(), targets()):
        whole = compose(whole, part)
    return whole


def clause_score(machine: Transducer, clause: list[tuple[int, float]]) -> float:
    """Sum of the words' weights times their arcs' factors, times the final factor."""
    state, total = 0, 0.0
    for symbol, weight in clause:
        state, out, factor = machine.arcs[state, symbol]
        if out in (INSULT, THREAT, WEAK_INSULT, WEAK_THREAT):
            total += weight * factor
    return total * machine.end(state)


def keys_of(word: str) -> list[str]:
    """The word and its beginnings (marked by ``*``), the longest first."""
    return [word, *(word[:n] + "*" for n in reversed(BEGINNINGS) if len(word) > n)]


class Scorer:
    """Clause figures of texts: highest score, sum of scores, number of scored clauses, number of words."""

    def __init__(self, weights: dict[str, float]):
        self.machine = grammar()

        def symbol_of(word):
            learnt = max((weights[k] for k in keys_of(word) if k in weights), default=0.0)
            symbol = LISTED.get(word, INSULT if learnt > 0 else OTHER)
            if symbol not in (INSULT, THREAT):
                return symbol, 0.0
            # a listed insult that the labels speak against has weight 0
            return symbol, learnt or weights.get(word, SEED_WEIGHT)

        self.known = Remembered(symbol_of)

    def clauses(self, text: str | None) -> tuple[list[float], int]:
        """Scores of the clauses that hold an insult or a threat, in order; the number of words."""
        known = self.known
        out, clause, matters, words = [], [], False, 0
        for token in _TOKEN.findall((text or "").lower()):
            if token in ".!?;:\n":
                if matters:
                    out.append(clause_score(self.machine, clause))
                words += len(clause)
                clause, matters = [], False
            else:
                found = known[token]
                clause.append(found)
                matters = matters or found[0] in (INSULT, THREAT)
        if matters:
            out.append(clause_score(self.machine, clause))
        return out, words + len(clause)

    def figures(self, texts: list[str | None]) -> np.ndarray:
        rows = [self.clauses(t) for t in texts]
        return np.array([[max(r, default=0.0), np.log1p(sum(r)), np.log1p(len(r)), np.log1p(n) if r else 0.0]
                         for r, n in rows]).reshape(len(rows), FIGURES)


@dataclass
class ToxicityModel:
    weights: dict[str, float]
    curve: np.ndarray

    def score(self, figures: np.ndarray) -> np.ndarray:
        z = figures @ self.curve[:-1] + self.curve[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_curve(x: np.ndarray, y: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method, slightly ridged; one class alone gives its score everywhere.

    Each row counts as often as ``times`` says.
    """
    if len(set(y.tolist())) < 2:
        return np.array([*[0.0] * FIGURES, -3.0 if not len(y) or y[0] == 0 else 3.0])
    a, w = np.column_stack([x, np.ones(len(x))]), np.zeros(FIGURES + 1)
    ridge = np.diag([*[0.1] * FIGURES, 0.01])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (times * (p - y)) + ridge @ w
        w = w - np.linalg.solve((a * (times * p * (1 - p))[:, None]).T @ a + ridge + 1e-6 * np.eye(FIGURES + 1), grad)
    return w


def _counted(chosen: DataFrame, text: str, name: str) -> DataFrame:
    """``key`` and in how many texts it occurs."""
    def make():
        counts = Counter()

        def add(texts):
            for t in texts:
                words = {w for w in _TOKEN.findall((t or "").lower()) if w not in ".!?;:\n"}
                keys = {k for w in words for k in keys_of(w)}
                counts.update(keys)

        def finish():
            yield [list(counts), list(counts.values())]

        return add, finish

    fields = [T.StructField("key", T.StringType()), T.StructField("n", T.LongType())]
    return summarise(chosen, [text], fields, make).groupBy("key").agg(F.sum("n").alias(name))


def learn_weights(chosen: DataFrame, text: str = "text") -> dict[str, float]:
    """Log-odds of the keys that toxic texts of ``chosen`` (``label`` 0 or 1) have significantly more often.

    The share of toxic texts that the bound compares with is that of ``chosen``,
    whose counts it is applied to; log-odds don't depend on it.
    A key must occur in ``SUPPORT`` of the toxic texts, and in three. The keys
    considered, at most 100 times the distinct keys of a mean toxic text, stay
    in a table; what comes to the driver are the learnt ones and the listed
    words that the labels speak against.
    """
    sizes = {r["label"]: r["count"] for r in chosen.groupBy("label").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return {}
    often = _counted(chosen.filter("label = 1"), text, "n").filter(F.col("n") >= max(3, SUPPORT * toxic))
    against = _counted(chosen.filter("label = 0"), text, "m")
    seen = written(often.join(against, "key", "left").select("key", "n", F.coalesce("m", F.lit(0)).alias("m")), "toxicity-keys")
    share, needed = toxic / (toxic + clean), float(np.log(max(seen.count(), 1) / CERTAINTY))
    n, m, q = F.col("n"), F.col("m"), F.col("n") / (F.col("n") + F.col("m"))
    weight = F.log((n + 0.5) / (toxic + 1)) - F.log((m + 0.5) / (clean + 1))
    # Chernoff bound on seeing so many toxic texts among those with the key by chance
    surprise = (n + m) * (q * F.log(q / share) + F.when(m > 0, (1 - q) * F.log((1 - q) / (1 - share))).otherwise(0))
    learnt = (q > share) & (surprise > needed) & (weight > 2)
    rows = (seen.select("key", weight.alias("weight"), learnt.alias("learnt"))
            .filter(F.col("learnt") | (F.col("weight") <= 0) & F.col("key").isin(*LISTED)).collect())
    return {r["key"]: r["weight"] if r["learnt"] else 0.0 for r in rows}


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> ToxicityModel:
    """Weights and curve from at most ``SAMPLE`` labelled rows of each class, those with the smallest hashes.

    For the curve, a class's rows count as often as all its labels are to those
    picked, so that scores follow the share of toxic labels at any input size.
    Labels are learnt only where crc32(key) mod 3 is not 1. Null labels and
    keys are left out; null texts count as empty. Rows are taken in the order
    of their keys', labels' and texts' hashes.
    """
    usable = (labels.filter((split_remainder(key, 3) != 1) & F.col(label).isNotNull() & F.col(key).isNotNull())
              .select(key, F.col(label).cast("int").alias("label")))
    sizes = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    picked = [usable.filter(F.col("label") == c).orderBy(F.xxhash64(key)).limit(SAMPLE) for c in (0, 1)]
    sample = picked[0].unionByName(picked[1])
    chosen = docs.select(key, text).join(F.broadcast(sample), key)
    last = unused("_order", chosen)
    chosen = written(chosen.withColumn(last, F.xxhash64(text)), "toxicity-sample")
    weights = learn_weights(chosen, text)
    figures = T.StructField("figures", T.ArrayType(T.DoubleType()))

    def make():
        scorer = Scorer(weights)
        return lambda texts: [scorer.figures(texts).tolist()]

    rows = (add_columns(chosen, [text], [figures], make, [key, "label", last])
            .orderBy(F.xxhash64(key), "label", last).limit(4 * SAMPLE).collect())
    x = np.array([r["figures"] for r in rows], float).reshape(len(rows), FIGURES)
    times = np.array([max(1.0, sizes[r["label"]] / SAMPLE) for r in rows], float)
    return ToxicityModel(weights, fit_curve(x, np.array([r["label"] for r in rows], float), times))


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append ``score`` (0 to 1, higher: likelier toxic) of each whole text.

    A text without insults or threats, null and empty ones included, has the
    curve's lowest score. Repeated rows score alike.
    """
    def make():
        scorer = Scorer(model.weights)
        return lambda texts: [model.score(scorer.figures(texts)).tolist()]

    return add_columns(docs, [text], [T.StructField("score", T.DoubleType())], make, keep)
