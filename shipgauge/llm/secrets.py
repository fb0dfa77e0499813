"""Secret scan: one automaton for all rules, one pass over a text's bytes.

The combined automaton reports where matches of each rule first end. From
such an end the rule's mirrored automaton reads back to the leftmost start and
the rule's own automaton reads on to the longest end, which gives leftmost,
non-overlapping matches for each kind. Matches that are too short are dropped
only after they have taken their place.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .automaton import alt, at_least, chars, compile_rules, ends_of, literal, longest, mirrored, opt, plus, seq, star
from .common import add_columns

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
BASE_KINDS = ("assign", "access", "hex")

# The rules. (expression, shortest match, shortest last run of VALUE bytes)
VALUE = LOWER + UPPER + DIGITS + "+/_.=-"
_WORDS = [literal(w, any_case=True) for w in ("password", "passwd", "secret", "token")]
_API_KEY = seq(literal("api", any_case=True), opt(chars("_")), literal("key", any_case=True))
_QUOTE, _BLANKS = opt(chars("\"'")), star(chars(" "))
_PART = plus(chars(LOWER + UPPER + DIGITS + "_-"))
RULES: dict[str, tuple[tuple, int, int]] = {
    "assign": (seq(alt(*_WORDS, _API_KEY), _QUOTE, _BLANKS, chars(":="), _BLANKS, _QUOTE, plus(chars(VALUE))), 0, 8),
    "access": (seq(literal("AKIA"), plus(chars(UPPER + DIGITS))), 16, 0),
    "hex": (at_least(32, chars("abcdef" + DIGITS)), 32, 0),
    "github": (seq(literal("gh"), chars("oprsu"), literal("_"), plus(chars(LOWER + UPPER + DIGITS))), 40, 0),
    "slack": (seq(literal("xox"), chars("abprs"), literal("-"), plus(chars(LOWER + UPPER + DIGITS + "-"))), 15, 0),
    "jwt": (seq(literal("eyJ"), _PART, literal(".eyJ"), _PART, literal("."), _PART), 40, 0),
    "private_key": (seq(literal("-----BEGIN "), star(chars(UPPER + " ")), literal("PRIVATE KEY-----")), 0, 0),
}


class Scanner:
    """The compiled rules: ``scan(text)`` gives (kind, start, end) in code points."""

    def __init__(self, rules: dict[str, tuple[tuple, int, int]] | None = None):
        self.rules = RULES if rules is None else rules
        self.all = compile_rules({k: r[0] for k, r in self.rules.items()}, anywhere=True)
        self.forward = {k: compile_rules({k: r[0]}, anywhere=False) for k, r in self.rules.items()}
        self.back = {k: compile_rules({k: mirrored(r[0])}, anywhere=False) for k, r in self.rules.items()}
        self.order = {k: i for i, k in enumerate(self.rules)}
        self.value = frozenset(VALUE.encode())

    def scan(self, text: str | None) -> list[tuple[str, int, int]]:
        if not text:
            return []
        data = text.encode("utf-8", "surrogatepass")
        spans, done = [], dict.fromkeys(self.rules, 0)
        for i, state in ends_of(self.all, data):
            for kind in self.all.rules[state]:
                if i < done[kind]:
                    continue
                before = longest(self.back[kind], data, i, done[kind] - 1, -1)
                if before is None:  # the match began inside an earlier one
                    continue
                first = before + 1
                done[kind] = end = longest(self.forward[kind], data, first, len(data), 1)
                if self._long_enough(kind, data, first, end):
                    spans.append((kind, first, end))
        spans.sort(key=lambda s: (s[1], self.order[s[0]]))
        if spans and not text.isascii():
            spans = [(k, len(data[:a].decode("utf-8", "surrogatepass")), len(data[:b].decode("utf-8", "surrogatepass")))
                     for k, a, b in spans]
        return spans

    def _long_enough(self, kind: str, data: bytes, first: int, end: int) -> bool:
        _, shortest, run = self.rules[kind]
        if end - first < shortest:
            return False
        if run:
            at = end
            while at > first and data[at - 1] in self.value:
                at -= 1
            # a value may run back over the separator: it begins after the first [:=]
            cut = min((p for p in (data.find(b":", first, end), data.find(b"=", first, end)) if p >= 0))
            return end - max(at, cut + 1) >= run
        return True


def digest(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


FIELDS = [T.StructField("n_assign", T.LongType()), T.StructField("n_access", T.LongType()),
          T.StructField("n_hex", T.LongType()), T.StructField("base_sha256", T.StringType()),
          T.StructField("spans", T.StringType())]


def find_secrets(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append the secrets of each whole text: an array ``secrets`` of (kind, start, end).

    Offsets are code points, the end is exclusive. A null or empty text has
    none. Rows are independent: repeated rows repeat, ties by start come in the
    order of ``RULES``, other columns pass through, an empty table stays empty.
    """
    span = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                     T.StructField("end", T.LongType())]))
    scanner = Scanner()

    def make():
        def work(texts):
            return [[[{"kind": k, "start": a, "end": b} for k, a, b in scanner.scan(t)] for t in texts]]
        return work

    return add_columns(docs, [text], [T.StructField("secrets", span)], make, keep)


def digest_secrets(found: DataFrame) -> DataFrame:
    """Counts and digests of ``find_secrets``'s spans, the columns the query returns."""
    def make():
        def work(secrets):
            rows = [[(s["kind"], s["start"], s["end"]) for s in x] for x in secrets]
            base = [[s for s in x if s[0] in BASE_KINDS] for x in rows]
            return [*([sum(s[0] == k for s in x) for x in base] for k in BASE_KINDS),
                    [hashlib.sha256(digest(x).encode()).hexdigest() for x in base], [digest(x) for x in rows]]
        return work

    return add_columns(found, ["secrets"], FIELDS, make, [c for c in found.columns if c != "secrets"])
