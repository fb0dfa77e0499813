"""Benchmark decontamination by pigeonhole edit matching.

A test item may occur in a text with one edit for every ``CHARS_PER_ERROR``
characters. Cut into one piece more than the edits allowed, at least one piece
of any such occurrence is unharmed. An Aho-Corasick automaton finds all exact
pieces in one pass; around each the item's distance is verified with Myers'
bit-parallel algorithm on integers as wide as the item.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, discard, kept_in_worker, unused, written

CHARS_PER_ERROR = 20
BLOCK_CHARS = 8_000_000  # characters of test items that one pass over the texts looks for
KNOWN_CHARS = 4_000_000  # characters of windows whose distances a worker remembers


def normalised(text: str | None) -> str:
    """Lower case, every run of white space one blank, none at the ends."""
    return " ".join((text or "").lower().split())


def pieces(item: str, budget: int) -> list[tuple[str, int]]:
    """``budget`` + 1 pieces of nearly equal length and where each ends in the item."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(item[a:b], b) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


class Item:
    """A test item prepared for Myers' algorithm."""

    def __init__(self, item_id, text: str):
        self.id, self.text, self.budget = item_id, text, len(text) // CHARS_PER_ERROR
        self.ones, self.top = (1 << len(text)) - 1, 1 << max(len(text) - 1, 0)
        self.equal: dict[str, int] = {}
        for i, c in enumerate(text):
            self.equal[c] = self.equal.get(c, 0) | 1 << i

    def nearest(self, window: str) -> tuple[int, int]:
        """Least edit distance to any substring of ``window``, and where the first such one ends."""
        plus, minus, score, ones, top = self.ones, 0, len(self.text), self.ones, self.top
        best, end, equal = score, 0, self.equal
        for at, c in enumerate(window, 1):
            eq = equal.get(c, 0)
            xv = eq | minus
            xh = (((eq & plus) + plus) ^ plus) | eq
            up, down = minus | (ones & ~(xh | plus)), plus & xh
            if up & top:
                score += 1
            elif down & top:
                score -= 1
                if score < best:
                    best, end = score, at
            up, down = up << 1 & ones, down << 1 & ones
            plus, minus = down | (ones & ~(xv | up)), up & xv
        return best, end


class Matcher:
    def __init__(self, items: list[tuple]):
        import ahocorasick

        found: dict[str, list] = {}
        for item in (Item(i, normalised(t)) for i, t in items):
            for piece, end in pieces(item.text, item.budget):
                found.setdefault(piece, []).append((item, end))
        self.automaton = ahocorasick.Automaton()
        for piece, where in found.items():
            self.automaton.add_word(piece, where)
        if found:
            self.automaton.make_automaton()
        self.some = bool(found)
        self.known: dict[tuple, tuple[int, int]] = {}  # windows recur where documents copy each other
        self.known_chars = 0

    def nearest(self, item: Item, window: str) -> tuple[int, int]:
        key = (id(item), window)
        if key not in self.known:
            if self.known_chars + len(window) > KNOWN_CHARS:
                self.known.clear()
                self.known_chars = 0
            self.known[key] = item.nearest(window)
            self.known_chars += len(window)
        return self.known[key]

    def matches(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item id, least distance, end in the normalised text of its first such occurrence), by item id."""
        text = normalised(text)
        if not self.some or not text:
            return []
        tried, best = set(), {}
        for last, where in self.automaton.iter(text):
            for item, end in where:
                start = last + 1 - end
                if (id(item), start) in tried:
                    continue
                tried.add((id(item), start))
                begin = max(0, start - item.budget)
                window = text[begin:start + len(item.text) + item.budget]
                distance, stop = self.nearest(item, window)
                if distance <= item.budget:
                    hit = (distance, begin + stop)
                    best[item.id] = min(best.get(item.id, hit), hit)
        return [(i, d, e) for i, (d, e) in sorted(best.items(), key=lambda x: (x[0] is None, x[0] or 0))]


HITS = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("distance", T.IntegerType()),
                                 T.StructField("end", T.LongType())]))


def _blocks(items: DataFrame) -> Iterator[list[tuple[list, str]]]:
    """(item ids, text) of the distinct texts in ``items``, in runs of at most ``BLOCK_CHARS`` characters (an id counts as 8) or one text.

    Rows come to the driver one partition at a time; one run is held.
    """
    block, chars = [], 0
    for row in items.toLocalIterator():
        size = len(row["body"]) + 8 * len(row["ids"])
        if block and chars + size > BLOCK_CHARS:
            yield block
            block, chars = [], 0
        block.append(([i["id"] for i in row["ids"]], row["body"]))
        chars += size
    if block:
        yield block


def find_items(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
               item_text: str = "text", keep: list[str] | None = None, name: str = "hits") -> DataFrame:
    """Append ``name``: the test items that each whole text contains, with their least edit distance.

    ``benchmark`` is the stated query set. Its distinct texts are cut into blocks
    of ``BLOCK_CHARS`` characters; each block is one pass over the texts, written
    before the next begins, so a task holds one block's automaton whatever the
    number of blocks. Null and empty items match nothing, items with equal texts
    all match, null and empty texts contain nothing; hits are ordered by item id.
    """
    given = benchmark.select(F.col(item).cast("long").alias("id"), F.col(item_text).alias("body")).filter(F.length(F.trim("body")) > 0)
    # written, so that every block comes from the same rows in the same order
    items = written(given.groupBy("body").agg(F.collect_list(F.struct("id")).alias("ids")).select("body", "ids"), "benchmark-texts")
    kept = [c for c in (docs.columns if keep is None else keep) if c != name]
    rows = docs.select(*dict.fromkeys([*kept, text]))
    found = unused("_found", rows)
    out, before = rows.withColumn(found, F.array().cast(HITS)), None
    for number, block in enumerate(_blocks(items)):
        if number:
            out = written(out, "passes")
            if before is not None:
                discard(before)
            before = out
        parts = [repr(ids) + body for ids, body in block]
        digest = hashlib.sha256("\0".join(parts).encode("utf-8", "surrogatepass")).hexdigest()

        def make(block=block, digest=digest):
            held = kept_in_worker("decontaminate", dict)  # the last block's automaton only
            if digest not in held:
                held.clear()
                held[digest] = Matcher([(i, body) for i, (_, body) in enumerate(block)])
            matcher = held[digest]

            def hits(text, earlier):
                new = [{"item_id": i, "distance": d, "end": e} for place, d, e in matcher.matches(text) for i in block[place][0]]
                return sorted([*(earlier or []), *new], key=lambda x: (x["item_id"] is None, x["item_id"] or 0))

            return lambda texts, earlier: [[hits(t, h) for t, h in zip(texts, earlier, strict=True)]]

        out = add_columns(out, [text, found], [T.StructField(found, HITS)], make)
    return out.select(*kept, F.col(found).alias(name))
