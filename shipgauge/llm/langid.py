"""Language identification for texts that may mix languages.

A word is a run of non-blanks, cut where the script changes; the script of its
letters narrows the candidate languages. Character
1- to 3-grams, hashed into a table of fixed size, score each candidate for each
word. Viterbi with a penalty for switching labels the words, and runs of one
label are the text's spans.
"""

from __future__ import annotations

import re
import sys
from collections import Counter, defaultdict
from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LONGEST, REMEMBERED, add_columns, split_remainder, summarise

GRAM_ROWS = 1 << 15
SWITCH = 8.0           # nats that changing the language between two words costs
SHARE = 0.005          # of a language's letters a script must have for the language to be its candidate
UNKNOWN = "und"
DENSE = 32 << 20       # bytes up to which a task lays the model out as a full table
WAITING = (400_000, 64_000_000)  # distinct words, and characters of texts, that are counted together
TOGETHER = 16384       # texts times languages labelled side by side

# First code points of script ranges; a range ends where the next begins.
SCRIPTS = ("other", "latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "indic", "thai", "hangul", "kana", "han")
_RANGES = [(0, "other"), (0x41, "latin"), (0x250, "other"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"),
           (0x590, "hebrew"), (0x600, "arabic"), (0x780, "other"), (0x8A0, "arabic"), (0x900, "indic"), (0xE00, "thai"),
           (0xE80, "other"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
           (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"), (0x31F0, "kana"), (0x3200, "other"),
           (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"),
           (0xFB10, "other"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFE70, "arabic"), (0xFF00, "other"),
           (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"), (0x32000, "other")]
_STARTS, _NAMES = [a for a, _ in _RANGES], [SCRIPTS.index(s) for _, s in _RANGES]


_FIRST, _LAST = "\x02", "\x03"  # stand for a word's ends


@cache
def _changes() -> tuple[re.Pattern, re.Pattern]:
    """(a letter of a script but Latin, the places where a letter is followed by one of another script).

    Han and kana count as one script, which Japanese words mix; letters of
    unlisted scripts and non-letters but blanks may stand between.
    """
    letters: dict[str, list[str]] = defaultdict(list)
    for (start, name), end in zip(_RANGES, _STARTS[1:], strict=False):
        if name == "other":
            continue
        found = [i for i in range(start, end) if chr(i).isalpha()]
        first = [i for i in found if i == start or not chr(i - 1).isalpha()]
        last = [i for i in found if i == end - 1 or not chr(i + 1).isalpha()]
        letters["han" if name == "kana" else name] += [f"{chr(a)}-{chr(b)}" for a, b in zip(first, last, strict=True)]
    kinds = {name: "".join(runs) for name, runs in letters.items()}
    between = rf"[^\s{''.join(kinds.values())}]*"
    rest = {name: "".join(k for n, k in kinds.items() if n != name) for name in kinds}
    return re.compile(f"[{rest['latin']}]"), re.compile("|".join(f"(?<=[{kinds[n]}])(?={between}[{rest[n]}])" for n in kinds))


def chunks_of(text: str | None) -> list[str]:
    """Runs of non-blanks, cut where the script of their letters changes."""
    text = text or ""
    if not text.isascii():
        beyond, change = _changes()
        if beyond.search(text):
            text = change.sub(" ", text)
    return text.split()


def letters_of(chunk: str) -> str:
    """The letters of a chunk, lower-cased: a word."""
    low = chunk.lower()
    return low if low.isalpha() else "".join([c for c in low if c.isalpha()])


class Grams:
    """Rows of the 1- to 3-grams of many words at once, and the words' scripts."""

    def __init__(self, words: list[str]):
        framed = _FIRST + (_LAST + _FIRST).join(words) + _LAST
        points = np.frombuffer(framed.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        first, last = points == ord(_FIRST), points == ord(_LAST)
        word = np.cumsum(first) - 1
        inside = ~(first | last)
        self.count = len(words)
        self.parts = []  # (rows, starts of each word's rows) for each length of gram
        value = np.zeros(len(points), np.uint64)
        for n in (1, 2, 3):
            value = value[:len(points) - n + 1] * np.uint64(1_000_003) + points[n - 1:]
            fits = inside if n == 1 else ~last[:len(value)] if n == 2 else ~(last[:len(value)] | last[1:len(value) + 1])
            mixed = (value[fits] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            self.parts.append(((mixed >> np.uint64(40)).astype(np.int64) % GRAM_ROWS,
                               np.searchsorted(word[:len(value)][fits], np.arange(self.count))))
        kind = np.array(_NAMES)[np.searchsorted(_STARTS, points[inside].astype(np.int64), side="right") - 1]
        tally = np.bincount(word[inside] * len(SCRIPTS) + kind, minlength=self.count * len(SCRIPTS))
        self.tally = tally.reshape(self.count, len(SCRIPTS))
        self.script = self.tally.argmax(axis=1)  # that most letters have; the first in SCRIPTS on ties


@dataclass
class LanguageModel:
    """What occurs of the table (rows of grams x languages) of log-probabilities, row by row.

    Row r has the entries ``starts[r]`` to ``starts[r + 1]``: a number in
    ``languages`` and by how much the gram is likelier there than one not seen,
    which has ``unseen``. ``allowed``: (scripts x languages).
    """

    languages: list[str]
    starts: np.ndarray
    numbers: np.ndarray
    more: np.ndarray
    unseen: np.ndarray
    allowed: np.ndarray

    def table(self) -> np.ndarray:
        out = np.tile(self.unseen, (GRAM_ROWS, 1))
        out[np.repeat(np.arange(GRAM_ROWS), np.diff(self.starts)), self.numbers] += self.more
        return out.astype(np.float32)


def train(docs: DataFrame, learn_from: Column, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Counts of grams and scripts by language, over every text that may be learnt from.

    Null languages and texts are left out. Spark adds up the counts; what comes
    to the driver is a number for each pair of gram row and language that
    occurs, so a mistyped language costs what its own texts hold, and any number
    of languages can be learnt.
    """
    usable = docs.filter(learn_from & F.col(lang).isNotNull() & F.col(text).isNotNull())
    languages = sorted(r[0] for r in usable.select(lang).distinct().collect())
    number, width = {x: i for i, x in enumerate(languages)}, GRAM_ROWS + len(SCRIPTS)

    def make():
        waiting: dict[int, Counter] = defaultdict(Counter)
        spots, total, read = np.zeros(0, np.int64), np.zeros(0, np.int64), 0

        def flush():
            nonlocal spots, total, read
            new = []
            for i, chunks in waiting.items():
                words = [(w, n) for w, n in ((letters_of(c), n) for c, n in chunks.items()) if w]
                if words:
                    grams, times = Grams([w for w, _ in words]), np.array([n for _, n in words], np.int64)
                    tally = np.zeros(width, np.int64)
                    for rows, starts in grams.parts:
                        each = np.repeat(times, np.diff([*starts, len(rows)]))
                        tally[:GRAM_ROWS] += np.bincount(rows, each, GRAM_ROWS).astype(np.int64)
                    tally[GRAM_ROWS:] = times @ grams.tally
                    some = np.flatnonzero(tally)
                    new.append((some + i * width, tally[some]))
            spots, where = np.unique(np.concatenate([spots, *(s for s, _ in new)]), return_inverse=True)
            total = np.bincount(where, np.concatenate([total, *(n for _, n in new)]), len(spots)).astype(np.int64)
            waiting.clear()
            read = 0

        def add(texts, names):
            nonlocal read
            for t, name in zip(texts, names, strict=True):
                waiting[number[name]].update(chunks_of(t))
                read += len(t)
                if read > WAITING[1]:
                    flush()
            if sum(map(len, waiting.values())) > WAITING[0]:
                flush()

        def finish():
            flush()
            yield [spots // width, spots % width, total]

        return add, finish

    fields = [T.StructField("lang", T.IntegerType()), T.StructField("row", T.IntegerType()), T.StructField("n", T.LongType())]
    counts = summarise(usable, [text, lang], fields, make).groupBy("lang", "row").agg(F.sum("n").alias("n")).toArrow()
    lang_at, row_at, n = (counts.column(c).to_numpy() for c in ("lang", "row", "n"))
    gram = row_at < GRAM_ROWS
    scripts = np.zeros((len(SCRIPTS), len(languages)))
    scripts[row_at[~gram] - GRAM_ROWS, lang_at[~gram]] = n[~gram]
    lang_at, row_at, n = lang_at[gram], row_at[gram], n[gram]
    order = np.lexsort((lang_at, row_at))
    starts = np.searchsorted(row_at[order], np.arange(GRAM_ROWS + 1))
    whole = np.bincount(lang_at, n, len(languages)) + 0.5 * GRAM_ROWS  # every row counts half a time more
    return LanguageModel(languages, starts, lang_at[order], np.log1p(2.0 * n[order]), np.log(0.5 / whole),
                         scripts >= SHARE * np.maximum(scripts.sum(axis=0), 1))


def viterbi(scores: np.ndarray, sizes: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """Best label of every word: the highest sum of scores less ``penalty`` for each change.

    ``scores`` holds the words of all texts in order, ``sizes`` how many each
    has. All texts advance together, the longest first. Staying wins ties, then
    the earlier label.
    """
    labels = np.zeros(len(scores), np.int64)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = (np.cumsum(sizes) - sizes)[order], sizes[order]
    if not len(scores):
        return labels
    steps, width = int(sizes[0]), scores.shape[1]
    active = np.searchsorted(-sizes, -np.arange(steps), side="left")  # texts longer than t
    best = np.zeros((len(sizes), width))
    came = np.tile(np.arange(width, dtype=np.int16 if width < 1 << 15 else np.int32), (len(scores), 1))
    for t in range(steps):
        n = active[t]
        at = starts[:n] + t
        if t:
            top = best[:n].argmax(axis=1)
            through = best[np.arange(n), top][:, None] - penalty
            moved = through > best[:n]
            came[at] = np.where(moved, top[:, None], came[at])
            np.maximum(best[:n], through, out=best[:n])
        best[:n] += scores[at]
    now = best.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        labels[at] = now[:n]
        now[:n] = came[at, now[:n]]
    return labels


class Labeller:
    """Labels the words of texts, remembering the scores of words seen before, up to ``REMEMBERED`` bytes."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.grams = model.table() if 4 * GRAM_ROWS * len(model.languages) <= DENSE else None
        self.forget()

    def forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model.languages)), np.float32)
        self.letters = np.zeros(0, np.int64)
        self.taken = 0

    def sums(self, found: Grams) -> np.ndarray:
        """Log-probabilities of all words in all languages: sums over their grams."""
        if self.grams is not None:
            return sum(np.add.reduceat(self.grams[rows], starts) for rows, starts in found.parts)
        model, width = self.model, len(self.model.languages)
        out = np.zeros((found.count, width))
        for rows, starts in found.parts:
            sizes = np.diff([*starts, len(rows)])
            out += sizes[:, None] * model.unseen
            begin, many = model.starts[rows], model.starts[rows + 1] - model.starts[rows]
            entry = np.repeat(begin - np.cumsum(many) + many, many) + np.arange(many.sum())
            word = np.repeat(np.repeat(np.arange(found.count), sizes), many)
            out += np.bincount(word * width + model.numbers[entry], model.more[entry], out.size).reshape(out.shape)
        return out

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Sums of the grams' log-probabilities, less the best one, for the languages that use a word's script.

        Other languages score worse than all of these; if no language is known
        to use the script, the word speaks for none.
        """
        found = Grams(words)
        score = self.sums(found)
        allowed = self.model.allowed[found.script]
        score = score - np.where(allowed, score, -np.inf).max(axis=1, keepdims=True, initial=-1e30)
        score = np.where(allowed, score, score.min(axis=1, keepdims=True) - SWITCH)
        return np.where(allowed.any(axis=1, keepdims=True), score, 0).astype(np.float32)

    def label(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Letters of every word with any, how many such words each text has, and the words' labels."""
        chunks = [chunks_of(t) for t in texts]
        if self.taken > REMEMBERED:
            self.forget()
        new = list({c for cs in chunks for c in cs}.difference(self.rows))
        if new:
            words = [letters_of(c) for c in new]
            sizes = np.array(list(map(len, words)), np.int64)
            score = np.zeros((len(new), self.scores.shape[1]), np.float32)
            if sizes.any():
                score[sizes > 0] = self.word_scores([w for w in words if w])
            self.rows.update(zip(new, range(len(self.letters), len(self.letters) + len(new)), strict=True))
            self.scores, self.letters = np.concatenate([self.scores, score]), np.concatenate([self.letters, sizes])
        at = self.rows
        rows = np.array([at[c] for cs in chunks for c in cs], np.int64)
        for c in new:
            self.taken += 160 + 4 * self.scores.shape[1] + (sys.getsizeof(c) if len(c) <= LONGEST else 0)
            if len(c) > LONGEST:
                del at[c]
        text = np.repeat(np.arange(len(texts)), [len(c) for c in chunks])
        some = self.letters[rows] > 0
        rows, sizes = rows[some], np.bincount(text[some], minlength=len(texts))
        return self.letters[rows], sizes, viterbi(self.scores[rows], sizes)


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", keep: list[str] | None = None,
            spans: bool = False) -> DataFrame:
    """Append ``lang_pred`` and ``score`` of each whole text, with ``spans`` also its spans.

    The prediction is the language with most letters in its spans, the one
    first in order on ties; the score is its share of all letters. A text
    without letters (or null, or empty) is ``und`` with score 0, as is every text
    if no language was learnt. Spans are (lang, words, letters) in order.
    """
    kind = T.StructType([T.StructField("lang", T.StringType()), T.StructField("words", T.LongType()),
                         T.StructField("letters", T.LongType())])
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    fields += [T.StructField("spans", T.ArrayType(kind))] if spans else []

    def make():
        labeller, names = Labeller(model), model.languages

        def work(texts):
            if not names:
                return [[UNKNOWN] * len(texts), [0.0] * len(texts), *([[[] for _ in texts]] if spans else [])]
            letters, sizes, labels = labeller.label(texts)
            doc = np.repeat(np.arange(len(texts)), sizes)
            share = np.bincount(doc * len(names) + labels, letters, len(texts) * len(names)).reshape(-1, len(names))
            top, whole = share.argmax(axis=1), share.sum(axis=1)
            out = [[names[t] if w else UNKNOWN for t, w in zip(top, whole, strict=True)],
                   [float(s[t] / w) if w else 0.0 for s, t, w in zip(share, top, whole, strict=True)]]
            if spans:
                ends = np.cumsum(sizes)
                out.append([_runs(labels[e - n:e], letters[e - n:e], names) for e, n in zip(ends, sizes, strict=True)])
            return out
        return work

    return add_columns(docs, [text], fields, make, keep, rows=max(1, TOGETHER // max(4, len(model.languages))))


def _runs(labels: np.ndarray, letters: np.ndarray, names: list[str]) -> list[dict]:
    cuts = [0, *(np.flatnonzero(np.diff(labels)) + 1).tolist(), len(labels)]
    return [{"lang": names[labels[a]], "words": b - a, "letters": int(letters[a:b].sum())}
            for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Predictions and spans for all documents, learnt where crc32(key) mod 4 is not 2."""
    held = split_remainder(key, 4) == 2
    model = train(docs, ~held, text, lang)
    return predict(docs, model, text, [key], spans=True).select(key, held.alias("held_out"), "lang_pred", "score", "spans")
