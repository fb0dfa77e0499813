"""Token counts of a unigram tokenizer, without its tokens.

An Aho-Corasick automaton lists the vocabulary's pieces that end at each
character; dynamic programming keeps, for every end, the best score and the
number of pieces on its path. Ties go to the longer last piece, which is the
first one that the tokenizer's own search meets. A character that no piece
matches costs less than any piece and counts as its UTF-8 bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import Remembered, add_columns, kept_in_worker

BLANK = "▁"         # stands for a blank and begins every word
UNKNOWN_LESS = 10.0  # by how much an unknown character scores less than the least piece


def vocabulary(model_file: str) -> list[tuple[str, float]]:
    """Pieces that stand for text and their scores, of a ``sentencepiece`` file, in the order of their ids.

    Control, byte and unknown pieces are left out: ``<s>`` or ``<0x0A>`` in a
    text are characters like others.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_file)
    marks = (model.is_control, model.is_byte, model.is_unknown, model.is_unused)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
            if not any(mark(i) for mark in marks)]


class Counter:
    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min(s for _, s in pieces) - UNKNOWN_LESS
        self.words = Remembered(self.count_word)

    def count_word(self, word: str) -> int:
        """Pieces on the best path through ``word`` (which begins with ``BLANK``)."""
        n = len(word)
        ends = [[] for _ in range(n)]
        for last, found in self.automaton.iter(word):
            ends[last].append(found)  # the longest first
        best, counts = [0.0] * (n + 1), [0] * (n + 1)
        for e in range(n):
            top, pieces = None, 0
            for length, score in ends[e]:
                path = best[e + 1 - length] + score
                if top is None or path > top:
                    top, pieces = path, counts[e + 1 - length] + 1
            if word[e] not in self.single:
                path = best[e] + self.unknown
                if top is None or path > top:
                    top, pieces = path, counts[e] + len(word[e].encode("utf-8", "surrogatepass"))
            best[e + 1], counts[e + 1] = top, pieces
        return counts[n]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        marked = text.replace(" ", BLANK)
        words = self.words
        if marked[0] == BLANK:
            marked = marked[1:]
        return sum([words[w] for w in (BLANK + w for w in marked.split(BLANK))])


def count_tokens(docs: DataFrame, model_file: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append ``n_tokens`` of each whole text; a null or empty text has none. Rows are independent."""
    pieces = vocabulary(model_file)

    def make():
        counter = kept_in_worker(f"counter {model_file}", lambda: Counter(pieces))
        return lambda texts: [[counter.count(t) for t in texts]]

    return add_columns(docs, [text], [T.StructField("n_tokens", T.LongType())], make, keep)
