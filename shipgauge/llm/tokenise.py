"""Token ids of whole texts by a ``tokenizers`` file with lower-cased, end-of-word BPE."""

from __future__ import annotations

import re
import unicodedata

import numpy as np

from .common import Remembered, kept_in_worker

# Lower-cased text of Latin letters, digits, ASCII marks and blanks, where Python's and the
# tokenizer's reading agree; and the tokenizer's own split into words on such text (fixed values).
_PLAIN = re.compile(r"[a-zß-öø-ɏ0-9!-/:-@\[-`{-~ \t\n\r\x0b\x0c]*")
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ɏ]+|[0-9]|[!-/:-@\[-`{-~]+")
# White space to Python but not to the tokenizer, or lower-cased by context.
_ODD = re.compile("[\x1c-\x1fΣ]")


def encoder(path: str) -> Encoder:
    """The worker's encoder for ``path``: later tasks find words known."""
    return kept_in_worker(f"encoder {path}", lambda: Encoder(path))


class Encoder:
    """``encode(text)`` gives the ids as little-endian unsigned 32-bit bytes.

    White space always separates words and words repeat, so the ids of a word
    are remembered (the first words met, mostly the frequent ones). Words of plain text go
    straight to the tokenizer's BPE model; all else goes through the tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        ids = np.arange(self.tokenizer.get_vocab_size(), dtype="<u4").tobytes()
        four = [ids[i:i + 4] for i in range(0, len(ids), 4)]
        # The visible character that stands for each byte in the model's vocabulary.
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(visible)]
        shown = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(rest)}
        tokenize = self.tokenizer.model.tokenize

        def ids_of(word):
            seen = word if word.isascii() else word.encode().decode("latin-1").translate(shown)
            return b"".join([four[x.id] for x in tokenize(seen)])

        self.words = Remembered(ids_of)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        words = self.words
        low = text.lower()
        if _PLAIN.fullmatch(low) and (text.isascii() or unicodedata.is_normalized("NFC", text)):
            return b"".join([words[w] for w in _WORDS.findall(low)])
        if _ODD.search(text) or not unicodedata.is_normalized("NFC", text):
            return self.whole(text)
        return b"".join([b"".join([words[w] for w in _WORDS.findall(c.lower())]) if _PLAIN.fullmatch(c.lower())
                         else self.whole(c) for c in text.split()])
