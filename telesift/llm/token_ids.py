"""Token ids of texts by a public tokenizer, each distinct word encoded once in a while.

The tokenizer cuts its input at every white space before it looks at anything else: its normaliser turns runs of white
space into a blank, composes and lower-cases character by character, and its pre-tokenizer drops blanks. So the ids of a
text are the ids of its words one after the other, and a word's ids can be kept. In the same way letters and the ASCII marks
behind them are apart, and the pre-tokenizer does nothing to either; whether that holds is tried on a few words when a
tokenizer is loaded. Tests compare all this with whole texts.
"""

from __future__ import annotations

import os
import string
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Words kept in one Python worker; beyond that it starts afresh, which costs time and changes nothing.
KEPT_WORDS = 1_000_000
_PROBES = ("Abc", "word", "STRENGTHS", "rereer", "thththonble", "...", "!!", "***", "),", "x", "\u00c9lan", "stra\u00dfe", "e\u0301t\u00e9", "\u0434\u043e\u043c", "\u4e2d\u6587")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else the next from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(0x100 + k) for k, b in enumerate(rest)}


_LETTERS = _byte_letters()


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordIds(dict):
    """Word (UTF-8 bytes without ASCII white space) to its ids (little-endian unsigned 32-bit), learned when asked for."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._merges, self._normaliser = self._tokenizer.model, self._tokenizer.normalizer
        self._plain = self._normaliser is not None and all(self._merged(self._normal(word)) == self._whole(word) for word in _PROBES)

    def _whole(self, text: str) -> bytes:
        return _packed(self._tokenizer.encode(text, add_special_tokens=False).ids)

    def _normal(self, piece: str) -> str:
        return piece.lower() if piece.isascii() else self._normaliser.normalize_str(piece)

    def _merged(self, normal: str) -> bytes:
        """Ids of normal letters alone, or of marks alone: the pre-tokenizer would leave them in one piece."""
        letters = normal if normal.isascii() else normal.encode().decode("latin-1").translate(_LETTERS)
        return _packed([token.id for token in self._merges.tokenize(letters)])

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        body = text.rstrip(string.punctuation)
        normal = self._normal(body) if self._plain and body.isalpha() else ""
        if not self._plain or (body and not normal.isalpha()):
            ids = self._whole(text)
        elif body and len(body) < len(text):
            # Letters and the marks behind them are words of their own, and kept as such.
            ids = self[body.encode()] + self[text[len(body) :].encode()]
        else:
            ids = self._merged(normal or text)
        self[word] = ids
        return ids

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows as one run, `end_id` after each row's, and the number of each row's ids with that end.

        A null or empty text has its end only. Other white space than ASCII's stays inside a word, for the tokenizer to cut.
        """
        if len(self) > KEPT_WORDS:
            self.clear()
        end, ids_of = _packed([end_id]), self.__getitem__
        rows = [b"".join(map(ids_of, text.split())) + end if text else end for text in texts.cast(pa.large_binary()).to_pylist()]
        return np.frombuffer(b"".join(rows), "<u4"), np.fromiter(map(len, rows), np.int64, len(rows)) // 4


@lru_cache(maxsize=1)
def encoder(path: str) -> WordIds:
    """The encoder of this Python worker, which keeps its words from task to task."""
    return WordIds(path)


def forget_words() -> None:
    """For other work in a Python worker that may have encoded before: its words, some 200 MB at most, go."""
    encoder.cache_clear()
