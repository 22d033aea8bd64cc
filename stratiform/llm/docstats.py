"""Statistics of whole texts, computed for a chunk of texts at a time."""

from __future__ import annotations

import numpy as np
import pandas as pd

from .textkit import Chunk, Words, byte_hashes, lookup, mix, window_hashes

SYMBOLS = lookup("#*$%&|<>")
_CONTINUED = (np.arange(256) & 0xC0) == 0x80
_UPPER, _LOWER, _DIGIT = lookup(bytes(range(65, 91))), lookup(bytes(range(97, 123))), lookup("0123456789")
_MARKS, _CALLS = lookup(".,;:"), lookup("!?")

#: Names of the columns of ``features``, in order.
FEATURES = ("log_words", "word_length", "distinct_words", "repeat_words", "dup_lines", "symbols", "upper",
            "digits", "calls", "marks", "words_a_line", "long_words", "one_letter_words", "not_ascii", "same_as_last")


def _seen_before(keys: np.ndarray) -> np.ndarray:
    """Whether an equal key stands earlier in the array."""
    which, distinct = pd.factorize(keys)
    first = np.zeros(len(distinct), dtype=np.int64)
    first[which[::-1]] = np.arange(len(which))[::-1]
    return first[which] != np.arange(len(which))


def _per_text(words: Words, x: np.ndarray) -> np.ndarray:
    """Sum of a per-word array over each text."""
    total = np.concatenate(([0], np.cumsum(x)))
    return total[words.end] - total[words.begin]


class Stats:
    """Counts of each text of a chunk (int64 arrays).

    Words are runs of non-space; ``word_chars`` their code points;
    ``n_dup_lines`` lines with a word that equal an earlier line of the text;
    ``n_repeat_words`` words in 3-word windows found twice or more in it."""

    def __init__(self, chunk: Chunk):
        data = chunk.data
        self.chunk, self.words = chunk, (words := Words(chunk))
        self.n_words = words.count.astype(np.int64)
        self.n_symbols = chunk.sums(SYMBOLS[data])
        head = np.concatenate(([0], np.cumsum(~_CONTINUED[data])))
        self.word_length = head[words.stop] - head[words.start]
        self.word_chars = _per_text(words, self.word_length)
        self.hashes = words.hashes()
        self.n_repeat_words = self._repeated()
        self.n_lines, self.n_dup_lines = self._lines()

    def _repeated(self) -> np.ndarray:
        words, n = self.words, len(self.words)
        covered = np.zeros(n, dtype=bool)
        if n >= 3:
            at = np.flatnonzero(words.doc[:-2] == words.doc[2:])
            key = mix(window_hashes(self.hashes, 3)[at] ^ mix(words.doc[at].astype(np.uint64)))
            which, distinct = pd.factorize(key)
            twice = at[np.bincount(which, minlength=len(distinct))[which] > 1]
            for k in range(3):
                covered[twice + k] = True
        return _per_text(words, covered)

    def _lines(self) -> tuple[np.ndarray, np.ndarray]:
        chunk, words = self.chunk, self.words
        full = chunk.end > chunk.begin
        breaks = np.flatnonzero(chunk.data == 10)
        start = np.sort(np.concatenate((chunk.begin[full], breaks + 1)))
        stop = np.sort(np.concatenate((breaks, chunk.end[full])))
        # A break at the end of a text leaves an empty last line, which has no word.
        text = np.searchsorted(chunk.end, breaks, side="right")
        n_lines = np.bincount(text, minlength=len(chunk)) + full
        used = np.searchsorted(words.start, stop) > np.searchsorted(words.start, start)
        start, stop = start[used], stop[used]
        doc = np.searchsorted(chunk.end, start, side="right")
        again = _seen_before(mix(byte_hashes(chunk.data, start, stop) ^ mix(doc.astype(np.uint64))))
        return n_lines.astype(np.int64), np.bincount(doc[again], minlength=len(chunk)).astype(np.int64)

    def features(self) -> np.ndarray:
        """``FEATURES`` of each text (texts x features); an empty text has zeros."""
        chunk, words, data = self.chunk, self.words, self.chunk.data
        share = lambda a, b: a / np.maximum(b, 1)
        size = chunk.end - chunk.begin
        upper, lower = chunk.sums(_UPPER[data]), chunk.sums(_LOWER[data])
        again = _seen_before(mix(self.hashes ^ mix(words.doc.astype(np.uint64))))
        same = np.zeros(len(words), dtype=bool)
        if len(words) > 1:
            same[1:] = (self.hashes[1:] == self.hashes[:-1]) & (words.doc[1:] == words.doc[:-1])
        n = self.n_words
        return np.stack([
            np.log1p(n), share(self.word_chars, n), share(n - _per_text(words, again), n),
            share(self.n_repeat_words, n), share(self.n_dup_lines, self.n_lines), share(self.n_symbols, size),
            share(upper, upper + lower), share(chunk.sums(_DIGIT[data]), size), share(chunk.sums(_CALLS[data]), n),
            share(chunk.sums(_MARKS[data]), n), np.log1p(share(n, self.n_lines)),
            share(_per_text(words, self.word_length > 15), n), share(_per_text(words, self.word_length == 1), n),
            share(chunk.sums(data >= 0x80), size), share(_per_text(words, same), n)], axis=1)
