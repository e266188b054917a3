"""Counts over whole texts that quality rules are made of, for many texts at once.

Words are ``[^\\x20\\x09-\\x0D]+``. Every count is exact and a long (repeats are found by 64-bit hashes).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from . import words as W

_CODES = W.byte_codes(fold_case=False)
_SPACES = W.byte_set(W.SPACES)
_UPPER, _LOWER = W.byte_set(bytes(range(65, 91))), W.byte_set(bytes(range(97, 123)))
_LETTERS = _UPPER | _LOWER | W.byte_set(bytes(range(128, 256)))
_NEWLINE = W.byte_set(b"\n")
#: Words whose distinct ones are counted together, so the share of distinct words does not fall with length.
STRETCH = 1000


class Texts:
    """A run of texts, cut into words once; counts that are asked for are made when needed and kept."""

    def __init__(self, text_starts: np.ndarray, data: np.ndarray):
        self.words = W.split_words(text_starts, data, _SPACES)
        self.size = len(text_starts) - 1
        self._hashes = None
        self._counts: dict = {}

    def count(self, of: Callable[[Texts], np.ndarray]) -> np.ndarray:
        """A count of this module, made once."""
        if of not in self._counts:
            self._counts[of] = of(self)
        return self._counts[of]

    def only(self, rows: np.ndarray) -> Texts:
        """The texts marked in ``rows``."""
        starts = self.words.text_starts
        lengths = np.diff(starts)
        return Texts(np.append(0, np.cumsum(lengths[rows])), self.words.data[np.repeat(rows, lengths)])

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = W.hash_words(self.words, _CODES)
        return self._hashes

    def bytes_in(self, members: np.ndarray) -> np.ndarray:
        """Number of bytes of each text that are marked in ``members``."""
        return self._per_text(members[self.words.data])

    def _per_text(self, flags: np.ndarray) -> np.ndarray:
        running = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=running[1:])
        return np.diff(running[self.words.text_starts])

    def _words_where(self, flags: np.ndarray) -> np.ndarray:
        return _sum_by(self.words, flags)


def n_words(t: Texts) -> np.ndarray:
    return t.words.counts


def word_chars(t: Texts) -> np.ndarray:
    """Code points in words: bytes that begin one and are no white space."""
    return t._per_text(((t.words.data & 0xC0) != 0x80) & ~_SPACES[t.words.data])


def count_of(characters: bytes) -> Callable[[Texts], np.ndarray]:
    members = W.byte_set(characters)
    return lambda t: t.bytes_in(members)


n_symbols = count_of(b"#*$%&|<>")
n_upper = count_of(bytes(range(65, 91)))
n_lower = count_of(bytes(range(97, 123)))
#: Characters beyond ASCII, by the byte that begins each.
n_beyond_ascii = count_of(bytes(range(0xC0, 0x100)))


def _repeated(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether an earlier entry of the same owner has the hash, and whether any other has."""
    with np.errstate(over="ignore"):
        key = W.mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    later, any_other = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:]] = same
    any_other[order[1:]] = same
    any_other[order[:-1]] |= same
    return later, any_other


def n_dup_lines(t: Texts) -> np.ndarray:
    """Lines (cut at ``\\n``) with a word that equal an earlier line of their text."""
    lines, later = _lines(t)
    return _sum_by(lines, later)


def n_lines(t: Texts) -> np.ndarray:
    """Lines with a word."""
    return _lines(t)[0].counts


def _lines(t: Texts) -> tuple[W.Words, np.ndarray]:
    lines = W.split_words(t.words.text_starts, t.words.data, _NEWLINE)
    # A line of white space alone has no word in it.
    worded = np.searchsorted(t.words.starts, lines.starts) < np.searchsorted(t.words.starts, lines.ends)
    owner = lines.owner[worded]
    kept = W.Words(lines.data, lines.text_starts, lines.starts[worded], lines.ends[worded], np.searchsorted(owner, np.arange(t.size + 1)))
    return kept, _repeated(owner, W.hash_words(kept, _CODES))[0]


def _sum_by(words: W.Words, flags: np.ndarray) -> np.ndarray:
    running = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=running[1:])
    return np.diff(running[words.first_word])


def n_repeat_words(t: Texts) -> np.ndarray:
    """Words in 3-word windows that their text has twice or more, the first one included."""
    owner = t.words.owner
    windows = W.hash_windows(t.hashes, 3)
    whole = np.flatnonzero(owner[: len(windows)] == owner[2:]) if len(windows) else np.zeros(0, np.int64)
    twice = whole[_repeated(owner[whole], windows[whole])[1]]
    covered = np.zeros(len(owner), bool)
    for k in range(3):
        covered[twice + k] = True
    return t._words_where(covered)


def n_distinct_words(t: Texts) -> np.ndarray:
    return t.words.counts - t._words_where(_repeated(t.words.owner, t.hashes)[0])


def n_distinct_in_stretches(t: Texts) -> np.ndarray:
    """Distinct words of each stretch of ``STRETCH`` words of a text, added up."""
    counts = t.words.counts
    stretches = -(-counts // STRETCH)
    place = np.arange(len(t.words.starts)) - np.repeat(t.words.first_word[:-1], counts)
    stretch = np.repeat(np.cumsum(stretches) - stretches, counts) + place // STRETCH
    return counts - t._words_where(_repeated(stretch, t.hashes)[0])


def n_letter_words(t: Texts) -> np.ndarray:
    """Words with an ASCII letter or any character beyond ASCII."""
    running = np.zeros(len(t.words.data) + 1, np.int64)
    np.cumsum(_LETTERS[t.words.data], out=running[1:])
    return t._words_where(running[t.words.ends] > running[t.words.starts])
