"""Words of whole texts as numpy arrays, straight from Arrow string buffers.

A text is never turned into Python strings here: the bytes of a record batch are cut into words and
hashed with a few array operations, so the cost is a few nanoseconds per byte. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: White space of the word pattern ``[^\x20\x09-\x0D]+``.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
#: Bytes handled at once; a longer text is handled alone.
CHUNK_BYTES = 1 << 21

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


class Words(NamedTuple):
    data: np.ndarray  # bytes of the chunk
    text_starts: np.ndarray  # first byte of each text, and the end of the last
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray  # one past the last byte of each word
    first_word: np.ndarray  # index of each text's first word, and the number of words

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first_word)

    @property
    def owner(self) -> np.ndarray:
        """Index of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def byte_codes(fold_case: bool) -> np.ndarray:
    """A 64-bit code for every byte; with ``fold_case`` A-Z share the codes of a-z."""
    codes = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
    if fold_case:
        codes[ord("A") : ord("Z") + 1] = codes[ord("a") : ord("z") + 1]
    return codes


def byte_set(members: bytes) -> np.ndarray:
    found = np.zeros(256, dtype=bool)
    found[list(members)] = True
    return found


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of an Arrow string column; nulls become empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return offsets, np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Runs of texts with at most ``most`` bytes together: rows, text starts, bytes."""
    if not len(column):
        return
    offsets, data = text_buffers(column)
    at, total = 0, len(offsets) - 1
    while at < total:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield slice(at, end), offsets[at : end + 1] - offsets[at], data[offsets[at] : offsets[end]]
        at = end


def split_words(text_starts: np.ndarray, data: np.ndarray, between: np.ndarray) -> Words:
    """Cut at every byte marked in ``between`` and at the ends of texts."""
    inside = ~between[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[text_starts] = True
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:-1]
    closes[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(opens)
    return Words(data, text_starts, starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, text_starts))


def hash_words(words: Words, codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: differences of one running polynomial over the bytes."""
    return hash_starts(words, codes, (None,))[0]


def powers(n: int) -> np.ndarray:
    """The first powers of the hash's base."""
    found = np.full(n, _BASE, dtype=np.uint64)
    found[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(found, out=found)


def running_hash(data: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of a polynomial over the first bytes, and the inverse powers that move a difference to place 0."""
    n = len(data)
    place = powers(n + 1)
    running = np.zeros(n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.take(codes, data, out=running[1:])
        running[1:] *= place[:n]
        np.cumsum(running, out=running)
        place[1:] = _BASE_INVERSE
        np.multiply.accumulate(place, out=place)
    return running, place


def hash_starts(words: Words, codes: np.ndarray, lengths: tuple[int | None, ...]) -> list[np.ndarray]:
    """For each length a hash of that many first bytes of every word, or of the word if it is None or longer."""
    running, inverse = running_hash(words.data, codes)
    ends = [words.ends if k is None else np.minimum(words.starts + k, words.ends) for k in lengths]
    return [hash_ranges(running, inverse, words.starts, e) for e in ends]


def hash_ranges(running: np.ndarray, inverse: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each range of bytes, from what ``running_hash`` gives."""
    with np.errstate(over="ignore"):
        return mix((running[ends] - running[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def hash_windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` consecutive word hashes."""
    n = max(0, len(hashes) - width + 1)
    total = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            total += hashes[k : k + n] * (mix(np.array([k + 1], dtype=np.uint64) * _BASE)[0] | np.uint64(1))
    return mix(total)


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashes in order, the index of one unit of each, and the kind of every unit."""
    return np.unique(hashes, return_index=True, return_inverse=True)


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all ranges ``starts[k] .. starts[k] + lengths[k]``, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)
