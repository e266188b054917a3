"""Ids of texts from those of their distinct units, which a task encodes once and remembers."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from . import words as W
from .pieces import Memory

#: Units whose ids a task remembers, at most, before it forgets them all; each takes some 40 bytes.
REMEMBERED = 500_000

_CODES = W.byte_codes(fold_case=False)


def unit_ids(units: W.Words, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], memory: Memory) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a block, and where each text's ids begin.

    Units are known by a 64-bit hash. ``encode`` gets those that are new and gives all their ids and how many each
    has; a memory that has become too large is emptied first, which changes the time and no result.
    """
    hashes, first, kind = W.distinct(W.hash_words(units, _CODES))
    if len(memory.units) > REMEMBERED:
        memory.forget()
    new = ~memory.find(hashes)[0]
    if new.any():
        raw, some = units.data.tobytes(), first[new]
        ids, lengths = encode([raw[a:b] for a, b in zip(units.starts[some].tolist(), units.ends[some].tolist())])
        memory.add(hashes[new], lengths, ids)
    at = memory.find(hashes)[1][kind]
    many = memory.lengths[at]
    return memory.ids[W.gather(memory.begins[at], many)], np.append(0, np.cumsum(many))[units.first_word]
