"""Encoders for vocabularies of merges, fast for ASCII units and exact for all.

The files list pairs of tokens to be merged, earlier pairs first. Where every token comes out of its own bytes,
merging whatever two neighbours make a token of the least rank gives the same ids: two tokens that meet were
made of their own bytes alone, so they merge as they do when their token is encoded by itself. Tokens that do not
come out of their own bytes are left out; they never come out of any. Units with characters about whose kind or
case libraries may differ go through the file's own library.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from typing import NamedTuple

import numpy as np

#: Stands for the end of a word; four bytes that are merged first. A unit with this character is not ASCII.
_END = "\U0010fffd"

Encode = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


class Vocabulary(NamedTuple):
    model: str  # the file
    ranks: dict[bytes, int]  # of all tokens, by their bytes
    shift: int  # ranks are ids and this
    ends: str  # what is put behind a unit
    lower: bool
    tokens: list[bytes]  # bytes by id, without the end of a word


def byte_of_characters() -> dict[str, int]:
    """Printable bytes stand for themselves, the others for the characters from U+0100 on, in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(shown)))}


def _comes_out(symbols: list[str], order: dict[tuple[str, str], int]) -> bool:
    while len(symbols) > 1:
        best, at = min((order.get(pair, len(order)), k) for k, pair in enumerate(zip(symbols, symbols[1:])))
        if best == len(order):
            return False
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
    return True


def load(path: str) -> Vocabulary:
    """Read a file on the driver. Ids must be in the order of the merges."""
    with open(path, encoding="utf-8") as file:
        model = file.read()
    parts = json.loads(model)
    core, byte_of = parts["model"], byte_of_characters()
    suffix = core.get("end_of_word_suffix") or ""
    normalizer = json.dumps(parts.get("normalizer"))
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in core["merges"]]
    order = {m: k for k, m in enumerate(merges)}
    made = [core["vocab"][a + b] for a, b in merges]
    if any(a >= b for a, b in zip(made, made[1:])):
        raise ValueError("ids are not in the order of the merges")
    end = _END.encode() if suffix else b""
    ranks = {end[:k]: k - 2 for k in range(2, len(end) + 1)}
    shift = len(ranks)
    tokens = [b""] * (max(core["vocab"].values()) + 1)
    for token, k in core["vocab"].items():
        stem = token.removesuffix(suffix) if suffix else token
        closed = len(stem) < len(token)
        tokens[k] = bytes(byte_of[c] for c in stem)
        symbols = list(stem)
        if closed:
            symbols[-1] += suffix
        if _comes_out(symbols, order):
            ranks[tokens[k] + (end if closed else b"")] = k + shift
    return Vocabulary(model, ranks, shift, _END if suffix else "", "Lowercase" in normalizer, tokens)


def encoder(vocabulary: Vocabulary, pattern: str, plain: Callable[[bytes], object] = bytes.isascii) -> Encode:
    """Made once a task: gives the ids of all units, one after the other, and how many each has.

    Units that are not ``plain`` go through the library; the others are cut by ``pattern``.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tiktoken
    import tokenizers

    library = tokenizers.Tokenizer.from_str(vocabulary.model)
    library.encode_special_tokens = not vocabulary.ends
    fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=vocabulary.ranks, special_tokens={}).encode_ordinary

    def encode(units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        slow = [k for k, unit in enumerate(units) if not plain(unit)]
        made: list = [None] * len(units)
        by_library = library.encode_batch_fast([units[k].decode() for k in slow], add_special_tokens=False)
        for k, found in zip(slow, by_library):
            made[k] = [x + vocabulary.shift for x in found.ids]
        for k, unit in enumerate(units):
            if made[k] is None:
                text = unit.decode()
                made[k] = fast((text.lower() if vocabulary.lower else text) + vocabulary.ends)
        lengths = np.fromiter(map(len, made), np.int64, len(made))
        flat = np.fromiter((x for m in made for x in m), np.int32, int(lengths.sum()))
        return flat - np.int32(vocabulary.shift), lengths

    return encode
