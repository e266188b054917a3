"""SentencePiece encoding and decoding with a batched Viterbi search in numpy.

A text is cut into units that no piece crosses: a run of spaces with what follows it, or a newline. The
distinct units of a block are encoded together: all units of the same number of characters advance one
position at a time, the hashes of their last 1, 2, ... characters are looked up among the sorted hashes of
the pieces, and the best path and its backpointer are kept for every unit at once.

For a unigram model the best path has the highest sum of scores. For a model of merges the scores are
ranks, and a sum of ranks means nothing; there a path may only step from one piece to the next if the two
stay apart when their text is merged by itself. Exactly one path consists of such steps, and it is the
library's merge result, so the same search gives the library's ids.

A long unit, as a text without spaces is one, is searched in overlapping windows that advance together, and joined
exactly. For unigram models it is searched as a whole, one position after the other.

Characters without a piece become byte pieces, so every text survives the round trip exactly. Unlike the
library, a U+2581 in a text becomes bytes as well and does not come back as a space.

Defined results: a null text has null ids, an empty one no ids. Repeated texts have equal ids. Decoding null
gives null; ids that are no pieces are an error; bytes that are no UTF-8 become U+FFFD. An empty table
gives an empty result. Columns other than those named are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import words as W

#: Bytes of texts whose distinct units are encoded together, and characters that advance together. A task
#: needs about 50 bytes for each byte of a block.
BLOCK_BYTES, TOGETHER = 2 << 20, 1 << 18
#: Characters from which on a unit is searched in windows.
LONG_UNIT = 512
#: Units whose ids a task remembers, at most, before it forgets them all.
REMEMBERED = 200_000
#: Penalty of a character without a piece, below the lowest score.
UNKNOWN_PENALTY = 10.0

_CODES = W.byte_codes(fold_case=False)
_SPACE, _NEWLINE = ord(" "), ord("\n")


class Pieces(NamedTuple):
    keys: np.ndarray  # sorted hashes of the pieces, spaces standing for U+2581
    ids: np.ndarray  # of each key
    scores: np.ndarray  # of each key
    first: np.ndarray  # by the first 20 bits of a hash: the first key with them, or -1
    most: int  # keys that share their first 20 bits
    longest: int  # characters
    byte_ids: np.ndarray
    unknown: float
    prefix: bool  # a space is put before every text
    text: bytes  # bytes of all pieces by id
    text_starts: np.ndarray
    merges: Merges | None  # of a model of merges


class Merges(NamedTuple):
    """By id: when a piece is made, of which two, and its unmixed hash."""

    rank: np.ndarray
    left: np.ndarray
    right: np.ndarray
    raw: np.ndarray
    powers: np.ndarray  # of the hash, by length


def _last_merge(piece: str, rank: dict[str, int]) -> tuple[str, str] | None:
    """The two parts of which merging makes the piece in the end, or None if it does not."""
    parts = list(piece)
    while len(parts) > 1:
        best = min(((rank.get(parts[k] + parts[k + 1], np.inf), k) for k in range(len(parts) - 1)))
        if best[0] == np.inf:
            return None
        if len(parts) == 2:
            return parts[0], parts[1]
        parts[best[1] : best[1] + 2] = ["".join(parts[best[1] : best[1] + 2])]
    return "", ""


def load(path: str) -> Pieces:
    """Read a model file on the driver. It must have byte pieces and must not change texts otherwise."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    shown = [model.id_to_piece(k) for k in range(size)]
    is_byte = np.array([model.is_byte(k) for k in range(size)])
    normal = [k for k in range(size) if not (is_byte[k] or model.is_control(k) or model.is_unknown(k) or model.is_unused(k))]
    if is_byte.sum() != 256:
        raise ValueError("the model has no byte pieces")
    spaced = {k: shown[k].replace("▁", " ") for k in normal}
    if any(re.search("[^ ] |\n", p) for p in spaced.values()):
        raise ValueError("pieces go on after a space or hold a newline")
    if model.decode(model.encode("a  ﬁ B")) != "a  ﬁ B":
        raise ValueError("the model normalises texts")
    score = np.array([model.get_score(k) for k in range(size)], np.float32)
    merged = bool(np.all(score[normal] == np.floor(score[normal])))  # log probabilities are no whole numbers
    rank = np.zeros(size, np.int64)
    rank[normal] = np.unique(-score[normal], return_inverse=True)[1]
    left, right = np.full(size, -1), np.full(size, -1)
    if merged:
        by_text = {spaced[k]: k for k in normal}
        ranks = {p: int(rank[k]) for p, k in by_text.items()}
        made = {k: _last_merge(spaced[k], ranks) for k in normal}
        normal = [k for k in normal if made[k]]  # others never come out
        for k in normal:
            if made[k][0]:
                left[k], right[k] = by_text[made[k][0]], by_text[made[k][1]]
            else:
                rank[k] = -1  # a character is there from the start
    byte_ids = np.zeros(256, np.int32)
    for k in np.flatnonzero(is_byte):
        byte_ids[int(shown[k][1:-1], 16)] = k
    value = {int(i): b for b, i in enumerate(byte_ids)}
    raw = [bytes([value[k]]) if k in value else spaced.get(k, "").encode() for k in range(size)]
    starts = np.append(0, np.cumsum([len(r) for r in raw]))
    text = b"".join(raw)
    known = np.array(normal)
    running, inverse = W.running_hash(np.frombuffer(text, np.uint8), _CODES)
    with np.errstate(over="ignore"):
        at_zero = (running[starts[1:]] - running[starts[:-1]]) * inverse[starts[:-1]]
        keys = W.mix(at_zero[known] + np.diff(starts)[known].astype(np.uint64))
    order = np.argsort(keys)
    keys = keys[order]
    bits, at, many = np.unique(keys >> np.uint64(44), return_index=True, return_counts=True)
    first = np.full(1 << 20, -1, np.int32)
    first[bits.astype(np.int64)] = at
    return Pieces(
        keys, known[order].astype(np.int32), score[known][order], first, int(many.max()), max(map(len, spaced.values())), byte_ids,
        float(score[known].min() - np.float32(UNKNOWN_PENALTY)), model.encode("a", out_type=str)[0].startswith("▁"), text, starts,
        Merges(rank, left, right, at_zero, W.powers(int(np.diff(starts).max()) + 1)) if merged else None,
    )


def _stay_apart(pieces: Pieces, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Whether merging the text of two pieces by itself gives the two pieces.

    The two are unmade step by step, the later one first. At each step the pieces that meet must not make
    a piece earlier than either was used; of merges of equal rank the one further left comes first.
    """
    m = pieces.merges
    apart = np.ones(len(first), bool)
    open_ = np.flatnonzero((first >= 0) & (second >= 0))
    a, b = first[open_], second[open_]
    used_a, used_b = np.full(len(a), 1 << 40), np.full(len(a), 1 << 40)
    sizes = np.diff(pieces.text_starts)
    while len(open_):
        with np.errstate(over="ignore"):
            hashes = W.mix(m.raw[a] + m.raw[b] * m.powers[sizes[a]] + (sizes[a] + sizes[b]).astype(np.uint64))
        rows, at = _look_up(pieces, hashes)
        made = m.rank[pieces.ids[at]]
        joined = rows[(made < used_a[rows]) & (made <= used_b[rows])]
        apart[open_[joined]] = False
        go = (m.left[a] >= 0) | (m.left[b] >= 0)
        go[joined] = False
        open_, a, b, used_a, used_b = (x[go] for x in (open_, a, b, used_a, used_b))
        of_a = m.rank[a] > m.rank[b]
        used_a, used_b = np.where(of_a, m.rank[a], used_a), np.where(of_a, used_b, m.rank[b])
        a, b = np.where(of_a, m.right[a], a), np.where(of_a, b, m.left[b])
    return apart


def _look_up(pieces: Pieces, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose hash is a piece's, and the pieces' places among the keys."""
    at = pieces.first[(hashes >> np.uint64(44)).astype(np.int64)]
    rows = np.flatnonzero(at >= 0)
    at, hashes = at[rows], hashes[rows]
    same = pieces.keys[at] == hashes
    for _ in range(1, pieces.most):
        at = np.where(same, at, np.minimum(at + 1, len(pieces.keys) - 1))
        same |= pieces.keys[at] == hashes
    return rows[same], at[same]


class Memory:
    """What a task has found: which pairs of pieces stay apart, and the ids of units.

    Of pairs a newer one takes an older one's place. It changes the time and no result.
    """

    def __init__(self, bits: int = 20):
        self.shift = np.uint64(64 - bits)
        self.pairs = np.full(1 << bits, -1, np.int64)
        self.apart = np.zeros(1 << bits, bool)
        self.forget()

    def forget(self) -> None:
        self.units = np.zeros(0, np.uint64)  # sorted hashes
        self.begins, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def find(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each unit is known, and its place."""
        at = np.searchsorted(self.units, units)
        known = at < len(self.units)
        known[known] = self.units[at[known]] == units[known]
        return known, at

    def add(self, units: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        order = np.argsort(merged := np.concatenate([self.units, units]), kind="stable")
        begins = len(self.ids) + np.cumsum(lengths) - lengths
        self.units = merged[order]
        self.begins, self.lengths = np.concatenate([self.begins, begins])[order], np.concatenate([self.lengths, lengths])[order]
        self.ids = np.concatenate([self.ids, ids])

    def stay_apart(self, pieces: Pieces, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        apart = np.ones(len(first), bool)
        some = np.flatnonzero((first >= 0) & (second >= 0))
        pair = first[some].astype(np.int64) << 32 | second[some]
        with np.errstate(over="ignore"):
            slot = (pair.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)
        known = self.pairs[slot] == pair
        apart[some] = self.apart[slot]
        new, where = some[~known], slot[~known]
        if len(new):
            found = _stay_apart(pieces, first[new], second[new])
            apart[new] = found
            # Of several new pairs with one place the last is kept, with its own answer.
            self.pairs[where] = pair[~known]
            kept = self.pairs[where] == pair[~known]
            self.apart[where[kept]] = found[kept]
        return apart


def _best_paths(pieces: Pieces, edges: np.ndarray, running: np.ndarray, inverse: np.ndarray, memory: Memory) -> np.ndarray:
    """Unit, first byte, end byte and id (-1 for none) of the pieces on the best path of each unit.

    ``edges`` has a column for each unit: the bytes at which its characters begin, and its end.
    """
    length, n = edges.shape[0] - 1, edges.shape[1]
    sums, scale = running[edges], inverse[edges]
    best = np.full((length + 1, n), -np.inf, np.float32)
    best[0] = 0
    back = np.zeros((length + 1, n), np.int32)
    piece = np.full((length + 1, n), -1, np.int32)
    with np.errstate(over="ignore"):
        for end in range(1, length + 1):
            for size in range(min(end, pieces.longest), 0, -1):
                a = end - size
                hashes = W.mix((sums[end] - sums[a]) * scale[a] + (edges[end] - edges[a]).astype(np.uint64))
                rows, at = _look_up(pieces, hashes)
                if size == 1:  # a character without a piece
                    lone = np.ones(n, bool)
                    lone[rows] = False
                    lone = np.flatnonzero(lone)
                    total = best[a, lone] + np.float32(pieces.unknown)
                    better = lone[total > best[end, lone]]
                    best[end, better], back[end, better], piece[end, better] = total[total > best[end, lone]], a, -1
                total = best[a, rows] + pieces.scores[at]
                better = total > best[end, rows]
                if pieces.merges and a:
                    better &= memory.stay_apart(pieces, piece[a, rows], pieces.ids[at])
                rows, at = rows[better], at[better]
                best[end, rows], back[end, rows], piece[end, rows] = total[better], a, pieces.ids[at]
    found, rows, end = [], np.arange(n), np.full(n, length)
    while len(rows):
        begin = back[end, rows]
        found.append(np.stack([rows, edges[begin, rows], edges[end, rows], piece[end, rows]]))
        rows, end = rows[begin > 0], begin[begin > 0]
    found = np.concatenate(found, axis=1)
    return found[:, np.lexsort((found[1], found[0]))]


def _long_path(pieces: Pieces, edges: np.ndarray, running: np.ndarray, inverse: np.ndarray, memory: Memory) -> np.ndarray:
    """The path of one long unit of a model of merges, from overlapping windows that advance together.

    Where two windows have two pieces after each other in common, their paths are joined between these. Then
    all neighbours of the joined path stay apart, and only one path is like that, so it is the path of the whole
    unit. If some windows have no such place, all are made longer, in the end as long as the unit.
    """
    length, step = len(edges) - 1, LONG_UNIT // 2
    while True:
        size = step + step // 2  # the second half of a step is in the next window, too
        starts = np.arange(0, max(1, length - step // 2), step)
        whole = starts[starts + size <= length]
        found: list[np.ndarray] = []
        room = max(1, TOGETHER // (size + 1))
        for at in range(0, len(whole), room):
            group = whole[at : at + room]
            path = _best_paths(pieces, edges[group + np.arange(size + 1)[:, None]], running, inverse, memory)
            cut = np.searchsorted(path[0], np.arange(len(group) + 1))
            found += [path[:, a:b] for a, b in zip(cut[:-1], cut[1:])]
        for start in starts[len(whole) :].tolist():
            found.append(_best_paths(pieces, edges[start:, None], running, inverse, memory))
        joined = [found[0]]
        for path in found[1:]:
            before = joined[-1]
            # Pieces of both, by first and last byte, with their follower.
            _, i, j = np.intersect1d(before[1, :-1], path[1, :-1], assume_unique=True, return_indices=True)
            same = (before[2:, i] == path[2:, j]).all(0) & (before[2:, i + 1] == path[2:, j + 1]).all(0)
            if not same.any():
                break
            k = int(np.flatnonzero(same)[0])
            joined[-1] = before[:, : i[k] + 1]
            joined.append(path[:, j[k] + 1 :])
        else:
            return np.concatenate(joined, axis=1)
        step *= 4


def _encode_units(
    pieces: Pieces, units: W.Words, chosen: np.ndarray, running: np.ndarray, inverse: np.ndarray, memory: Memory
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the chosen units, one after the other, and how many each has."""
    data = units.data
    leads = (data & 0xC0) != 0x80
    begins, before = np.flatnonzero(leads).astype(np.int32), np.zeros(len(data) + 1, np.int32)
    np.cumsum(leads, out=before[1:])
    first = before[units.starts[chosen]]
    chars = before[units.ends[chosen]] - first
    parts = []
    order = np.argsort(chars, kind="stable")
    if pieces.merges:
        long = order[chars[order] > LONG_UNIT]
        order = order[: len(order) - len(long)]
        for k in long.tolist():
            edges = np.append(begins[first[k] : first[k] + chars[k]], units.ends[chosen[k]]).astype(np.int64)
            path = _long_path(pieces, edges, running, inverse, memory)
            path[0] = k
            parts.append(path)
    cut = np.flatnonzero(np.diff(chars[order], prepend=-1, append=-1))
    for a, b in zip(cut[:-1], cut[1:]):
        length = int(chars[order[a]])
        room = max(1, TOGETHER // (length + 1))
        for at in range(a, b, room):
            group = order[at : min(b, at + room)]
            edges = np.empty((length + 1, len(group)), np.int64)
            edges[:-1] = begins[first[group] + np.arange(length)[:, None]]
            edges[-1] = units.ends[chosen[group]]
            path = _best_paths(pieces, edges, running, inverse, memory)
            path[0] = group[path[0]]
            parts.append(path)
    if not parts:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    path = np.concatenate(parts, axis=1)
    path = path[:, np.argsort(path[0], kind="stable")]
    unit, a, b, piece = path
    many = np.where(piece >= 0, 1, b - a)  # a character without a piece is its bytes
    ids = np.repeat(piece, many)
    missing = ids < 0
    ids[missing] = pieces.byte_ids[data[W.gather(a, many)[missing]]]
    return ids.astype(np.int32), np.bincount(unit, many, len(chosen)).astype(np.int64)


def encode_block(
    pieces: Pieces, starts: np.ndarray, data: np.ndarray, memory: Memory | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts of a block, and where each text's ids begin."""
    sizes = np.diff(starts)
    if pieces.prefix:
        put = np.zeros(len(sizes), np.int64) + (sizes > 0)
        with_space = np.full(len(data) + int(put.sum()), _SPACE, np.uint8)
        shifted = starts + np.append(0, np.cumsum(put))
        with_space[W.gather(shifted[:-1] + put, sizes)] = data
        starts, data = shifted, with_space
    opens = np.zeros(len(data) + 1, bool)
    opens[starts] = True
    line, space = data == _NEWLINE, data == _SPACE
    opens[:-1] |= line
    opens[1:-1] |= line[:-1] | (space[1:] & ~space[:-1])
    at = np.flatnonzero(opens[:-1])
    units = W.Words(data, starts, at, np.append(at[1:], len(data)), np.searchsorted(at, starts))
    running, inverse = W.running_hash(data, _CODES)
    hashes, first, kind = W.distinct(W.hash_ranges(running, inverse, units.starts, units.ends))
    memory = memory or Memory()
    if len(memory.units) > REMEMBERED:
        memory.forget()
    known, _ = memory.find(hashes)
    ids, lengths = _encode_units(pieces, units, first[~known], running, inverse, memory)
    memory.add(hashes[~known], lengths, ids)
    _, at = memory.find(hashes)
    at = at[kind]
    many = memory.lengths[at]
    edges = np.append(0, np.cumsum(many))[units.first_word]
    return memory.ids[W.gather(memory.begins[at], many)], edges


def decode_block(pieces: Pieces, ids: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts of a block of ids, and where each text begins."""
    if len(ids) and (ids.min() < 0 or ids.max() >= len(pieces.text_starts) - 1):
        raise ValueError("not a piece")
    text = np.frombuffer(pieces.text, np.uint8)
    many = pieces.text_starts[ids + 1] - pieces.text_starts[ids]
    data = text[W.gather(pieces.text_starts[ids], many)]
    starts = np.append(0, np.cumsum(many))[edges]
    if pieces.prefix:
        lead = starts[:-1][np.diff(starts) > 0]
        lead = lead[data[lead] == _SPACE]
        starts = starts - np.searchsorted(lead, starts)
        data = np.delete(data, lead)
    return data, starts


def encoded(docs: DataFrame, pieces: Pieces, check: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row; with ``check`` also whether decoding gives the text again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory()
        for batch in batches:
            for rows, starts, data in W.chunks(batch.column("text"), BLOCK_BYTES):
                ids, edges = encode_block(pieces, starts, data, memory)
                null = batch.column("text")[rows].is_null().to_numpy(zero_copy_only=False)
                masked = pa.array(edges.astype(np.int32), mask=np.append(null, False))
                columns = [batch.column("doc_id")[rows], pa.array(np.diff(edges), mask=null), pa.ListArray.from_arrays(masked, pa.array(ids))]
                if check:
                    back, begins = decode_block(pieces, ids, edges)
                    same = [np.array_equal(back[begins[k] : begins[k + 1]], data[starts[k] : starts[k + 1]]) for k in range(len(null))]
                    columns.append(pa.array(same, pa.bool_(), mask=null))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids", "round_trip"][: len(columns)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids array<int>" + ", round_trip boolean" * check
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decoded(rows: DataFrame, pieces: Pieces) -> DataFrame:
    """``doc_id, text`` of rows with ``doc_id`` and ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids").cast(pa.large_list(pa.int32()))
            null = ids.is_null().to_numpy(zero_copy_only=False)
            lengths = np.where(null, 0, np.diff(ids.offsets.to_numpy()))
            data, starts = decode_block(pieces, ids.flatten().to_numpy().astype(np.int64), np.append(0, np.cumsum(lengths)))
            raw = data.tobytes()
            texts = [None if null[k] else raw[starts[k] : starts[k + 1]].decode("utf-8", "replace") for k in range(len(null))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")
