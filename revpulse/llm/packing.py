"""Token ids packed into matrices of fixed width, with best-fit-decreasing bins.

Texts are dealt to shards of about ``SHARD_BYTES`` by a hash of their id and text, so a shard does not depend on
how the input was split. Only rows that are there more than ``HOT`` times, id and text alike, are dealt by their place,
to as many shards as they need. A task packs its shards one after the other. In a shard every text becomes token ids and one end-of-text id. What is longer
than a row is cut into whole rows and a rest; nothing is dropped. The pieces are packed longest first, each
into the fullest row that still has room: a segment tree over the room left finds that row.

Each matrix is a row of the result: ids as little-endian ``uint16`` or ``uint32``, padded with the
end-of-text id, and for each of its rows the cumulative lengths of the segments (the last is where the
padding begins), the position of each token in its segment (positions start again at every segment, and
in the padding), and the document and token offset that each segment comes from.

Distinct pieces of text are encoded once for each shard: a text is cut where the public pattern of the
vocabulary always cuts, before the space in front of a word and around other white space.

Defined results: a null or empty text is one end-of-text id. Rows with a null id are packed with a null id.
Repeated rows are packed as often as they are there. An empty table gives an empty result. Columns other
than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

#: Bytes of texts in a shard, about, and rows of a matrix.
SHARD_BYTES, MATRIX_ROWS = 8 << 20, 64
#: Equal rows from which on they are spread, at least; at most 1,000 groups of them are.
HOT = 1000
#: Tasks, at most; beyond that each has several shards.
MOST_TASKS = 20_000

_CODES = W.byte_codes(fold_case=False)
# For the pattern, U+001C to U+001F are no white space, and some characters beyond ASCII are.
_SPACES = W.byte_set(W.SPACES)
#: First bytes of U+0085, U+00A0, U+1680, U+2000 to U+200A, U+2028, U+2029, U+202F, U+205F and U+3000.
_MAYBE_SPACE = W.byte_set(bytes([0xC2, 0xE1, 0xE2, 0xE3]))

SCHEMA = (
    "shard int, matrix int, n_rows int, width int, ids binary, positions binary, cu_seqlens array<array<int>>, "
    "doc_ids array<array<long>>, doc_offsets array<array<long>>"
)


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a byte-level vocabulary: a base64 token and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Rooms:
    """A segment tree over the room that rows have left: which room is the least that suffices?"""

    def __init__(self, width: int):
        self.leaves = 1 << width.bit_length()
        self.any = bytearray(2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(width + 1)]

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = self.leaves + room
        while node and not self.any[node]:
            self.any[node] = 1
            node //= 2

    def take(self, size: int) -> tuple[int, int] | None:
        """The room and a row of it, which is taken out; None if no row has room for ``size``."""
        node = self.leaves + size
        if not self.any[node]:
            while node & 1 or not self.any[node + 1]:  # up to a right sibling that holds any
                node //= 2
                if node <= 1:
                    return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.any[2 * node] else 2 * node + 1
        room = node - self.leaves
        row = self.rows[room].pop()
        if not self.rows[room]:
            self.any[node] = 0
            while node > 1 and not self.any[node ^ 1]:
                node //= 2
                self.any[node] = 0
        return room, row


def best_fit(sizes: np.ndarray, width: int) -> list[list[int]]:
    """Rows of pieces: longest first, each into the row with the least room that suffices."""
    rooms, rows = Rooms(width), []
    for k in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[k])
        found = rooms.take(size)
        room, row = found or (width, len(rows))
        if not found:
            rows.append([])
        rows[row].append(k)
        if room > size:
            rooms.put(room - size, row)
    return rows


def text_units(starts: np.ndarray, data: np.ndarray) -> W.Words:
    """Texts cut where the public pattern of byte-level vocabularies always cuts."""
    space = _SPACES[data]
    opens = np.zeros(len(data) + 1, bool)
    opens[starts] = True
    last = np.zeros(len(data), bool)  # last byte of a text
    last[starts[1:][np.diff(starts) > 0] - 1] = True
    # Next to a character that may be white space beyond ASCII a text is not cut.
    word = ~space & ~_MAYBE_SPACE[data]
    before_word = np.zeros(len(data), bool)
    before_word[:-1] = word[1:] & ~last[:-1]
    # White space begins; its last character, in front of a word; a word right after other than a space.
    opens[1:-1] |= space[1:] & ~space[:-1] & (data[:-1] < 128)
    opens[:-1] |= space & before_word
    opens[1:-1] |= word[1:] & space[:-1] & (data[:-1] != 32)
    at = np.flatnonzero(opens[:-1])
    return W.Words(data, starts, at, np.append(at[1:], len(data)), np.searchsorted(at, starts))


def token_ids(encode, starts: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a block, and where each text's ids begin; ``encode`` makes a list of ids of a str."""
    units = text_units(starts, data)
    _, first, kind = W.distinct(W.hash_words(units, _CODES))
    raw = data.tobytes()
    made = [encode(raw[a:b].decode()) for a, b in zip(units.starts[first].tolist(), units.ends[first].tolist())]
    lengths = np.array([len(m) for m in made], np.int64)
    ids = np.fromiter((x for m in made for x in m), np.int64, int(lengths.sum()))
    many = lengths[kind]
    where = (np.cumsum(lengths) - lengths)[kind]
    return ids[W.gather(where, many)], np.append(0, np.cumsum(many))[units.first_word]


def _matrices(shard: int, docs: list, ids: list[np.ndarray], width: int, end: int, kind: np.dtype) -> Iterator[pa.RecordBatch]:
    cuts = [(d, at, min(at + width, len(x))) for d, x in enumerate(ids) for at in range(0, len(x), width)]
    rows = best_fit(np.array([b - a for _, a, b in cuts], np.int64), width)
    for m in range(0, len(rows), MATRIX_ROWS):
        part = rows[m : m + MATRIX_ROWS]
        matrix, positions = np.full((len(part), width), end, kind), np.zeros((len(part), width), kind)
        lengths, owners, offsets = [], [], []
        for r, row in enumerate(part):
            ends = [0]
            for k in row:
                d, a, b = cuts[k]
                at = ends[-1]
                matrix[r, at : at + b - a] = ids[d][a:b]
                positions[r, at : at + b - a] = np.arange(b - a)
                ends.append(at + b - a)
            positions[r, ends[-1] :] = np.arange(width - ends[-1])
            lengths.append(ends)
            owners.append([docs[cuts[k][0]] for k in row])
            offsets.append([cuts[k][1] for k in row])
        values = [shard, m // MATRIX_ROWS, len(part), width, matrix.tobytes(), positions.tobytes(), lengths, owners, offsets]
        types = [pa.int32()] * 4 + [pa.binary()] * 2 + [pa.list_(pa.list_(pa.int32()))] + [pa.list_(pa.list_(pa.int64()))] * 2
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], SCHEMA_NAMES)


SCHEMA_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def packed(docs: DataFrame, ranks: dict[bytes, int], pattern: str, width: int = 2048) -> DataFrame:
    """Matrices of all texts; ``ranks`` and ``pattern`` are those of a public byte-level vocabulary."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total, rows = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    shards = max(1, -(-total // SHARD_BYTES))
    tasks = min(shards, MOST_TASKS)
    docs = docs.withColumn("same", F.xxhash64("doc_id", "text"))
    # A group is more than a thousandth of all rows, so there are fewer than 1,000.
    hot = docs.groupBy("same").agg(F.count("*").alias("copies")).where(F.col("copies") > max(HOT, rows // 1000))
    part = F.coalesce(F.pmod(F.monotonically_increasing_id(), F.ceil(F.col("copies") / HOT).cast("long")), F.lit(0))
    shard = F.pmod(F.xxhash64("same", part), F.lit(shards)).cast("int")
    end = len(ranks)
    kind = np.dtype("<u2" if end < 1 << 16 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        encode = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        for shard, rows in _by_shard(batches):
            # Rows arrive in any order; sorted, the shard is the same whenever it is made again.
            rows, ids = rows.sort_by([("doc_id", "ascending"), ("text", "ascending")]), []
            for _, starts, data in W.chunks(rows.column("text").combine_chunks(), SHARD_BYTES):
                tokens, edges = token_ids(encode, starts, data)
                ids += [np.append(tokens[edges[k] : edges[k + 1]], end).astype(kind) for k in range(len(starts) - 1)]
            yield from _matrices(shard, rows.column("doc_id").to_pylist(), ids, width, end, kind)

    dealt = docs.join(F.broadcast(hot), "same", "left").select("doc_id", "text", shard.alias("shard")).repartitionById(tasks, F.pmod("shard", F.lit(tasks)).cast("int"))
    return (dealt.sortWithinPartitions("shard") if shards > tasks else dealt).mapInArrow(run, SCHEMA)


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each shard; rows come shard after shard."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        shards = batch.column("shard").to_numpy()
        edges = np.flatnonzero(np.diff(shards, prepend=shards[0] - 1)) if len(shards) else []
        for a, b in zip(edges, [*edges[1:], len(shards)]):
            if held and held[0].column("shard")[0].as_py() != shards[a]:
                yield held[0].column("shard")[0].as_py(), pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield held[0].column("shard")[0].as_py(), pa.Table.from_batches(held)


def unpacked(matrices: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``doc_id, offset, ids`` of every segment, as they went in (the last id of a text ends it)."""
    kind = np.dtype("<u2" if len(ranks) < 1 << 16 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for m in batch.to_pylist():
                matrix = np.frombuffer(m["ids"], kind).reshape(m["n_rows"], m["width"])
                found = [
                    (doc, offset, matrix[r, a:b].tolist())
                    for r in range(m["n_rows"])
                    for doc, offset, a, b in zip(m["doc_ids"][r], m["doc_offsets"][r], m["cu_seqlens"][r], m["cu_seqlens"][r][1:])
                ]
                docs, offsets, ids = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(offsets, pa.int64()), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "offset", "ids"])

    return matrices.mapInArrow(run, "doc_id long, offset long, ids array<int>")
