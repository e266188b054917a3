"""Documents packed into as few token sequences as possible by a grouping genetic algorithm on islands.

A document becomes the ids of a public vocabulary and one id that ends it. What is longer than a sequence is cut into
whole sequences and a rest; whole ones need no packing. The other pieces are dealt to shards of about
``SHARD`` pieces by a hash. Each shard is worked on by several islands, each a task with a population of
packings: best fit decreasing and noisy variants of it. Crossover injects whole well-filled bins of one
parent into the other, takes out the bins that hold the same pieces, and puts the pieces displaced by that
back by best fit, longest first; mutation does so with a few badly filled bins. After each round every
island hands its best packing to the next island of its shard. Islands stop at the lower bound, the tokens of
the shard divided by the width.

The badly filled bins of all shards, at most a share ``POOLED`` of them, are opened, and their pieces packed anew in
far fewer shards, until one shard holds them; so the number of shards costs next to no sequences.

Packing moves keys and lengths only. All random choices come from seeds, so a lost task gives the same
packing when it is made again, up to the keys, which are fixed once the pieces are written.

Defined results: a null or empty text is its end id. Repeated rows, also with null ids, are packed as often as
they are there. An empty table gives an empty result. Columns other than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import merges
from . import words as W
from .components import scratch, written
from .merges import Encode
from .packing import Rooms
from .pieces import Memory
from .units import unit_ids

#: Pieces of a shard, about, islands of a shard, packings of an island.
SHARD, ISLANDS, POPULATION = 8192, 2, 6
#: Rounds between which the best packings move on, and children of an island in a round.
ROUNDS, CHILDREN = 3, 12
#: Of the bins of a shard so many are opened and packed anew with those of other shards, at most.
POOLED = 0.05
#: Shares of a parent's bins that crossover injects, and of bins that mutation opens.
INJECTED, OPENED = (0.05, 0.4), 0.03
BLOCK_BYTES = 1 << 22

_SPACES = W.byte_set(W.SPACES)
_LETTER, _DIGIT = 1, 2
_KINDS = np.zeros(256, np.int8)
_KINDS[[*range(65, 91), *range(97, 123)]] = _LETTER
_KINDS[48:58] = _DIGIT
#: What ``word_units`` cuts out of plain words. Every other unit is a whole word.
_PLAIN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+|[0-9]|[^'<\x80-\xff]+")
_PIECES = "key long, doc_id long, piece int, start long, length long, ids binary"
_STATE = "shard long, island int, bins int, roughness double, lengths binary, population array<binary>"
_STATE_ARROW = pa.schema(
    [("shard", pa.int64()), ("island", pa.int32()), ("bins", pa.int32()), ("roughness", pa.float64()), ("lengths", pa.binary()), ("population", pa.list_(pa.binary()))]
)


def word_units(starts: np.ndarray, data: np.ndarray) -> W.Words:
    """Runs of letters, of other ASCII signs, and single digits; a word with anything that the public pattern treats otherwise is whole.

    Letters are those of ASCII and of U+00C0 to U+00FF, which every library takes for letters.
    """
    words = W.split_words(starts, data, _SPACES)
    kind, bad = _KINDS[data], data >= 128
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]  # the signs for times and divided by
    for at in (lead, lead + 1):
        kind[at], bad[at] = _LETTER, False
    bad |= data == ord("'")
    bad[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
    before = np.zeros(len(data) + 1, np.int32)
    np.cumsum(bad, out=before[1:])
    plain = before[words.ends] == before[words.starts]
    inside = np.zeros(len(data) + 1, np.int8)
    inside[words.starts[plain]] += 1
    inside[words.ends[plain]] -= 1
    opens = np.zeros(len(data), bool)
    opens[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    opens &= np.cumsum(inside[:-1], dtype=np.int8) > 0
    opens[words.starts] = True
    at = np.flatnonzero(opens)
    word = np.cumsum(np.isin(at, words.starts, assume_unique=True)) - 1
    ends = np.minimum(np.append(at[1:], len(data)), words.ends[word])
    return W.Words(data, starts, at, ends, np.searchsorted(at, starts))


def word_level(path: str) -> Callable[[], Encode]:
    """What makes an encoder of word units in a task; the file is read on the driver.

    The vocabulary has to lower the case, to drop white space and to cut at it, so a text's ids are those of its units.
    """
    import tokenizers

    vocabulary = merges.load(path)
    probe = tokenizers.Tokenizer.from_str(vocabulary.model)
    ids = lambda text: probe.encode(text, add_special_tokens=False).ids
    if not vocabulary.lower or ids(" A\tbc,d12's \n e ") != [x for t in ("A", "bc", ",", "d", "1", "2's", "e") for x in ids(t)]:
        raise ValueError("the vocabulary does not cut words as expected")
    return lambda: merges.encoder(vocabulary, r"[\s\S]+", _PLAIN.fullmatch)


def _cut(encoder, width: int, end: int):
    """A row for each piece of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, memory = encoder(), Memory(1)
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for rows, starts, data in W.chunks(batch.column("text"), BLOCK_BYTES):
                ids, edges = unit_ids(word_units(starts, data), encode, memory)
                sizes = np.diff(edges) + 1
                ends = np.cumsum(sizes)
                tokens = np.full(int(ends[-1]), end, "<u4")
                tokens[W.gather(ends - sizes, sizes - 1)] = ids
                many = -(-sizes // width)
                doc = np.repeat(np.arange(len(sizes)), many)
                piece = W.gather(np.zeros(len(many), np.int64), many)
                start = piece * width
                length = np.minimum(sizes[doc] - start, width)
                # Pieces follow each other as their documents do.
                offsets = np.append(0, np.cumsum(length)).astype(np.int64) * 4
                raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(offsets), pa.py_buffer(tokens)])
                columns = [number + np.arange(len(doc)), batch.column("doc_id")[rows].take(pa.array(doc)), pa.array(piece, pa.int32()), start, length, raw.cast(pa.binary())]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns], ["key", "doc_id", "piece", "start", "length", "ids"])
                number += len(doc)

    return run


def put_back(bins: np.ndarray, lengths: np.ndarray, width: int, noise: np.ndarray | None = None) -> np.ndarray:
    """A packing with the pieces of bin -1 put into the others by best fit, longest first; bins are numbered anew."""
    free = np.flatnonzero(bins < 0)
    kept = np.flatnonzero(bins >= 0)
    _, bins_of = np.unique(bins[kept], return_inverse=True)
    out = np.empty(len(bins), np.int32)
    out[kept] = bins_of
    if not len(free):
        return out
    room = width - np.bincount(bins_of, lengths[kept]).astype(np.int64) if len(kept) else np.zeros(0, np.int64)
    order = free[np.argsort(-(lengths[free] if noise is None else lengths[free] * noise[free]), kind="stable")]
    rooms, used = Rooms(width), len(room)
    for k in np.flatnonzero(room >= lengths[free].min()).tolist():
        rooms.put(int(room[k]), k)
    for piece, size in zip(order.tolist(), lengths[order].tolist()):
        found = rooms.take(size)
        left, k = found or (width, used)
        used += not found
        out[piece] = k
        if left > size:
            rooms.put(left - size, k)
    return out


def worth(bins: np.ndarray, lengths: np.ndarray, width: int) -> tuple[int, float]:
    """Number of bins, and how evenly filled they are (less is better in both): uneven bins leave room to empty some."""
    fill = np.bincount(bins, lengths) / width
    return len(fill), -float((fill**2).sum())


def crossed(mother: np.ndarray, father: np.ndarray, lengths: np.ndarray, width: int, rng: np.random.Generator) -> np.ndarray:
    """Whole well-filled bins of the father in the mother's packing."""
    fill = np.bincount(father, lengths)
    best = np.argsort(-fill, kind="stable")[: max(1, len(fill) // 2)]
    chosen = rng.choice(best, max(1, int(len(best) * rng.uniform(*INJECTED))), replace=False)
    number = np.full(len(fill), -1)
    number[chosen] = np.arange(len(chosen))
    injected = number[father]
    inside = injected >= 0
    emptied = np.zeros(int(mother.max()) + 1, bool)
    emptied[mother[inside]] = True
    child = np.where(emptied[mother], -1, mother + len(chosen))
    return put_back(np.where(inside, injected, child), lengths, width)


def mutated(bins: np.ndarray, lengths: np.ndarray, width: int, rng: np.random.Generator) -> np.ndarray:
    """Some bins opened, badly filled ones more likely."""
    room = width - np.bincount(bins, lengths)
    chance = room + 1.0
    opened = rng.choice(len(room), max(1, int(len(room) * OPENED)), replace=False, p=chance / chance.sum())
    is_open = np.zeros(len(room), bool)
    is_open[opened] = True
    return put_back(np.where(is_open[bins], -1, bins), lengths, width)


def lower_bound(lengths: np.ndarray, width: int) -> int:
    """Tokens divided by the width, or the pieces of which no two fit together."""
    return max(-(-int(lengths.sum()) // width), int((2 * lengths > width).sum()))


def evolved(population: list[np.ndarray], lengths: np.ndarray, width: int, children: int, rng: np.random.Generator) -> list[np.ndarray]:
    """The best packings after some children, best first; a child takes the worst one's place if it is better."""
    ranked = sorted(((worth(p, lengths, width), k, p) for k, p in enumerate(population)), key=lambda x: x[:2])
    bound = lower_bound(lengths, width)
    for k in range(children):
        if ranked[0][0][0] <= bound:
            break
        # The better of two, twice.
        mother, father = (ranked[min(rng.integers(len(ranked), size=2))][2] for _ in range(2))
        child = mutated(mother, lengths, width, rng) if mother is father else crossed(mother, father, lengths, width, rng)
        if rng.random() < 0.3:
            child = mutated(child, lengths, width, rng)
        rank = worth(child, lengths, width)
        if rank < ranked[-1][0] and all(rank != r for r, *_ in ranked):
            ranked[-1] = (rank, len(population) + k, child)
            ranked.sort(key=lambda x: x[:2])
    return [p for *_, p in ranked]


def first_packings(lengths: np.ndarray, width: int, population: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Best fit decreasing, and the same with noisy lengths as the order."""
    empty = np.full(len(lengths), -1)
    return [put_back(empty, lengths, width, None if not k else 1 + rng.uniform(0, 0.3, len(lengths))) for k in range(population)]


def _state(shard: int, island: int, lengths: np.ndarray, population: list[np.ndarray], width: int) -> list:
    bins, roughness = worth(population[0], lengths, width)
    return [shard, island, bins, roughness, lengths.astype("<i4").tobytes(), [p.astype("<i4").tobytes() for p in population]]


def _first(width: int, population: int, children: int, seed: int):
    """An island of a shard, with its first round."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard, island = (k.as_py() for k in key)
        lengths = np.sort(table.column("length").to_numpy())[::-1].astype(np.int64)
        rng = np.random.default_rng([seed, shard, island, 0])
        found = evolved(first_packings(lengths, width, population, rng), lengths, width, children, rng)
        return pa.table([[x] for x in _state(shard, island, lengths, found, width)], schema=_STATE_ARROW)

    return run


def _next(width: int, children: int, seed: int, round_: int):
    """A round of islands that have got a guest, which takes the worst packing's place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["lengths"], "<i4").astype(np.int64)
                population = [np.frombuffer(p, "<i4") for p in row["population"]]
                population[-1] = np.frombuffer(row["guest"], "<i4")
                rng = np.random.default_rng([seed, row["shard"], row["island"], round_])
                found = evolved(population, lengths, width, children, rng)
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(_state(row["shard"], row["island"], lengths, found, width), _STATE_ARROW)], schema=_STATE_ARROW)

    return run


_PLACED = "key long, length long, sequence_id long, offset long, pooled boolean"
_PLACED_ARROW = pa.schema([("key", pa.int64()), ("length", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("pooled", pa.bool_())])


def _place(width: int, level: int, pooled: float):
    """Sequence and offset of each piece of a shard, from the best packing; the worst bins are marked."""

    def run(key: tuple, pieces: pa.Table, best: pa.Table) -> pa.Table:
        pieces = pieces.sort_by([("length", "descending"), ("key", "ascending")])
        keys, lengths = (pieces.column(c).to_numpy().astype(np.int64) for c in ("key", "length"))
        bins = np.frombuffer(best.column("packing")[0].as_py(), "<i4").astype(np.int64)
        fill = np.bincount(bins, lengths).astype(np.int64)
        worst = np.zeros(len(fill), bool)
        worst[np.argsort(fill, kind="stable")[: int(np.ceil(len(fill) * pooled))]] = pooled > 0
        worst &= fill < width
        order = np.argsort(bins, kind="stable")
        ends = np.cumsum(lengths[order])
        offset = np.empty(len(keys), np.int64)
        offset[order] = ends - lengths[order] - (np.cumsum(fill) - fill)[bins[order]]
        return pa.table([keys, lengths, (level << 58) + (key[0].as_py() << 20) + bins, offset, worst[bins]], schema=_PLACED_ARROW)

    return run


def placed(sizes: DataFrame, width: int, folder: str, seed: int = 11, shard: int = SHARD, islands: int = ISLANDS, rounds: int = ROUNDS) -> list[DataFrame]:
    """Tables with ``key, sequence_id, offset`` of all rows of ``sizes(key, length)``, lengths from 1 below ``width``."""
    done, level = [], 0
    while True:
        sizes = written(sizes.select("key", "length"), f"{folder}/sizes-{level}")
        shards = max(1, -(-sizes.count() // shard))
        dealt = sizes.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
        settled = dealt.withColumn("island", F.explode(F.array(*[F.lit(k) for k in range(islands)])))
        state = settled.groupBy("shard", "island").applyInArrow(_first(width, POPULATION, CHILDREN, seed + level), _STATE)
        state = written(state, f"{folder}/islands-{level}-0")
        for k in range(1, rounds):
            guests = state.select("shard", ((F.col("island") + 1) % islands).alias("island"), F.col("population")[0].alias("guest"))
            state = written(state.join(guests, ["shard", "island"]).mapInArrow(_next(width, CHILDREN, seed + level, k), _STATE), f"{folder}/islands-{level}-{k}")
        best = state.groupBy("shard").agg(F.min_by(F.col("population")[0], F.struct("bins", "roughness", "island")).alias("packing"))
        last = shards == 1
        found = dealt.groupBy("shard").cogroup(best.groupBy("shard")).applyInArrow(_place(width, level, 0.0 if last else POOLED), _PLACED)
        found = written(found, f"{folder}/placed-{level}")
        done.append(found.where("not pooled").select("key", "sequence_id", "offset"))
        if last:
            return done
        sizes, level = found.where("pooled"), level + 1


def packed(
    docs: DataFrame, encoder, width: int = 2048, end: int = 0, shown: Callable[[Column], Column] = lambda ids: ids, name: str = "ids"
) -> DataFrame:
    """``doc_id, piece, start, length, sequence_id, offset`` and the ids of every piece.

    Ids are little-endian unsigned 32-bit numbers; ``shown`` may make something else of them, before they are
    moved. ``encoder`` is what ``word_level`` gives.
    """
    spark, folder = docs.sparkSession, scratch(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = written(texts.mapInArrow(_cut(encoder, width, end), _PIECES), f"{folder}/pieces")
    whole = pieces.where(F.col("length") == width).select("key", (-1 - F.col("key")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    for part in placed(pieces.where(F.col("length") < width), width, folder):
        whole = whole.union(part)
    shown_pieces = pieces.select("key", "doc_id", "piece", "start", "length", shown(F.col("ids")).alias(name))
    return shown_pieces.join(whole, "key").select("doc_id", "piece", "start", "length", name, "sequence_id", "offset")
