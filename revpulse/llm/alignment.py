"""Alignment of two tokenizers' tokens, with corpus-wide counts of the pairs that meet.

Both tokenizers cut the bytes of a text with a space in front. Offsets at which tokens of both end cut
the text into groups; every token of A in a group is linked with every token of B in it. For each pair of
ids the number of documents that hold it linked is counted over the corpus.

The count is an external one. A task turns each block of about ``BLOCK_BYTES`` of texts into a run: its records
(pair, document, links), sorted by pair, and its pairs with their number of documents, dealt by a radix of the A id to
``RADIXES`` parts and compressed with zstd in blocks. Up to ``FAN_IN`` runs of a radix are merged at a time
through a heap of the runs' open blocks, until one is left: equal pairs collapse at every step, so a pair that is in every document
is a single number in each run and no key gathers records anywhere. Pairs are ordered by their A id first, so
the last merge sees all pairs of an A id in a row and yields its highest count as it goes. The counts
then go back the way the runs came, each run getting those of its own pairs in its own order, and a run
adds them up for its documents. What a task holds is bounded by a block of texts, by ``FAN_IN`` open blocks, or by the
distinct pairs of one radix, which the two vocabularies bound.

Units of a text that neither tokenizer crosses are encoded once a task and remembered by a 64-bit hash.

Defined results: texts that are null, empty or whose tokens do not give back their bytes (such as those with
a U+2581, which B reads as a space) have no tokens, and zeros. Repeated rows are separate documents. Rows
with a null id have a null id. An empty table gives an empty result. Columns other than ``doc_id`` and ``text`` are
not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import merges
from . import words as W
from .components import scratch
from .merges import Encode
from .packing import text_units
from .params import TOKEN_PATTERN
from .pieces import Memory
from .units import unit_ids

#: Bytes of texts in a run, about (a longer text is a run by itself).
BLOCK_BYTES = 1 << 21
#: Parts of the A ids, runs merged at once, pairs in a block of a run, links made at once.
RADIXES, FAN_IN, BLOCK_PAIRS, LINKS_AT_ONCE = 64, 256, 1 << 16, 1 << 20
#: Groups with more links than this are reduced to their distinct ids first.
MANY_LINKS = 1 << 12
#: Bits of an id and of a document's number within its run.
ID_BITS, DOC_BITS = 20, 24

_SPACE, _NEWLINE = ord(" "), ord("\n")


class Tokenizer(NamedTuple):
    """A tokenizer as its tasks need it: where texts may be cut, how units are encoded, each id's bytes."""

    units: Callable[[np.ndarray, np.ndarray], W.Words]
    encoder: Callable[[], Encode]  # made once a task
    text: np.ndarray  # bytes of all ids
    text_starts: np.ndarray

    @property
    def size(self) -> int:
        return len(self.text_starts) - 1


def _table(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(tokens), np.uint8), np.append(0, np.cumsum([len(t) for t in tokens])).astype(np.int64)


def byte_level(path: str, pattern: str = TOKEN_PATTERN) -> Tokenizer:
    """A byte-level vocabulary with the public pattern, read on the driver."""
    vocabulary = merges.load(path)
    if vocabulary.ends or vocabulary.lower:
        raise ValueError("the vocabulary changes texts")
    return Tokenizer(text_units, lambda: merges.encoder(vocabulary, pattern), *_table(vocabulary.tokens))


def spaced_pieces(path: str) -> Tokenizer:
    """A piece model that puts a space before a text and has byte pieces, read on the driver."""
    import sentencepiece

    with open(path, "rb") as file:
        model = file.read()
    loaded = sentencepiece.SentencePieceProcessor(model_proto=model)
    size = loaded.get_piece_size()
    shown = [loaded.id_to_piece(k) for k in range(size)]
    spaced = [p.replace("▁", " ") for p in shown]
    if loaded.encode("a\n b", out_type=str) != ["▁a", "<0x0A>", "▁b"] or any(" " in p.lstrip(" ") or "\n" in p for p in spaced):
        raise ValueError("pieces go on after a space or hold a newline, or no space is put before a text")
    tokens = [bytes([int(shown[k][1:-1], 16)]) if loaded.is_byte(k) else b"" if loaded.is_control(k) else spaced[k].encode() for k in range(size)]

    def units(starts: np.ndarray, data: np.ndarray) -> W.Words:
        opens = np.zeros(len(data) + 1, bool)
        opens[starts] = True
        line, space = data == _NEWLINE, data == _SPACE
        opens[:-1] |= line
        opens[1:-1] |= line[:-1] | (space[1:] & ~space[:-1])
        at = np.flatnonzero(opens[:-1])
        return W.Words(data, starts, at, np.append(at[1:], len(data)), np.searchsorted(at, starts))

    def encoder() -> Encode:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_proto=model)

        def encode(units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            # Behind a newline the library puts no space of its own; the two first ids are that space and the newline.
            made = library.encode(["\n" + unit.decode() for unit in units], num_threads=1)
            lengths = np.fromiter(map(len, made), np.int64, len(made)) - 2
            return np.fromiter((x for m in made for x in m[2:]), np.int32, int(lengths.sum())), lengths

        return encode

    return Tokenizer(units, encoder, *_table(tokens))


def _gives_back(tokenizer: Tokenizer, ids: np.ndarray, edges: np.ndarray, starts: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Whether the tokens of each text have its bytes."""
    many = tokenizer.text_starts[ids + 1] - tokenizer.text_starts[ids]
    made = tokenizer.text[W.gather(tokenizer.text_starts[ids], many)]
    begins = np.append(0, np.cumsum(many))[edges]
    same = np.diff(begins) == np.diff(starts)
    if same.all() and np.array_equal(made, data):
        return same
    for k in np.flatnonzero(same):
        same[k] = np.array_equal(made[begins[k] : begins[k + 1]], data[starts[k] : starts[k + 1]])
    return same


class Tokens(NamedTuple):
    """The tokens of one side that are in groups."""

    ids: np.ndarray
    doc: np.ndarray
    group: np.ndarray


def _side(tokenizer: Tokenizer, ids: np.ndarray, edges: np.ndarray, starts: np.ndarray, usable: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, documents and end offsets of the tokens of usable texts."""
    doc = np.repeat(np.arange(len(usable)), np.diff(edges))
    ids, doc = ids[usable[doc]], doc[usable[doc]]
    ends = np.cumsum(tokenizer.text_starts[ids + 1] - tokenizer.text_starts[ids])
    # The usable texts' bytes follow each other in ``ends``; moved to where the texts are in the block.
    sizes = np.where(usable, np.diff(starts), 0)
    return ids, doc, ends + (starts[:-1] - (np.cumsum(sizes) - sizes))[doc]


def groups_of(a: Tokenizer, b: Tokenizer, encode_a, encode_b, memories, starts: np.ndarray, data: np.ndarray) -> tuple[Tokens, Tokens, np.ndarray]:
    """The tokens of A and B of all texts of a block, with a space in front, and each group's document."""
    put = (np.diff(starts) > 0).astype(np.int64)
    shifted = starts + np.append(0, np.cumsum(put))
    spaced = np.full(len(data) + int(put.sum()), _SPACE, np.uint8)
    spaced[W.gather(shifted[:-1] + put, np.diff(starts))] = data
    starts, data = shifted, spaced
    ids_a, edges_a = unit_ids(a.units(starts, data), encode_a, memories[0])
    ids_b, edges_b = unit_ids(b.units(starts, data), encode_b, memories[1])
    usable = _gives_back(a, ids_a, edges_a, starts, data) & _gives_back(b, ids_b, edges_b, starts, data) & (np.diff(starts) > 0)
    ids_a, doc_a, ends_a = _side(a, ids_a, edges_a, starts, usable)
    ids_b, doc_b, ends_b = _side(b, ids_b, edges_b, starts, usable)
    both = np.zeros(len(data) + 1, bool)
    both[ends_a] = True
    of_b = np.zeros(len(data) + 1, bool)
    of_b[ends_b] = True
    both &= of_b
    before = np.cumsum(both) - both  # common ends before each offset
    group_doc = np.searchsorted(starts, np.flatnonzero(both), side="left") - 1
    return Tokens(ids_a, doc_a, before[ends_a]), Tokens(ids_b, doc_b, before[ends_b]), group_doc


def _distinct_in(tokens: Tokens, large: np.ndarray) -> tuple[np.ndarray, ...]:
    """Id, document, group and number of the tokens, those of large groups once for each id, by group."""
    many = np.ones(len(tokens.ids), np.int64)
    some = large[tokens.group]
    if not some.any():
        return tokens.ids, tokens.doc, tokens.group, many
    key, first, times = np.unique((tokens.group[some] << ID_BITS) | tokens.ids[some], return_index=True, return_counts=True)
    rest = ~some
    found = [np.concatenate(x) for x in (
        (tokens.ids[rest], tokens.ids[some][first]), (tokens.doc[rest], tokens.doc[some][first]), (tokens.group[rest], key >> ID_BITS), (many[rest], times)
    )]
    order = np.argsort(found[2], kind="stable")
    return tuple(x[order] for x in found)


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(values[order], first)


def linked(a: Tokens, b: Tokens, groups: int, code: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pair and document as one sorted number, and links of the pair in the document."""
    large = np.bincount(a.group, minlength=groups) * np.bincount(b.group, minlength=groups) > MANY_LINKS
    ids_a, doc, group_a, times_a = _distinct_in(a, large)
    ids_b, _, group_b, times_b = _distinct_in(b, large)
    many = np.bincount(group_b, minlength=groups)
    first = np.cumsum(many) - many
    made = np.cumsum(many[group_a])
    head = (code(ids_a.astype(np.uint64)) << np.uint64(ID_BITS + DOC_BITS)) | doc.astype(np.uint64)
    found = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    begin = 0
    while begin < len(ids_a):
        done = made[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(made, done + LINKS_AT_ONCE, side="right")))
        meets = many[group_a[begin:end]]
        at = W.gather(first[group_a[begin:end]], meets)
        keys = np.repeat(head[begin:end], meets) | (ids_b[at].astype(np.uint64) << np.uint64(DOC_BITS))
        part = _summed(keys, np.repeat(times_a[begin:end], meets) * times_b[at])
        found = _summed(*(np.concatenate(x) for x in zip(found, part))) if begin else part
        begin = end
    return found


def group_texts(a: Tokens, b: Tokens, docs: int, numbers: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3`` of every document: bytes, and where each document begins.

    ``numbers`` has the digits of all ids, and where each id's begin.
    """
    digits, begins = numbers
    sizes = np.diff(begins)
    side = np.append(np.zeros(len(a.ids), np.int64), np.ones(len(b.ids), np.int64))
    group, token, doc = (np.concatenate(x) for x in ((a.group, b.group), (a.ids, b.ids), (a.doc, b.doc)))
    order = np.argsort(2 * group + side, kind="stable")
    group, token, doc, side = group[order], token[order], doc[order], side[order]
    # Behind a token: a comma, behind the last of a side of a group another mark, behind a document's last none.
    last = np.append((group[1:] != group[:-1]) | (side[1:] != side[:-1]), True)[: len(group)]
    mark = np.where(~last, ord(","), np.where(side == 0, ord("|"), ord(";"))).astype(np.uint8)
    ends = np.append(doc[1:] != doc[:-1], True)[: len(doc)]
    length = sizes[token] + ~ends
    at = np.cumsum(length)
    out = np.empty(int(at[-1]) if len(at) else 0, np.uint8)
    out[at[~ends] - 1] = mark[~ends]
    out[W.gather(at - length, sizes[token])] = digits[W.gather(begins[token], sizes[token])]
    return out, np.append(0, np.cumsum(np.bincount(doc, length, docs).astype(np.int64)))


def _packed(*columns: np.ndarray) -> bytes:
    return zstandard.compress(b"".join(c.astype("<i8").tobytes() for c in columns), 1)


def _unpacked(block: bytes, columns: int) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(block), "<i8").reshape(columns, -1)


def blocks_of(keys: np.ndarray, values: np.ndarray) -> list[bytes]:
    """A sorted run in blocks; keys as differences."""
    return [_packed(np.diff(keys[at : at + BLOCK_PAIRS], prepend=0), values[at : at + BLOCK_PAIRS]) for at in range(0, len(keys), BLOCK_PAIRS)]


def _opened(blocks: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for block in blocks:
        keys, values = _unpacked(block, 2)
        yield np.cumsum(keys), values


def merged(runs: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct keys of sorted runs in order, with the sums of their values.

    Each run has one open block, and a heap holds their last keys. Whatever is not above the least of them
    is in the open blocks, so it can be summed and let go.
    """
    unread = [_opened(blocks) for blocks in runs]
    open_: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def read(k: int) -> None:
        block = next(unread[k], None)
        if block is None:
            open_.pop(k, None)
        else:
            open_[k] = block
            heapq.heappush(heap, (int(block[0][-1]), k))

    for k in range(len(runs)):
        read(k)
    while heap:
        least, parts = heap[0][0], []
        for k, (keys, values) in open_.items():
            n = int(np.searchsorted(keys, least, side="right"))
            parts.append((keys[:n], values[:n]))
            open_[k] = keys[n:], values[n:]
        yield _summed(*(np.concatenate(x) for x in zip(*parts)))
        while heap and heap[0][0] == least:
            read(heapq.heappop(heap)[1])


def with_maxima(stream: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Twice each pair's count, and one more if no pair of the same A id has a higher one.

    Pairs come by their A id; those of the last one are held until the next one begins.
    """

    def marked(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        side = keys >> ID_BITS
        first = np.flatnonzero(np.append(True, side[1:] != side[:-1]))
        most = np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(keys))))
        return keys, 2 * counts + (counts == most)

    held = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for part in stream:
        keys, counts = (np.concatenate(x) for x in zip(held, part))
        cut = int(np.searchsorted(keys >> ID_BITS, keys[-1] >> ID_BITS, side="left"))
        if cut:
            yield marked(keys[:cut], counts[:cut])
        held = keys[cut:], counts[cut:]
    if len(held[0]):
        yield marked(*held)


_PAIRS = "radix int, node long, blocks array<binary>"
_PAIRS_ARROW = pa.schema([("radix", pa.int32()), ("node", pa.int64()), ("blocks", pa.list_(pa.binary()))])
#: Rows of three kinds: of a document (place in its run), of a run's records (radix -1), of its pairs of a radix.
_MADE_ARROW = pa.schema(
    [("run", pa.int64()), ("radix", pa.int32()), ("place", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
     ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.large_string()), ("blocks", pa.list_(pa.binary()))]
)
_MADE = "run long, radix int, place int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, blocks array<binary>"


def _rows(n: int, **columns) -> pa.RecordBatch:
    made = {k: v.cast(_MADE_ARROW.field(k).type) if isinstance(v, pa.Array) else pa.array(v, _MADE_ARROW.field(k).type) for k, v in columns.items()}
    return pa.RecordBatch.from_arrays([made.get(f.name, pa.nulls(n, f.type)) for f in _MADE_ARROW], schema=_MADE_ARROW)


def _runs(a: Tokenizer, b: Tokenizer):
    """Per block of texts: a row for each document, one for the records, and one for the pairs of each radix."""
    stride = -(-a.size // RADIXES)

    def code(ids: np.ndarray) -> np.ndarray:  # radix first, then the id
        return ids % np.uint64(RADIXES) * np.uint64(stride) + ids // np.uint64(RADIXES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, memories = (a.encoder(), b.encoder()), (Memory(1), Memory(1))
        digits = _table([str(k).encode() for k in range(max(a.size, b.size))])
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for rows, starts, data in W.chunks(batch.column("text"), BLOCK_BYTES):
                of_a, of_b, group_doc = groups_of(a, b, *encode, memories, starts, data)
                n, groups = len(starts) - 1, len(group_doc)
                text, begins = group_texts(of_a, of_b, n, digits)
                links = np.bincount(of_a.group, minlength=groups) * np.bincount(of_b.group, minlength=groups)
                shown = pa.LargeStringArray.from_buffers(n, pa.py_buffer(begins.astype(np.int64)), pa.py_buffer(text))
                yield _rows(
                    n, run=np.full(n, number), place=np.arange(n), doc_id=batch.column("doc_id")[rows], n_a=np.bincount(of_a.doc, minlength=n),
                    n_b=np.bincount(of_b.doc, minlength=n), n_groups=np.bincount(group_doc, minlength=n),
                    n_links=np.bincount(group_doc, links, n).astype(np.int64), groups=shown,
                )
                keys, times = linked(of_a, of_b, groups, code)
                pairs = (keys >> np.uint64(DOC_BITS)).astype(np.int64)
                first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)])
                docs = (keys & np.uint64((1 << DOC_BITS) - 1)).astype(np.int64)
                many = np.diff(np.append(first, len(pairs)))
                if len(first):
                    yield _rows(1, run=[number], radix=[-1], blocks=[[_packed(many), _packed(docs, times)]])
                    pairs = pairs[first]
                    radix = (pairs >> ID_BITS) // stride
                    cut = np.searchsorted(radix, np.arange(RADIXES + 1))
                    some = [r for r in range(RADIXES) if cut[r] < cut[r + 1]]
                    parts = [blocks_of(pairs[cut[r] : cut[r + 1]], many[cut[r] : cut[r + 1]]) for r in some]
                    yield _rows(len(some), run=np.full(len(some), number), radix=some, blocks=parts)
                number += 1

    return run


def _merge(key: tuple, table: pa.Table) -> pa.Table:
    blocks = [block for keys, counts in merged(table.column("blocks").to_pylist()) for block in blocks_of(keys, counts)]
    return pa.table([[key[0].as_py()], [key[1].as_py()], [blocks]], schema=_PAIRS_ARROW)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            blocks = [block for keys, marks in with_maxima(_opened(row["blocks"])) for block in blocks_of(keys, marks)]
            yield pa.RecordBatch.from_arrays([pa.array([row["radix"]], pa.int32()), pa.array([row["node"]], pa.int64()), pa.array([blocks], pa.list_(pa.binary()))], schema=_PAIRS_ARROW)


def _hand_back(key: tuple, children: pa.Table, parent: pa.Table) -> pa.Table:
    """Each child's pairs with the marks that the parent has for them."""
    known = list(_opened(parent.column("blocks")[0].as_py()))
    keys, marks = (np.concatenate(x) for x in zip(*known))
    out = []
    for blocks in children.column("blocks").to_pylist():
        own = np.concatenate([k for k, _ in _opened(blocks)])
        out.append(blocks_of(own, marks[np.searchsorted(keys, own)]))
    return pa.table([children.column("radix"), children.column("node"), pa.array(out, pa.list_(pa.binary()))], schema=_PAIRS_ARROW)


_SUMS_ARROW = pa.schema([("run", pa.int64()), ("place", pa.int32()), ("n_best", pa.int64()), ("count_sum", pa.int64())])


def _add_up(records: pa.Table, marks: pa.Table) -> pa.Table:
    """Sums of one run's documents; its pairs are in the order of the radixes."""
    many, own = records.column("blocks")[0].as_py()
    many, (docs, times) = _unpacked(many, 1)[0], _unpacked(own, 2)
    back = marks.sort_by("radix").column("blocks").to_pylist()
    mark = np.repeat(np.concatenate([m for blocks in back for _, m in _opened(blocks)]), many)
    places = np.unique(docs)
    # Exact: integers, not bincount's doubles.
    _, best = _summed(docs, times * (mark & 1))
    _, total = _summed(docs, times * (mark >> 1))
    run = records.column("run")[0].as_py()
    return pa.table([np.full(len(places), run), places.astype(np.int32), best, total], schema=_SUMS_ARROW)


def aligned(docs: DataFrame, a: Tokenizer, b: Tokenizer, shown: Callable[[Column], Column] = lambda groups: groups, name: str = "groups") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum`` and the groups of every document.

    The groups are a text ``a1,a2|b1;a3|b2,b3`` of A's and B's ids, empty without tokens. ``shown`` may make
    something else of it, before it is moved.
    """
    if max(a.size, b.size) > 1 << ID_BITS:
        raise ValueError("a vocabulary has too many ids")
    spark, folder = docs.sparkSession, scratch(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts.mapInArrow(_runs(a, b), _MADE).write.option("compression", "zstd").parquet(f"{folder}/runs")
    made = spark.read.schema(_MADE).parquet(f"{folder}/runs")
    records = made.where("radix = -1").select("run", "blocks")

    # Up: runs of a radix are merged until one is left. Nodes of the first level are dealt by a hash.
    runs = records.count()
    levels = [made.where("radix >= 0").select("radix", F.col("run").alias("node"), "blocks")]
    nodes, parents = max(1, -(-runs // FAN_IN)), []
    while True:
        first = len(levels) == 1
        parents.append(F.pmod(F.xxhash64("node"), F.lit(nodes)) if first else F.floor(F.col("node") / FAN_IN).cast("long"))
        grouped = levels[-1].groupBy("radix", parents[-1].alias("parent"))
        path = f"{folder}/level-{len(levels)}"
        grouped.applyInArrow(_merge, _PAIRS).write.option("compression", "none").parquet(path)
        levels.append(spark.read.schema(_PAIRS).parquet(path))
        if nodes == 1:
            break
        nodes = -(-nodes // FAN_IN)

    # Down: the marks of the one run left go back to the runs that it was merged from.
    marks = levels.pop().mapInArrow(_finish, _PAIRS)
    for children, parent in zip(reversed(levels), reversed(parents)):
        marks = children.groupBy("radix", parent.alias("parent")).cogroup(marks.groupBy("radix", "node")).applyInArrow(_hand_back, _PAIRS)
    sums = records.groupBy("run").cogroup(marks.groupBy("node")).applyInArrow(_add_up, "run long, place int, n_best long, count_sum long")
    of_docs = made.where("place is not null").select("run", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", shown(F.col("groups")).alias(name))
    counted = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return of_docs.join(sums, ["run", "place"], "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", *counted, name)
