import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revpulse.llm import grouping as G
from revpulse.llm import params, registry

SCHEMA = "doc_id long, text string, key long, ids string"


@pytest.fixture(scope="session")
def encoder():
    return G.word_level(params.WORD_VOCABULARY_JSON)


def library():
    import tokenizers

    model = tokenizers.Tokenizer.from_file(params.WORD_VOCABULARY_JSON)
    return lambda text: [*model.encode(text or "", add_special_tokens=False).ids, 0]


def fewest(lengths, width):
    """The least number of bins, by trying every bin for every piece."""
    lengths, best = sorted(lengths, reverse=True), len(lengths)

    def go(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(lengths):
            best = len(rooms)
            return
        for room in set(rooms):
            if room >= lengths[k]:
                rest = list(rooms)
                rest[rest.index(room)] -= lengths[k]
                go(k + 1, rest)
        go(k + 1, [*rooms, width - lengths[k]])

    go(0, [])
    return best


def check_packing(rows, width):
    """Sequences are gapless from 0 and no longer than the width; the number of them."""
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= width
    return len(places)


def valid(bins, lengths, width):
    fill = np.bincount(bins, lengths)
    return len(bins) == len(lengths) and (fill > 0).all() and (fill <= width).all()


@given(st.lists(st.integers(1, 30), min_size=1, max_size=60), st.integers(0, 5))
@settings(max_examples=80, deadline=None)
def test_children_are_packings(sizes, seed):
    lengths, rng = np.array(sorted(sizes, reverse=True)), np.random.default_rng(seed)
    population = G.first_packings(lengths, 30, 4, rng)
    for _ in range(6):
        mother, father = (population[rng.integers(len(population))] for _ in range(2))
        population += [G.crossed(mother, father, lengths, 30, rng), G.mutated(father, lengths, 30, rng)]
    assert all(valid(p, lengths, 30) for p in population)
    found = G.evolved(population, lengths, 30, 10, rng)
    assert G.worth(found[0], lengths, 30)[0] <= min(G.worth(p, lengths, 30)[0] for p in population)
    assert G.worth(found[0], lengths, 30)[0] >= G.lower_bound(lengths, 30)


def test_crossover_keeps_whole_bins_of_the_father():
    rng = np.random.default_rng(3)
    lengths = np.sort(rng.integers(1, 60, 200))[::-1]
    mother, father = G.first_packings(lengths, 100, 2, rng)
    child = G.crossed(mother, father, lengths, 100, rng)
    groups = lambda bins: {frozenset(np.flatnonzero(bins == k).tolist()) for k in range(bins.max() + 1)}
    assert len(groups(child) & groups(father) - groups(mother)) >= 2


@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
@settings(max_examples=40, deadline=None)
def test_small_packings_are_the_fewest(sizes):
    lengths, rng = np.array(sorted(sizes, reverse=True)), np.random.default_rng(1)
    found = G.evolved(G.first_packings(lengths, 20, 6, rng), lengths, 20, 60, rng)
    assert G.worth(found[0], lengths, 20)[0] == fewest(sizes, 20)


def test_evolution_beats_best_fit_decreasing():
    """Pieces of full bins (510, 260, 230) and (270, 270, 230, 230), which best fit decreasing, and noise too, mixes up."""
    lengths = np.array([510] * 24 + [270] * 24 + [260] * 24 + [230] * 48)
    rng = np.random.default_rng(5)
    first = G.first_packings(lengths, 1000, 6, rng)
    found = G.worth(G.evolved(first, lengths, 1000, 400, rng)[0], lengths, 1000)[0]
    assert 36 <= found < min(G.worth(p, lengths, 1000)[0] for p in first) < G.worth(first[0], lengths, 1000)[0]


def test_documents_come_back_whole(spark, data, encoder):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    odd = [None, "", " \t\n", "A<|endoftext|>b <|startoftext|>", "ÉCOLE é İi ﬁ", "x\x1cy z", "日本語のテキスト " * 40, "don't we'll 12345", "word " * 700, "ab1" * 2000]
    rows = docs + [(10_000 + k, t) for k, t in enumerate(odd)] + [(None, "null id"), (None, None), docs[0], docs[0]]
    table = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA).repartition(4)
    for width in (2048, 100):
        got = G.packed(table, encoder, width).collect()
        ids, expect = library(), defaultdict(list)
        for k, t in rows:
            expect[k].append(ids(t))
        back = defaultdict(list)
        by_doc = defaultdict(list)
        for r in got:
            by_doc[r["doc_id"]].append((r["piece"], r["start"], r["length"], np.frombuffer(r["ids"], "<u4").tolist()))
        for k, pieces in by_doc.items():
            assert all(p * width == s and n == len(x) <= width for p, s, n, x in pieces)
            if len(expect[k]) == 1:
                pieces.sort()
                assert [p for p, *_ in pieces] == list(range(len(pieces))) and all(n == width for _, _, n, _ in pieces[:-1])
                back[k] = [[x for *_, part in pieces for x in part]]
            else:  # of repeated ids: as many pieces of every kind
                assert sorted(map(repr, pieces)) == sorted(repr((p, p * width, len(e[p * width : (p + 1) * width]), e[p * width : (p + 1) * width])) for e in expect[k] for p in range(-(-len(e) // width)))
                back[k] = expect[k]
        assert back == expect
        tokens = sum(len(e) for x in expect.values() for e in x)
        assert check_packing(got, width) <= 1.01 * tokens / width + 1


def test_shards_are_joined_by_pooling(spark, tmp_path):
    rng = np.random.default_rng(2)
    sizes = [(k, int(x)) for k, x in enumerate(np.minimum(rng.geometric(0.01, 4000), 499))]
    table = spark.createDataFrame(sizes, "key long, length long")
    found = G.placed(table, 500, f"{tmp_path}/a", shard=300, islands=2, rounds=2)
    assert len(found) >= 2
    length = dict(sizes)
    rows = [r.asDict() | {"length": length[r["key"]]} for part in found for r in part.collect()]
    assert sorted(r["key"] for r in rows) == sorted(length)
    assert check_packing(rows, 500) <= -(-sum(length.values()) // 500) + 3


def test_islands_are_the_same_when_made_again(spark, tmp_path):
    table = spark.range(900).select(F.col("id").alias("key"), (F.col("id") * 37 % 450 + 20).alias("length"))
    one, two = (sorted(map(tuple, G.placed(t, 1000, f"{tmp_path}/{k}", islands=3)[0].collect())) for k, t in (("one", table), ("two", table.repartition(5))))
    assert one == two


def test_no_documents(spark, encoder):
    assert G.packed(spark.createDataFrame([], SCHEMA), encoder).collect() == []


def test_query_gives_the_ids_checksum(spark, data):
    rows = registry.op11_group_packing(spark, data).collect()
    ids = library()
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    for r in rows:
        part = ids(text[r["doc_id"]])[r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes()) and len(part) == r["length"]
    assert sum(r["length"] for r in rows) == sum(len(ids(t)) for t in text.values())
    check_packing(rows, 2048)
