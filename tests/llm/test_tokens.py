"""SentencePiece ids against the library and a plain search, and packing."""

import random

import numpy as np
import pyarrow as pa
import pytest

from revpulse.llm import packing as K
from revpulse.llm import params
from revpulse.llm import pieces as P
from revpulse.llm import words as W

sentencepiece = pytest.importorskip("sentencepiece")
tiktoken = pytest.importorskip("tiktoken")

ODD = ["", " ", "   ", "\n", "  a  b\n\n c ", "日本語 ﷺ  émoji 😀😀 x\t\ty", "a" * 300, " " * 77 + "x", "▁ ▁▁a", "\x00\x1f", "it's 12'000 — ok"]


@pytest.fixture(scope="module")
def model():
    return P.load(params.PIECE_MODEL)


def fuzz(vocabulary, seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(vocabulary) for _ in range(rng.randrange(50))) for _ in range(n)]


def encode(model, texts, most=P.BLOCK_BYTES):
    out = []
    for _, starts, data in W.chunks(pa.array(texts, pa.string()), most):
        ids, edges = P.encode_block(model, starts, data)
        back, begins = P.decode_block(model, ids, edges)
        assert np.array_equal(back, data) and np.array_equal(begins, starts)
        out += [ids[a:b].tolist() for a, b in zip(edges, edges[1:])]
    return out


def test_ids_are_those_of_the_library(model):
    library = sentencepiece.SentencePieceProcessor(model_file=params.PIECE_MODEL)
    pieces = [library.id_to_piece(k).replace("▁", " ") for k in range(259, library.get_piece_size())]
    texts = ODD + fuzz(pieces, 1, 400) + fuzz("abcdeth o  n\n", 2, 300) + [" " * k + "x" + " " * k for k in range(40)]
    got = encode(model, texts)
    for text, ids in zip(texts, got):
        if "▁" not in text:
            assert ids == library.encode(text), text
    assert encode(model, texts, most=64) == got


def test_long_units_are_joined_from_windows(model, monkeypatch):
    """Texts without a space: letters, repeated signs and patterns, scripts without spaces, and mixtures."""
    library = sentencepiece.SentencePieceProcessor(model_file=params.PIECE_MODEL)
    rng = random.Random(4)
    pieces = [library.id_to_piece(k).replace("▁", "") for k in range(259, library.get_piece_size())]
    texts = ["".join(rng.choice(pieces) for _ in range(500)), "".join(rng.choice("abcdeth") for _ in range(3000)), "日本語のテキスト、空白なし。" * 100]
    texts += ["a" * n for n in (511, 512, 513, 2000)] + ["ab" * 700, "abc" * 500, "=" * 1000 + "x" + "-" * 700, "thethe" * 300, "🙂é" * 400]
    assert encode(model, texts) == [library.encode(t) for t in texts]
    monkeypatch.setattr(P, "LONG_UNIT", 24)
    texts = [t for t in texts + fuzz(pieces, 9, 60) + fuzz("aabbct", 5, 60) if " " not in t]
    assert encode(model, texts) == [library.encode(t) for t in texts]


def test_many_letters_without_a_space(model):
    import time

    library = sentencepiece.SentencePieceProcessor(model_file=params.PIECE_MODEL)
    rng = random.Random(8)
    text = "".join(rng.choice("etaoinshrdlu") for _ in range(300_000))
    begun = time.process_time()
    (ids,) = encode(model, [text])
    assert time.process_time() - begun < 10
    assert ids == library.encode(text)


def test_highest_sum_of_scores_for_a_unigram_model(model):
    """Without merges the search maximises the sum; a plain search over all ends is the answer."""
    scores = -np.log(np.arange(2, len(model.keys) + 2, dtype=np.float32))
    unigram = model._replace(merges=None, scores=scores, unknown=float(scores.min() - 10))
    by_id = dict(zip(unigram.ids.tolist(), scores.tolist()))
    text_of = lambda k: unigram.text[unigram.text_starts[k] : unigram.text_starts[k + 1]].decode()
    by_text = {text_of(k): s for k, s in by_id.items()}
    for text in fuzz("the andro in", 3, 60):
        (ids,) = encode(unigram, [text])
        shown = " " + text if text else ""
        best = [0.0] + [-np.inf] * len(shown)
        for end in range(1, len(shown) + 1):
            for a in range(max(0, end - unigram.longest), end):
                best[end] = max(best[end], best[a] + by_text.get(shown[a:end], -np.inf))
        assert np.isclose(sum(by_id[k] for k in ids), best[-1], rtol=1e-5)


def test_encoding_and_decoding_tables(spark, model):
    texts = ODD + [None, "x y" * 40000]
    docs = spark.createDataFrame([(k, t, [1]) for k, t in enumerate(texts)] + [(None, "z", [1])], "doc_id long, text string, ids array<int>")
    rows = P.encoded(docs, model, check=True)
    got = {r["doc_id"]: r for r in rows.collect()}
    assert all(r["round_trip"] for k, r in got.items() if k != len(ODD)) and got[len(ODD)]["ids"] is None
    assert all(r["n_tokens"] == len(r["ids"]) for r in got.values() if r["ids"] is not None)
    back = {r["doc_id"]: r["text"] for r in P.decoded(rows, model).collect()}
    assert back == dict(enumerate(texts)) | {None: "z"}
    assert P.encoded(docs.limit(0), model).count() == 0


@pytest.fixture(scope="module")
def vocabulary():
    return K.load_ranks(params.BYTE_VOCABULARY)


def test_token_ids_are_those_of_the_library(vocabulary):
    library = tiktoken.Encoding("own", pat_str=params.TOKEN_PATTERN, mergeable_ranks=vocabulary, special_tokens={})
    texts = ODD + fuzz(["a", " ", "\n", "\t", "'s", "1", "é", " ", " ", "　", "—", "\x1c", "\x0b", "."], 5, 600)
    for most in (1 << 20, 100):
        got = []
        for _, starts, data in W.chunks(pa.array(texts), most):
            ids, edges = K.token_ids(library.encode_ordinary, starts, data)
            got += [ids[a:b].tolist() for a, b in zip(edges, edges[1:])]
        assert got == [library.encode_ordinary(t) for t in texts]


def test_best_fit_decreasing_equals_a_plain_search():
    for seed in range(6):
        sizes = np.random.default_rng(seed).integers(1, 65, 400)
        rows = K.best_fit(sizes, 64)
        assert sorted(k for r in rows for k in r) == list(range(400))
        assert max(sizes[r].sum() for r in rows) <= 64
        room = []
        for size in sorted(sizes.tolist(), reverse=True):
            fitting = [(q, k) for k, q in enumerate(room) if q >= size]
            if fitting:
                room[min(fitting)[1]] -= size
            else:
                room.append(64 - size)
        assert sorted(64 - sizes[r].sum() for r in rows) == sorted(room)
    assert K.best_fit(np.zeros(0, np.int64), 8) == []


def test_packing_loses_nothing(spark, vocabulary, monkeypatch):
    monkeypatch.setattr(K, "SHARD_BYTES", 2000)
    library = tiktoken.Encoding("own", pat_str=params.TOKEN_PATTERN, mergeable_ranks=vocabulary, special_tokens={})
    texts = ODD + fuzz(["word", " ", "other", "\n"], 6, 60) + ["long text " * 300, None]
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, shard int")
    packed = K.packed(docs, vocabulary, params.TOKEN_PATTERN, width=32)
    whole = {}
    for r in sorted(K.unpacked(packed, vocabulary).collect(), key=lambda r: (r["doc_id"], r["offset"])):
        assert r["offset"] == len(whole.setdefault(r["doc_id"], []))
        whole[r["doc_id"]] += r["ids"]
    assert whole == {k: library.encode_ordinary(t or "") + [len(vocabulary)] for k, t in enumerate(texts)}
    again = K.packed(docs.repartition(7), vocabulary, params.TOKEN_PATTERN, width=32)
    key = lambda r: (r["shard"], r["matrix"])
    assert sorted(packed.collect(), key=key) == sorted(again.collect(), key=key)
    for m in packed.collect():
        ids, positions = (np.frombuffer(m[c], "<u2").reshape(m["n_rows"], 32) for c in ("ids", "positions"))
        for r, ends in enumerate(m["cu_seqlens"]):
            edges = ends + [32]
            assert ends[0] == 0 and np.array_equal(positions[r], np.concatenate([np.arange(b - a) for a, b in zip(edges, edges[1:])]))
            assert (ids[r, ends[-1] :] == len(vocabulary)).all()
    assert K.packed(docs.limit(0), vocabulary, params.TOKEN_PATTERN).count() == 0


def test_equal_rows_are_spread(spark, vocabulary, monkeypatch):
    """A row that is there over and over fills many shards, and tasks with several shards give the same matrices."""
    monkeypatch.setattr(K, "SHARD_BYTES", 300)
    monkeypatch.setattr(K, "HOT", 5)
    rows = [(7, "the same row")] * 200 + [(k, f"row {k}") for k in range(100)] + [(None, "no id")] * 60
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    shards = K.packed(docs, vocabulary, params.TOKEN_PATTERN, width=32)
    held = {r["shard"]: sum(x == 7 for ids in r["doc_ids"] for x in ids) for r in shards.collect()}
    assert max(held.values()) < 60 and sum(held.values()) == 201
    back = K.unpacked(shards, vocabulary).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in back} == {None: 60, 7: 201} | {k: 1 for k in range(100) if k != 7}
    plain = docs.dropDuplicates()
    one = sorted(map(repr, K.packed(plain, vocabulary, params.TOKEN_PATTERN, width=32).collect()))
    monkeypatch.setattr(K, "MOST_TASKS", 2)
    assert sorted(map(repr, K.packed(plain, vocabulary, params.TOKEN_PATTERN, width=32).collect())) == one
