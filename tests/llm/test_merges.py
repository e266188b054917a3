"""The fast encoders against the library, word by word and text by text."""

import numpy as np
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from revpulse.llm import grouping as G
from revpulse.llm import merges as M
from revpulse.llm import packing, params, units
from revpulse.llm.pieces import Memory

TEXTS = st.lists(st.lists(st.sampled_from([*"abcxyzABCdr stm'<|>.,!#0123 \t\n\x0b\x1c\x85  éÉßÿ×÷İŒçΣςσ́​語🙂", "<|endoftext|>", "'re", "'LL", "lo"]), max_size=40).map("".join), max_size=5)


@pytest.fixture(scope="module", params=["word", "byte"])
def kind(request):
    path = {"word": params.WORD_VOCABULARY_JSON, "byte": params.BYTE_VOCABULARY_JSON}[request.param]
    library = tokenizers.Tokenizer.from_file(path)
    if request.param == "byte":
        library.encode_special_tokens = True
        return library, M.encoder(M.load(path), params.TOKEN_PATTERN), packing.text_units
    return library, G.word_level(path)(), G.word_units


def ids_of(kind, texts):
    raw = [t.encode() for t in texts]
    starts = np.append(0, np.cumsum([len(r) for r in raw])).astype(np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    found, edges = units.unit_ids(kind[2](starts, data), kind[1], Memory(1))
    return [found[a:b].tolist() for a, b in zip(edges[:-1], edges[1:])]


@given(TEXTS)
@settings(max_examples=300, deadline=None)
def test_ids_are_the_librarys(kind, texts):
    assert ids_of(kind, texts) == [e.ids for e in kind[0].encode_batch(texts, add_special_tokens=False)]


def test_every_token_and_many_words(kind):
    """Each token's own text, and neighbours of two tokens, as words."""
    shown = [t.removesuffix("</w>") for t in kind[0].get_vocab(with_added_tokens=False)]
    byte_of = M.byte_of_characters()
    words = [w for t in sorted(shown) if (w := bytes(byte_of[c] for c in t).decode("utf-8", "ignore"))]
    rng = np.random.default_rng(1)
    words += [words[a] + words[b] for a, b in rng.integers(0, len(words), (20_000, 2))]
    assert ids_of(kind, words) == [e.ids for e in kind[0].encode_batch(words, add_special_tokens=False)]


def test_units_are_small_and_in_order():
    raw = b"Caf\xc3\xa9.12,x don't a<|b  c\xc3\x97d"
    found = G.word_units(np.array([0, len(raw)]), np.frombuffer(raw, np.uint8))
    assert [raw[a:b] for a, b in zip(found.starts, found.ends)] == [b"Caf\xc3\xa9", b".", b"1", b"2", b",", b"x", b"don't", b"a<|b", b"c\xc3\x97d"]
