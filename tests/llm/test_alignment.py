import hashlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from revpulse.llm import alignment as A
from revpulse.llm import params, registry, units

SCHEMA = "doc_id long, text string, run long, groups string"


@pytest.fixture(scope="session")
def sides():
    return A.byte_level(params.BYTE_VOCABULARY_JSON), A.spaced_pieces(params.PIECE_MODEL)


def shown_bytes():
    """Bytes of the characters that byte-level vocabularies show."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    return {chr(b): b for b in keep} | {chr(256 + k): b for k, b in enumerate(rest)}


def brute_force(rows):
    """By the libraries, whole text by whole text: doc_id and the seven columns, in the order of the rows."""
    import sentencepiece
    import tokenizers

    a = tokenizers.Tokenizer.from_file(params.BYTE_VOCABULARY_JSON)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=params.PIECE_MODEL)
    shown = shown_bytes()

    def b_bytes(k):
        piece = b.id_to_piece(k)
        return bytes([int(piece[1:-1], 16)]) if b.is_byte(k) else piece.replace("▁", " ").encode()

    found = []
    for doc_id, text in rows:
        groups = []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            raw_a, raw_b = [bytes(shown[c] for c in a.id_to_token(k)) for k in ids_a], [b_bytes(k) for k in ids_b]
            if b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
                ends_a, ends_b = np.cumsum([len(x) for x in raw_a]).tolist(), np.cumsum([len(x) for x in raw_b]).tolist()
                both = sorted(set(ends_a) & set(ends_b))
                for low, high in zip([0, *both], both):
                    groups.append(([i for i, e in zip(ids_a, ends_a) if low < e <= high], [i for i, e in zip(ids_b, ends_b) if low < e <= high]))
        found.append((doc_id, groups))
    docs_of = Counter(p for _, groups in found for p in {p for x, y in groups for p in product(x, y)})
    most = defaultdict(int)
    for (x, _), n in docs_of.items():
        most[x] = max(most[x], n)
    out = []
    for doc_id, groups in found:
        links = [p for x, y in groups for p in product(x, y)]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append(
            (doc_id, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
             sum(docs_of[p] == most[p[0]] for p in links), sum(docs_of[p] for p in links), text)
        )
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def rows_of(spark, rows, sides):
    table = spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA).repartition(5)
    return sorted((tuple(r[c] for c in COLUMNS) for r in A.aligned(table, *sides).collect()), key=repr)


ODD = [
    None, "", " ", "  ", "\n", " \n \n", "a", "<|endoftext|> and <s> </s> <unk> <0x41>", "a▁b", "▁", "x y z ​", "a\0b\x1cc\x1fd",
    "日本語のテキスト、空白なし。", "naïve café — “quoted” ﬁ é", "don't  we'll   they've\r\n\ttab", "🙂🙂 👩‍👩‍👧 ", "a" * 5000, "ab1" * 3000, " " * 700, "the " * 400,
]


def test_documents_equal_brute_force(spark, data, sides, monkeypatch):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{data}/documents.parquet").where("length(text) < 4000").limit(60).collect()]
    rows = docs + [(1000 + k, t) for k, t in enumerate(ODD)] + [(1000, "again the same id"), (None, "no id at all"), (None, None), docs[0], docs[0]]
    expect = sorted(brute_force(rows), key=repr)
    assert rows_of(spark, rows, sides) == expect
    # Many small runs, blocks and merges.
    for name, value in (("BLOCK_BYTES", 500), ("FAN_IN", 3), ("BLOCK_PAIRS", 7), ("LINKS_AT_ONCE", 50), ("MANY_LINKS", 6), ("RADIXES", 5)):
        monkeypatch.setattr(A, name, value)
    monkeypatch.setattr(units, "REMEMBERED", 40)
    assert rows_of(spark, rows, sides) == expect


def test_query_equals_brute_force(spark, tmp_path):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(k, "one two  three") for k in range(40, 70)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.op12_token_alignment(spark, str(tmp_path)).collect()
    digest = {r[0]: hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "" for r in brute_force(rows)}
    assert {r["doc_id"]: r["groups_sha256"] for r in got} == digest and len(got) == len(rows)


def test_no_documents(spark, sides):
    assert rows_of(spark, [], sides) == []
    assert rows_of(spark, [(3, None)], sides) == [(3, 0, 0, 0, 0, 0, 0, "")]


@given(st.lists(st.dictionaries(st.integers(0, 60), st.integers(1, 9)), max_size=9))
@settings(deadline=None)
def test_merge_of_runs(runs):
    size, A.BLOCK_PAIRS = A.BLOCK_PAIRS, 4
    try:
        blocks = [A.blocks_of(np.array(sorted(r), np.int64), np.array([r[k] for k in sorted(r)], np.int64)) for r in runs]
    finally:
        A.BLOCK_PAIRS = size
    total = sum((Counter(r) for r in runs), Counter())
    parts = list(A.merged(blocks))
    assert [int(k) for keys, _ in parts for k in keys] == sorted(total)
    assert all(total[int(k)] == n for keys, counts in parts for k, n in zip(keys, counts))


@given(st.dictionaries(st.tuples(st.integers(0, 5), st.integers(0, 9)), st.integers(1, 4)), st.integers(1, 7))
@settings(deadline=None)
def test_highest_counts(pairs, step):
    keys = np.array(sorted((a << A.ID_BITS) | b for a, b in pairs), np.int64)
    counts = np.array([pairs[k >> A.ID_BITS, k & 1023] for k in keys.tolist()], np.int64)
    stream = ((keys[k : k + step], counts[k : k + step]) for k in range(0, len(keys), step))
    got = {int(k): int(m) for ks, ms in A.with_maxima(stream) for k, m in zip(ks, ms)}
    most = defaultdict(int)
    for (a, _), n in pairs.items():
        most[a] = max(most[a], n)
    assert got == {(a << A.ID_BITS) | b: 2 * n + (n == most[a]) for (a, b), n in pairs.items()}


def test_models_that_do_not_fit_are_refused(spark, sides):
    with pytest.raises(ValueError):
        huge = sides[0]._replace(text_starts=np.zeros((1 << 20) + 2, np.int64))
        A.aligned(spark.createDataFrame([], SCHEMA), huge, sides[1])
