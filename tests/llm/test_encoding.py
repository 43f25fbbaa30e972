import hashlib
import unicodedata
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tabflow.llm import bpe, simple8b, vocab
from tabflow.llm.common import text_chunks
from tabflow.llm.vocab import Vocabulary

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "B", "zz", " ", "  ", "\n", "\t ", "'s", "'", "é", "é", "́", " ", "12", "!", ".", ",", "a.", "b,*"]
PIECES += ["<|endoftext|>", "<|ENDOFTEXT|>", "<|", "\x1c", "語", "한", "ᅡ", "Ä", "​", "\x85", "ß"]
PIECES += ["T\u0308", "W\u030a", "Y\u030a", "H\u0331", "J\u030c", "\u0323", "\u1dca", "\u212a", "\n\n", "B\nb", "\x00"]
texts = st.lists(st.sampled_from(PIECES), max_size=40).map("".join)
CAPITALS = [chr(c) for c in range(65, 91)]


@pytest.fixture(scope="module")
def word():
    return Vocabulary(Path(WORD_BPE).read_text())


@pytest.fixture(scope="module")
def byte():
    return Vocabulary(Path(BYTE_BPE).read_text())


@settings(max_examples=300, deadline=None)
@given(texts)
def test_pieces_are_encoded_as_whole_texts(word, byte, text):
    assert word.encode_words([text.encode()]) == [word.encode(text).astype("<u4").tobytes()]
    assert byte.encode_spaced([text, "a b", text])[2] == byte.encode(text).astype("<u4").tobytes()


@settings(max_examples=100, deadline=None)
@given(st.lists(texts, max_size=8))
def test_texts_side_by_side_keep_apart(word, byte, many):
    """Texts of a chunk share no piece, empty ones and those with blanks at their ends included."""
    assert word.encode_words([t.encode() for t in many]) == [word.encode(t).astype("<u4").tobytes() for t in many]
    assert byte.encode_spaced(many) == [byte.encode(t).astype("<u4").tobytes() for t in many]


def test_pieces_are_forgotten_beyond_the_limit(byte, monkeypatch):
    """Few kept pieces and few looked up together: the ids are the same."""
    monkeypatch.setattr(vocab, "AT_ONCE", 3)
    small = Vocabulary(Path(BYTE_BPE).read_text())
    small.spaced.limit = 5
    for i in range(40):
        many = [f"a{i} b{i % 3}, c{i % 7}.d  e\n", "", f"b{i % 3} b{i % 3}"]
        assert small.encode_spaced(many) == [byte.encode(t).astype("<u4").tobytes() for t in many]
        assert len(small.spaced.names) <= 5 + 8


def test_decoded_lists_are_the_library_s(word, byte):
    for known in (word, byte):
        coded = [known.encode(t).astype(np.int32) for t in ("", "Ab c,\n语", "", "x" * 50)]
        library = [known.tokenizer.decode(c.tolist(), skip_special_tokens=False) for c in coded]
        assert known.decode(coded).to_pylist() == library and known.decode([]).to_pylist() == []


def test_text_chunks_hold_every_row():
    column = pa.array(["x" * 10, None, "", "y" * 500, "z", *["w" * 30] * 9], pa.string())
    batch = pa.RecordBatch.from_arrays([pa.array(range(14)), column], ["key", "text"])
    parts = list(text_chunks(batch, 100))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column(1).to_pylist()) <= 100 for p in parts)


def test_capitals_with_combining_marks(word):
    """Every capital with every mark of the block, in a short text and behind a long one."""
    long = "plain words " * 2000
    for mark in range(0x300, 0x370):
        text = " ".join(f"{c}{chr(mark)} x{c}{chr(mark)}y" for c in CAPITALS)
        assert word.encode_words([text.encode()]) == [word.encode(text).astype("<u4").tobytes()]
        if mark % 16 == 8:
            short, whole = bpe.encode_texts(word, [text.encode(), (long + text).encode()])
            assert np.array_equal(whole[len(whole) - len(short) :], short)


def test_marks_that_compose_with_capitals_are_seen():
    """Composed characters of A-Z and a mark: the mark's first byte is one of the two looked for."""
    pairs = [d.split() for c in range(0x11_0000) if (d := unicodedata.decomposition(chr(c))) and d[0] != "<"]
    marks = {p[1] for p in pairs if len(p) == 2 and 65 <= int(p[0], 16) <= 90}
    assert len(marks) > 20 and all(chr(int(m, 16)).encode()[0] in (0xCC, 0xCD) for m in marks)


def test_other_tokenizers_are_refused(word, byte):
    with pytest.raises(ValueError):
        byte.encode_words([b"a"])
    with pytest.raises(ValueError):
        word.encode_spaced(["a"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=400).map("".join), st.integers(20, 200))
def test_tree_concatenation_is_exact(word, text, leaf):
    assert np.array_equal(bpe.encode_long(word, text, leaf), word.encode(text))


@pytest.mark.parametrize("text", ["ab" * 5000, "a" * 3000, "́" * 2000, "x" + "́" * 1500 + "y" * 900, ""])
def test_unbroken_texts(word, text):
    assert np.array_equal(bpe.encode_long(word, text, 100), word.encode(text))


def test_windows_grow_until_both_sides_agree(word):
    text = "é" * 4000  # tokens of a cut half do not fit the whole
    assert np.array_equal(bpe.encode_long(word, text, 50), word.encode(text))


def test_a_small_cache_forgets_and_stays_right(word, monkeypatch):
    monkeypatch.setattr(word.words, "limit", 3)
    for text in ("a b c d e f", "f e d c b a", "a a b, b. c!"):
        assert word.encode_words([text.encode()]) == [word.encode(text).astype("<u4").tobytes()]


def test_bpe_of_odd_rows(spark, odd, odd_rows, none):
    library = Tokenizer.from_file(WORD_BPE)
    rows = bpe.encode_documents(odd, WORD_BPE, ["doc_id", "key"], leaf=1000).collect()
    for r in rows:
        ids = library.encode(odd_rows[r.key][1] or "", add_special_tokens=False).ids
        assert r.doc_id == odd_rows[r.key][0]
        assert r.ids == ids
        assert r.decoded == library.decode(ids, skip_special_tokens=False)
    assert len(rows) == len(odd_rows)
    assert bpe.encode_documents(none, WORD_BPE, ["doc_id"]).count() == 0


def test_bpe_query_is_the_library(spark, smoke):
    from tabflow.llm.catalogue import QUERIES
    from tabflow.llm import queries  # noqa: F401

    library = Tokenizer.from_file(WORD_BPE)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{smoke}/documents.parquet").collect()}
    rows = QUERIES["op6_bpe"](spark, smoke).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, (1 << 64) - 1)), max_size=600))
def test_simple8b_round_trip(values):
    raw = np.array(values, np.uint64)
    block = simple8b.encode(raw)
    assert simple8b.decode(block).tolist() == values
    assert simple8b.decode(block, 5, 90).tolist() == values[5:90]


@pytest.mark.parametrize("n", [0, 1, 120, 16_383, 16_384, 16_385, 40_000])
def test_simple8b_over_run_borders(n):
    raw = np.random.default_rng(n).integers(0, 50_257, n).astype(np.uint64)
    block = simple8b.encode(raw)
    assert np.array_equal(simple8b.decode(block), raw)
    assert np.array_equal(simple8b.decode(block, n // 2, n // 2 + 50), raw[n // 2 : n // 2 + 50])
    assert len(block) < 2.8 * n + 400


def test_simple8b_packs_as_many_as_fit():
    assert simple8b.COUNTS[1:].tolist() == sorted(simple8b.COUNTS[1:].tolist(), reverse=True)
    zeros = simple8b.encode(np.zeros(1200, np.uint64))
    assert len(zeros) == simple8b.HEADER.size + 4 + 8 * 10


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        simple8b.decode(b"x" * 64)


def test_id_files_of_odd_rows(spark, odd, odd_rows, none, tmp_path):
    library = Tokenizer.from_file(BYTE_BPE)
    simple8b.write_ids(odd, BYTE_BPE, str(tmp_path / "ids"), block_ids=500)
    rows = sorted(simple8b.read_ids(spark, str(tmp_path / "ids")).collect(), key=lambda r: r.start)
    keys = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert keys == sorted(keys)
    start = 0
    for r in rows:
        assert r.start == start and r.n_tokens == len(r.ids) // 4
        start += r.n_tokens
    expected = sorted(
        (-1 if k is None else k, np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes())
        for k, t, *_ in odd_rows
    )
    assert sorted((k, bytes(r.ids)) for k, r in zip(keys, rows)) == expected
    simple8b.write_ids(none, BYTE_BPE, str(tmp_path / "none"))
    assert simple8b.read_ids(spark, str(tmp_path / "none")).count() == 0


def test_simple8b_query_is_the_library(spark, smoke):
    from tabflow.llm.catalogue import QUERIES
    from tabflow.llm import queries  # noqa: F401

    library = Tokenizer.from_file(BYTE_BPE)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{smoke}/documents.parquet").collect()}
    got, start = {r.doc_id: r for r in QUERIES["op10_simple8b_files"](spark, smoke).collect()}, 0
    for key in sorted(docs):
        ids = np.array(library.encode(docs[key], add_special_tokens=False).ids + [0], "<u4")
        assert (got[key].start, got[key].n_tokens, got[key].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
