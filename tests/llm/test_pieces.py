import hashlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tabflow.llm import pieces
from tabflow.llm.vocab import Recent

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "B", "zz", " ", "  ", "    ", "\n", "\t ", "'s", "é", "́", "12", "!", ".", ",", "a.", "<s>", "</s>", "<0x0A>"]
PARTS += ["\x00", "語", "한", "▁", "▁▁", "ß", "the", "er", "in", "ing", "ation", "😀", "==", "\r\n", "--", "\x85", "�"]
texts = st.lists(st.sampled_from(PARTS), max_size=60).map("".join)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def known():
    return pieces.model(Path(MODEL).read_bytes())


def ids_of(raw):
    return np.frombuffer(raw, "<u4")


@settings(max_examples=400, deadline=None)
@given(st.lists(texts, max_size=4))
def test_ids_and_text_are_the_librarys(known, library, several):
    coded = [ids_of(x) for x in known.encode(several)]
    assert [c.tolist() for c in coded] == [library.encode(t) for t in several]
    assert known.decode(coded).to_pylist() == [library.decode(c.tolist()) for c in coded]


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_texts_of_pieces(known, library, data):
    names = sorted(known.ids)
    drawn = data.draw(st.lists(st.integers(0, len(names) - 1), max_size=30))
    text = "".join(names[i] for i in drawn).replace("▁", " ")
    assert ids_of(known.encode([text])[0]).tolist() == library.encode(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.just(0), st.integers(3, 260), st.integers(3, 31_999)), max_size=12), st.booleans())
def test_any_ids_decode_as_the_library_does(known, library, ids, ends):
    ids = [1, *ids, 2] if ends else ids
    assert known.decode([np.array(ids, np.int64)]).to_pylist() == [library.decode(ids)]


@settings(max_examples=400, deadline=None)
@given(st.data())
def test_pairs_fit_just_when_merging_keeps_both(known, data):
    ids = sorted(known.left)
    a, b = (ids[data.draw(st.integers(0, len(ids) - 1))] for _ in range(2))
    names = [known.names[a], known.names[b]]
    assert known.follows(a, b) == (known.merge("".join(names))[0] == names)


@pytest.mark.parametrize("text", ["x" * 30_000, "ab" * 9000, " " * 1001, "=-" * 3000, "a" * 4999, "é" * 3000, ""])
def test_unbroken_texts(known, library, text):
    assert ids_of(known.encode([text])[0]).tolist() == library.encode(text)


def test_the_table_holds_the_last_token_of_each_prefix(known):
    text = "▁unbelievable"
    last = known.table(text)
    for end in range(1, len(text) + 1):
        assert known.names[last[end]] == known.merge(text[:end])[0][-1]


def test_a_small_cache_forgets_and_stays_right(known, library, monkeypatch):
    monkeypatch.setattr(known, "recent", Recent(3))
    for text in ("a b c d e f", "f e d c b a", "a a b, b. c!"):
        assert ids_of(known.encode([text])[0]).tolist() == library.encode(text)


def test_other_models_are_refused():
    raw = Path(MODEL).read_bytes()
    at = raw.rindex(b"\n\x08identity")
    with pytest.raises(ValueError):  # a normalizer that drops repeated blanks
        pieces.PieceModel(raw[:at] + raw[at:].replace(b"\x18\x01 \x00", b"\x18\x01 \x01", 1))


def test_pieces_of_odd_rows(spark, odd, odd_rows, none, library):
    rows = pieces.encode_documents(odd, MODEL, ["doc_id", "key", "a.b"]).collect()
    for r in rows:
        ids = library.encode(odd_rows[r.key][1] or "", add_bos=True, add_eos=True)
        assert (r.doc_id, r["a.b"]) == (odd_rows[r.key][0], 1)
        assert ids_of(r.ids).tolist() == ids
        assert r.decoded == library.decode(ids)
    assert len(rows) == len(odd_rows)
    assert pieces.encode_documents(none, MODEL, ["doc_id"]).count() == 0


def test_query_is_the_library(spark, smoke, library):
    from tabflow.llm import queries  # noqa: F401
    from tabflow.llm.catalogue import QUERIES

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{smoke}/documents.parquet").collect()}
    rows = QUERIES["op11_prefix_table"](spark, smoke).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode(docs[r.doc_id] or "", add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
