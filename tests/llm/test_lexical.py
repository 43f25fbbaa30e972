import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabflow.llm import lexical
from tabflow.sources.shared import new_path

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    """Every item against every document, as the contract states it."""
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in counted:
            m = 50 + (50 * c.total() * n_docs) // total
            score = 0
            for t in set(terms(text)) & c.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, -math.inf if d is None else d, d))
        scored.sort(key=lambda x: x[:2])
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(scored[:k])]
    return out


def by_item(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_terms_are_the_pattern(text):
    assert [t.decode() for t in lexical.terms_of(text.encode())] == terms(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.dictionaries(st.binary(min_size=1, max_size=3), st.integers(1, 400), max_size=40), max_size=5))
def test_coordinates_bound_every_frequency(docs):
    widths, sketches = lexical.sketch(docs)
    for doc, width, raw in zip(docs, widths.tolist(), sketches):
        assert len(raw) == width and (width >= lexical.WIDTH_PER_TERM * len(doc)) and (width == 0 or width & (width - 1) == 0)
        held = np.frombuffer(raw, np.uint8)
        for term, tf in doc.items():
            crc = np.array([lexical.crc32(term)], np.uint32)
            for which in range(lexical.HASHES):
                assert held[lexical.coordinates(crc, which, width)[0]] >= min(tf, lexical.CLIPPED)


@pytest.mark.parametrize("cells, block_terms", [(lexical.CELLS, 16_384), (200, 5)])
def test_search_is_brute_force(spark, monkeypatch, cells, block_terms):
    monkeypatch.setattr(lexical, "CELLS", cells)
    chance = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(chance.choices(words, k=chance.randrange(0, 80)))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(30)] + [(3, docs[3][1])] * 2  # copies, a repeated row
    docs += [(2000, "often " * 5000 + "w1"), (None, "w1 w2"), (2001, None), (2002, " .,! ")]
    items = [(i, " ".join(chance.sample(words, 8))) for i in range(6)] + [(6, "often w1"), (7, ""), (8, None), (9, "absent"), (None, "W3 w3")]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    asked = spark.createDataFrame(items, "item_id int, text string")
    path = new_path(spark, "test-sketches")
    lexical.write_index(table, path)
    found = lexical.search(spark, path, asked, 20, block_terms=block_terms).collect()
    assert by_item(found) == by_item(brute(docs, items, 20))


def test_an_item_in_several_rows_is_answered_once(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "c"), (1, "a"), (1, None)], "item_id long, text string")
    assert [tuple(r)[:3] for r in lexical.ranked_documents(docs, items).collect()] == [(1, 1, 1)]


def test_odd_rows_and_empty_tables(spark, odd, odd_rows, none):
    items = spark.createDataFrame([(1, "tie two null Ünïcode w1 x", 9)], "item_id long, text string, doc_id int")
    found = lexical.ranked_documents(odd, items).collect()
    assert by_item(found) == by_item(brute([(r[0], r[1]) for r in odd_rows], [(1, "tie two null Ünïcode w1 x")], 50))
    assert lexical.ranked_documents(none, items).collect() == []
    assert lexical.ranked_documents(odd, items.limit(0)).collect() == []
