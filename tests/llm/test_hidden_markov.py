import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabflow.llm import hmm
from tabflow.llm.common import fold


def random_model(states, seed):
    chance = np.random.default_rng(seed)

    def rows(n, m):
        table = chance.random((n, m)) + 0.05
        return table / table.sum(1, keepdims=True)

    emit = np.full((hmm.CLASSES, states), 1e-9)
    emit[:4] = rows(states, 4).T
    return hmm.Model(rows(1, states)[0], rows(states, states), emit)


def path_sums(model, sequence):
    """Probability, and expected starts, moves and emissions, over all paths of states."""
    states = len(model.start)
    total, starts, moves = 0.0, np.zeros(states), np.zeros((states, states))
    emits = np.zeros((states, hmm.CLASSES))
    for path in itertools.product(range(states), repeat=len(sequence)):
        p = model.start[path[0]] * model.emit[sequence[0], path[0]]
        for a, b, c in zip(path, path[1:], sequence[1:]):
            p *= model.move[a, b] * model.emit[c, b]
        total += p
        starts[path[0]] += p
        for a, b in zip(path, path[1:]):
            moves[a, b] += p
        for s, c in zip(path, sequence):
            emits[s, c] += p
    return total, np.concatenate([starts, moves.ravel(), emits.ravel()]) / total


@pytest.mark.parametrize("segment", [2, 3, 100])
def test_likelihood_is_the_sum_over_paths(segment):
    model, chance = random_model(3, 1), np.random.default_rng(2)
    lengths = np.array([1, 7, 4, 6, 2])
    classes = chance.integers(0, 4, lengths.sum())
    got = hmm.log_likelihoods(model, classes, lengths, segment)
    at = 0
    for n, log in zip(lengths, got):
        assert log == pytest.approx(math.log(path_sums(model, classes[at : at + n].tolist())[0]))
        at += n


def test_counts_are_expectations_over_paths():
    model, chance = random_model(2, 3), np.random.default_rng(4)
    sizes = np.array([6, 4, 4, 1])
    first = np.cumsum(sizes) - sizes
    classes = chance.integers(0, 4, sizes.sum())
    got = hmm.expected_counts(model, classes, first, sizes)
    expected = sum(path_sums(model, classes[a : a + n].tolist())[1] for a, n in zip(first, sizes))
    assert got == pytest.approx(expected)


def test_rounds_never_lower_the_likelihood():
    chance = np.random.default_rng(5)
    classes = np.concatenate([np.r_[chance.integers(1 + 50 * (i % 2), 40 + 50 * (i % 2), 30), 0] for i in range(60)])
    lengths = np.full(60, 31)
    shares = (np.bincount(classes, minlength=hmm.CLASSES) + 0.5) / (len(classes) + 0.5 * hmm.CLASSES)
    first, sizes = hmm.training_windows(lengths, np.zeros(60, bool))
    model, last = hmm._first_model(classes, first, sizes, shares, 2), -math.inf
    for _ in range(6):
        model = hmm.maximised(hmm.expected_counts(model, classes, first, sizes), shares, 2)
        now = hmm.log_likelihoods(model, classes, lengths).sum()
        assert now > last - 1e-3
        last = now
    assert model.move.sum(1) == pytest.approx([1, 1]) and model.emit.sum(0) == pytest.approx([1, 1])


def test_windows_cover_training_texts_once():
    lengths, held = np.array([3, 1200, 512, 513, 1]), np.array([False, False, True, False, False])
    first, sizes = hmm.training_windows(lengths, held)
    covered = sorted(i for a, n in zip(first, sizes) for i in range(a, a + n))
    assert covered == [i for i in range(lengths.sum()) if not 1203 <= i < 1715]
    assert sizes.max() <= hmm.WINDOW and list(sizes) == sorted(sizes, reverse=True)


def base_scores(rows):
    tokens = [(k, (t or "").encode().lower().split() + [b"\n"]) for k, t in rows]
    counts = Counter()
    for k, words in tokens:
        if k is None or zlib.crc32(str(k).encode()) % 5 != 1:
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    return n, sorted(
        (-1 if k is None else k, len(w), sum(counts[x] > 0 for x in w), round(sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 6))
        for k, w in tokens
    )


def test_scores_of_odd_rows(odd, odd_rows, none):
    rows = hmm.score_documents(odd, fold(F.col("doc_id")) == 1).collect()
    n, expected = base_scores([r[:2] for r in odd_rows])
    got = sorted((-1 if r.key is None else r.key, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows)
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    assert [g[3] for g in got] == pytest.approx([e[3] for e in expected], abs=1e-4)
    assert all(r.train_tokens == n and r.score < 0 and math.isfinite(r.score) for r in rows)
    assert hmm.score_documents(none, F.lit(False)).count() == 0
    unseen = hmm.score_documents(odd, F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in unseen)


def test_held_out_texts_are_likelier_than_under_single_words(spark, smoke):
    docs = spark.read.parquet(f"{smoke}/documents.parquet")
    scored = hmm.score_documents(docs, fold(F.col("doc_id")) == 1).filter("held_out").collect()
    assert sum(r.score for r in scored) > sum(r.base_score for r in scored)


@pytest.mark.parametrize("poor", ["copies", "held out"])
def test_a_poor_block_does_not_decide_the_model(spark, none, poor):
    chance = np.random.default_rng(6)
    texts = [" ".join(f"{x:02}{'ab'[i % 2]}" for x in chance.integers(0, 40, 50)) for i in range(200)]

    def read(texts, held):
        rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
        docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 20), none.schema)  # a block each
        return hmm.read_blocks(docs, held, "doc_id", "text")

    first = read(texts, F.lit(False)).orderBy(F.xxhash64("block")).first()["keys"]
    assert len(first) == 10
    held = F.col("doc_id").isin(first if poor == "held out" else [])
    blocks = read([texts[first[0]] if i in first and poor == "copies" else t for i, t in enumerate(texts)], held)
    model = hmm.fit(blocks, np.full(hmm.CLASSES, 1 / hmm.CLASSES), 2)
    kinds = [list({hmm.word_class(f"{x:02}{kind}".encode()) for x in range(40)}) for kind in "ab"]
    shares = np.array([model.emit[kind].sum(0) for kind in kinds])  # of both kinds of text, by state
    assert (shares.max(1) > 10 * shares.min(1)).all()


def test_rounds_go_on_until_the_likelihood_settles(spark, smoke):
    docs = spark.read.parquet(f"{smoke}/documents.parquet").repartition(20, "doc_id")
    blocks = hmm.read_blocks(docs, F.lit(False), "doc_id", "text")
    rows, windows = blocks.toArrow(), []
    for at in range(rows.num_rows):
        _, classes, lengths, held = hmm._sequences(rows, at)
        windows += [classes[a : a + n] for a, n in zip(*hmm.training_windows(lengths, held))]
    windows.sort(key=len, reverse=True)
    tokens, sizes = np.concatenate(windows), np.array(list(map(len, windows)))
    shares = (np.bincount(tokens, minlength=hmm.CLASSES) + 0.5) / (len(tokens) + 0.5 * hmm.CLASSES)
    model = hmm.fit(blocks, shares)
    further = hmm.maximised(hmm.expected_counts(model, tokens, np.cumsum(sizes) - sizes, sizes), shares, hmm.STATES)
    before, after = (hmm.log_likelihoods(m, tokens, sizes).sum() + hmm.log_prior(m, shares) for m in (model, further))
    assert 0 <= after - before < 2e-4 * abs(before)


def test_blocks_part_long_tables(spark, odd, monkeypatch):
    whole = sorted(tuple(r) for r in hmm.score_documents(odd.filter("doc_id < 4 or doc_id > 10"), F.lit(False)).select("key", "n_tokens", "n_known").collect())
    monkeypatch.setattr(hmm, "BLOCK_BYTES", 50)
    parts = sorted(tuple(r) for r in hmm.score_documents(odd.filter("doc_id < 4 or doc_id > 10"), F.lit(False)).select("key", "n_tokens", "n_known").collect())
    assert whole == parts


def test_single_precision_rounds_count_as_double_ones():
    rng = np.random.default_rng(5)
    classes = rng.integers(0, 40, 30_000).astype(np.uint16)
    sizes = np.sort(rng.integers(1, hmm.WINDOW, 60))[::-1]
    first = np.cumsum(sizes) - sizes
    shares = np.full(hmm.CLASSES, 1 / hmm.CLASSES)
    model = hmm._first_model(classes.astype(np.int64), first, sizes, shares, hmm.STATES)
    # a move and emissions that hardly occur, as after many rounds over a large corpus
    move, emit = model.move.copy(), model.emit.copy()
    move[0, 1], emit[:20, 2] = 1e-30, 1e-25
    model = hmm.Model(model.start, move / move.sum(1, keepdims=True), emit / emit.sum(0))
    exact = hmm.expected_counts(model, classes, first, sizes)
    found = hmm.block_counts(model, classes, first, sizes)
    assert np.isfinite(found).all()
    assert np.allclose(found[:-1], exact, rtol=1e-3, atol=1e-3)
    assert found[-1] == pytest.approx(hmm.log_likelihoods(model, classes, sizes).sum(), rel=1e-6)
