import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabflow.llm import importance, rules, toxicity
from tabflow.llm.common import fold


def windows(words):
    seen = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(covered)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=25))
def test_repeated_words_are_those_in_repeated_windows(words):
    assert rules.repeated_words(words) == windows(words)


def test_measures_of_odd_rows(odd, odd_rows):
    got = sorted(
        ((r.key, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) for r in rules.measure(odd).collect()), key=repr
    )
    expected = []
    for key, text, *_ in odd_rows:
        raw = (text or "").encode()
        lines = [x for x in (text or "").split("\n") if x.encode().split()]
        chars = sum(len(w.decode()) for w in raw.split())
        symbols = sum((text or "").count(c) for c in "#*$%&|<>")
        expected.append((key, len(raw.split()), chars, symbols, len(lines) - len(set(lines))))
    assert got == sorted(expected, key=repr)


def test_lines_above_the_limit_deplete_documents(spark, none):
    notice = "this line is found on every page of the host"
    rows = [(i, f"{notice}\n" * 3 + f"word{i}", "en", "host", 1) for i in range(12)]
    rows += [(100 + i, f"{notice.upper()}\n" + f"own{i} text " * 40, "en", "host", 1) for i in range(3)]
    rows += [(200 + i, f"{notice}\n" * 3 + "same", "en", "other", 1) for i in range(12)]  # copies are one document
    rows += [(300 + i, f"{notice}\n" * 3 + f"word{i}", "en", None, 1) for i in range(12)]
    rows += [(400, None, "en", "host", 1)]
    docs = spark.createDataFrame(rows, none.schema)
    judged = rules.judge(rules.measure(docs), F.col("n_words") < 1, max_documents=10, max_share=0.0)
    kept = {r.key for r in judged.filter("kept").collect()}
    assert kept == {100, 101, 102} | {200 + i for i in range(12)}
    share = rules.judge(rules.measure(docs), F.col("n_words") < 1, max_documents=1, max_share=0.99)
    assert share.filter("kept").count() == 15 + 12  # 15 of the 16 texts of one host, 12 of 12 of another
    assert rules.judge(rules.measure(none), F.lit(False)).count() == 0


def brute_segments(scores):
    """Segments that score more than all their parts and than all larger ones that hold them, by definition."""
    out, total = [], np.concatenate([[0.0], np.cumsum(scores)])

    def search(a, b):
        best = max(((total[j] - total[i], i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0))
        if best[0] <= 1e-9:
            return
        s, i, j = min(
            ((total[y] - total[x], x, y) for x in range(a, b) for y in range(x + 1, b + 1) if abs(total[y] - total[x] - best[0]) < 1e-9),
            key=lambda t: (t[1], -t[2]),
        )
        out.append((i, j, s))
        search(a, i)
        search(j, b)

    search(0, len(scores))
    return sorted(out)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([0.0, 0.0, 1.3, 2.7]), max_size=18))
def test_segments_are_all_maximal_ones(found):
    other = -0.61
    places = [i for i, s in enumerate(found) if s]
    got = toxicity.maximal_segments(places, [found[i] for i in places], other)
    expected = brute_segments([s or other for s in found])
    assert [(a, b) for a, b, _ in sorted(got)] == [(a, b) for a, b, _ in expected]
    assert [s for *_, s in sorted(got)] == pytest.approx([s for *_, s in expected])


def test_decay_makes_clean_scores_fair():
    rates, scores = np.array([0.01, 0.002]), np.array([2.0, 3.0])
    x = toxicity.decay_rate(rates, scores, 0.988, -0.2)
    assert rates @ np.exp(x * scores) + 0.988 * np.exp(-0.2 * x) == pytest.approx(1, abs=1e-6)


def corpus(spark, schema):
    chance, rows, labels = random.Random(4), [], []
    for i in range(400):
        words = [f"w{chance.randrange(300)}" for _ in range(chance.randrange(20, 120))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(6):
                words.insert(chance.randrange(len(words)), chance.choice(["vile", "rotten", "nasty,"]))
        poor = i % 7 == 0
        text = " ".join(w.upper() + "!!" for w in words) if poor else " ".join(words)
        rows.append((i, text, "en", "s", len(text)))
        labels.append((i, int(not poor), int(toxic)))
    return spark.createDataFrame(rows, schema), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def planted(spark, none):
    docs, marks = corpus(spark, none.schema)
    return docs.cache(), marks.cache()


def test_toxic_texts_of_the_held_out_fold_are_found(planted):
    docs, marks = planted
    model = toxicity.fit(docs, marks)
    judged = toxicity.toxicity(model, docs)
    rows = docs.select("doc_id", judged("text").alias("t"), fold(F.col("doc_id")).alias("fold")).join(marks, "doc_id")
    held = rows.filter("fold = 0").collect()
    assert len(held) > 50
    assert sum((r.t.score >= 0.5) == (r.toxic == 1) for r in held) >= 0.97 * len(held)
    passages = [p.passage for r in held if r.toxic for p in r.t.passages]
    assert all(any(w in p for w in ("vile", "rotten", "nasty")) for p in passages) and passages


def test_labels_of_the_held_out_fold_are_never_read(planted):
    docs, marks = planted
    turned = marks.withColumn("toxic", F.when(fold(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, marks).weights == toxicity.fit(docs, turned).weights


def test_toxicity_of_odd_rows(spark, odd, odd_rows, none, labels, no_labels):
    for marks in (labels, no_labels):
        judged = toxicity.toxicity(toxicity.fit(odd, marks), odd)
        rows = odd.select("doc_id", judged("text").alias("t")).collect()
        assert len(rows) == len(odd_rows)
        assert all(0 <= r.t.score <= 1 for r in rows)
    assert toxicity.clean_documents(odd, labels).columns == odd.columns
    assert toxicity.clean_documents(none, labels).count() == 0


def test_near_copies_count_once(spark, none):
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*base[: i % 200], f"own{i}", *base[i % 200 :]]), "en", "s", 1) for i in range(200)]
    rows += [(1000 + i, " ".join(f"x{i}y{j}" for j in range(50)), "en", "s", 1) for i in range(20)]
    docs = spark.createDataFrame(rows, none.schema)
    sample = docs.select(F.col("doc_id").alias("key"), F.lit(1).alias("label"))
    left = toxicity.without_copies(toxicity.with_label(docs, sample, "doc_id", "text"), sample)
    keys = {r.key for r in left.collect()}
    assert {1000 + i for i in range(20)} <= keys
    assert len(keys) < 40


def test_distinct_texts_that_share_a_passage_all_count(spark, none):
    shared = [f"p{i}" for i in range(64)]  # 60 shingles of 5 words

    def text(i, own):
        return " ".join([*(f"own{i}x{j}" for j in range(own)), *shared])

    rows = [(i, text(i, (60, 100, 200)[i % 3]), "en", "s", 1) for i in range(90)]
    rows += [(1000 + i, text(i, 200), "en", "s", 1) for i in range(5, 90, 9)]  # copies with another label
    rows += [(2000 + i, text(i, 200) + " more", "en", "s", 1) for i in range(5, 90, 9)]  # near copies
    rows += [(3000 + i, (None, "", " \n ")[i % 3], "en", "s", 1) for i in range(6)]
    docs = spark.createDataFrame(rows, none.schema)
    sample = docs.select(F.col("doc_id").alias("key"), F.col("doc_id").between(1000, 1999).cast("int").alias("label"))
    left = toxicity.without_copies(toxicity.with_label(docs, sample, "doc_id", "text"), sample)
    keys = sorted(r.key for r in left.collect())
    assert keys == [*range(90), *range(1005, 1090, 9), 3000]


def test_a_common_passage_leaves_both_classes(spark, none):
    shared = " ".join(f"p{i}" for i in range(64))
    rows = [(i, " ".join([*(f"w{(7 * i + j * j) % 211}" for j in range(60)), "vile" if i % 4 == 0 else "mild", shared]), "en", "s", 1) for i in range(200)]
    docs = spark.createDataFrame(rows, none.schema)
    marks = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    model = toxicity.fit(docs, marks)
    assert b"vile" in model.weights
    assert toxicity.fit(docs.union(docs), marks) == model


def test_poor_texts_are_rejected_and_good_ones_stay(planted):
    docs, marks = planted
    rows = importance.sample_documents(docs, marks).join(marks.withColumnRenamed("doc_id", "key"), "key").collect()
    held = [r for r in rows if zlib.crc32(str(r.key).encode()) % 5 == 0]
    assert not any(r.kept for r in held if r.quality == 0)
    assert sum(r.kept for r in held if r.quality == 1) >= 0.95 * sum(r.quality == 1 for r in held)
    again = importance.sampled_documents(docs.repartition(5), marks)
    assert {r.doc_id for r in again.collect()} == {r.key for r in rows if r.kept}


def test_models_count_ngrams_of_all_texts(spark, none):
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(["a b c", "a A! 12", "a a a", ""])], none.schema)
    marks = spark.createDataFrame([(0, 1, 0), (1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    raw, target = Counter(), Counter()
    for i, t in enumerate(["a b c", "a A! 12", "a a a", ""]):
        raw.update(importance.ngrams(t.encode(), importance.Codes()).tolist())
        if i in (0, 1) and zlib.crc32(str(i).encode()) % 5:
            target.update(importance.ngrams(t.encode(), importance.Codes()).tolist())
    expected = np.zeros(importance.BUCKETS)
    if target:
        scale = sum(target.values()) / sum(raw.values())
        for b in raw:
            expected[b] = np.log(target[b] + importance.SMOOTHING) - np.log(raw[b] * scale + importance.SMOOTHING)
    assert importance.fit(docs, marks) == pytest.approx(expected)


@pytest.mark.parametrize("k", [0, 1, 7, 99, 100, 101])
def test_kth_largest(spark, k):
    chance = random.Random(k)
    values = [chance.randrange(1 << 60) if i % 3 else 12345 for i in range(100)]
    got = importance.kth_largest(spark.createDataFrame([(v,) for v in values], "x long"), "x", k)
    assert got == (None if k == 0 else 0 if k > 100 else sorted(values, reverse=True)[k - 1])


def test_importance_of_odd_rows(odd, odd_rows, none, labels, no_labels):
    for marks in (labels, no_labels):
        rows = importance.sample_documents(odd, marks).collect()
        assert len(rows) == len(odd_rows)
        assert all(0 <= r.score <= 1 for r in rows)
        by_row = defaultdict(set)
        for r in rows:
            by_row[(r.key, r.draw)].add(r.kept)
        assert all(len(v) == 1 for v in by_row.values())
    assert all(r.kept for r in importance.sample_documents(odd, no_labels).collect())
    assert importance.sampled_documents(odd, labels).columns == odd.columns
    assert importance.sample_documents(none, labels).count() == 0
