import math
import os
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tabflow.llm import jaccard, mixing, toxicity
from tabflow.llm.common import word_count
from tabflow.llm.sigtree import FAN_OUT, Links, Tree, alike, link
from tabflow.sources.shared import new_path, persist_state


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_groups(docs):
    """Component per document by comparing all pairs."""
    sets = {k: shingle_set(t) for k, t in docs}
    up = {k: k for k in sets}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {k: (len(sets[k]), root(k)) for k in sets}


def near_copies(seed, families, copies, words=60, changed=9):
    chance, rows = random.Random(seed), []
    passage = [f"p{i}" for i in range(25)]
    for f in range(families):
        base = [f"w{chance.randrange(500)}" for _ in range(words)]
        for _ in range(copies):
            text = list(base)
            for _ in range(chance.randrange(changed)):
                text[chance.randrange(words)] = f"x{chance.randrange(10**6)}"
            rows.append(" ".join(text + passage * chance.randrange(2)))
    chance.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("part_shingles", [2_000_000, 300])
def test_groups_are_those_of_all_pairs(spark, none, part_shingles):
    docs = near_copies(1, 6, 14) + [(1000 + i, "only three words") for i in range(3)] + [(2000, "a b c d e f")]
    table = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in docs], none.schema)
    got = {r.key: (r.n_shingles, r.component_id) for r in jaccard.groups(table, part_shingles=part_shingles).collect()}
    assert got == brute_groups(docs)


def test_threshold_is_met_exactly(spark, none):
    same = [f"s{i}" for i in range(40)]
    docs = [(0, " ".join(same)), (1, " ".join(same[:31])), (2, " ".join(same[:32]))]  # 36 shingles: 27 and 28 of them
    table = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in docs], none.schema)
    got = {r.key: r.component_id for r in jaccard.groups(table).collect()}
    assert got == {k: c for k, (_, c) in brute_groups(docs).items()} == {0: 0, 1: 0, 2: 0}
    short = spark.createDataFrame([(0, " ".join(same), "", "", 0), (1, " ".join(same[:30]), "", "", 0)], none.schema)
    assert {r.key: r.component_id for r in jaccard.groups(short).collect()} == {0: 0, 1: 1}


def test_groups_of_odd_rows(odd, odd_rows, none):
    rows = jaccard.groups(odd).collect()
    assert len(rows) == len(odd_rows)
    expected = brute_groups([(k, t) for k, t, *_ in odd_rows if k is not None])
    assert {r.key: (r.n_shingles, r.component_id) for r in rows if r.key is not None} == expected
    assert all(r.component_id is None and r.representative for r in rows if r.key is None)
    assert jaccard.groups(none).count() == 0
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns
    keys = sorted((r.doc_id for r in kept.collect()), key=lambda k: (k is None, k))
    assert keys == sorted({c for _, c in expected.values()}) + [None, None]


def test_one_row_of_a_group_without_keys_stays(spark, none):
    rows = [(None, "one two three four five six", "en", "a", 1), (None, "One two three four five six", "en", "b", 1), (3, None, "", "", 0)]
    table = spark.createDataFrame(rows, none.schema)
    assert jaccard.one_of_each(table).count() == 2


def random_sets(chance, n):
    bases = [chance.integers(0, 1 << 63, chance.integers(1, 60)).astype(np.uint64) for _ in range(5)]
    out = []
    for _ in range(n):
        base = bases[chance.integers(5)].copy()
        at = chance.integers(0, len(base), chance.integers(0, 1 + len(base) // 4))
        base[at] = chance.integers(0, 1 << 63, len(at)).astype(np.uint64)
        out.append(np.unique(base))
    return out


def brute_links(sets):
    links = Links(len(sets))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(set(a.tolist()) & set(sets[j].tolist()))
            if both and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                links.connect(i, j)
    return links.roots()


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 80), st.integers(0, 80))
def test_dual_traversal_finds_all_components(seed, n, cut):
    sets = random_sets(np.random.default_rng(seed), n)
    links, tree = Links(n), Tree(sets)
    link(tree, tree, sets, sets, 0, links, 75)
    assert np.array_equal(links.roots(), brute_links(sets))
    if 0 < cut < n:
        left, right, links = sets[:cut], sets[cut:], Links(n)
        a, b = Tree(left), Tree(right)
        link(a, a, left, left, 0, links, 75)
        inner = Links(n - cut)
        link(b, b, right, right, 0, inner, 75)
        for i, r in enumerate(inner.roots().tolist()):
            links.connect(cut + i, cut + r)
        link(a, b, left, right, cut, links, 75)
        assert np.array_equal(links.roots(), brute_links(sets))


def test_nodes_hold_bitmaps_and_size_ranges():
    sets = random_sets(np.random.default_rng(9), 50)
    tree = Tree(sets)
    for (maps, low, high, shared), (up, up_low, up_high, up_shared) in zip(tree.levels, tree.levels[1:]):
        for i in range(len(up)):
            below = slice(i * FAN_OUT, (i + 1) * FAN_OUT)
            assert np.array_equal(np.bitwise_or.reduce(maps[below]), up[i])
            assert (low[below].min(), high[below].max(), shared[below].max()) == (up_low[i], up_high[i], up_shared[i])


def test_sets_are_compared_exactly():
    a = np.arange(100, dtype=np.uint64)
    assert alike(a, a[:75], 75) and not alike(a, a[:74], 75) and not alike(a[:0], a[:0], 75)


def test_components_of_long_chains(spark):
    chance = random.Random(2)
    names = list({chance.randrange(-(1 << 62), 1 << 62) for _ in range(60)})
    edges = list(zip(names[:40], names[1:40])) + list(zip(names[40:], names[41:]))
    got = {r.node: r.root for r in jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: min(names[:40]) for n in names[:40]} | {n: min(names[40:]) for n in names[40:]}


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, (1 << 48) - 1), max_size=50))
def test_packed_values_come_back(values):
    raw = np.array(values, np.uint64)
    assert jaccard.unpack(jaccard.pack(raw), len(raw)).tolist() == values


@pytest.mark.parametrize("block, bucket", [(1_000_000, 2_000_000), (60, 40)])
def test_only_sets_that_share_enough_are_candidates(spark, none, monkeypatch, block, bucket):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(jaccard, "BUCKET_SHINGLES", bucket)
    passage = [f"q{j}" for j in range(30)]
    docs = [(i, " ".join([*passage, *[f"u{i}v{j}" for j in range(60)]])) for i in range(40)]
    docs += [(100, " ".join(f"n{j}" for j in range(60))), (101, " ".join(f"n{j}" for j in range(58)))] + [(102 + i, "one more copy of it") for i in range(5)]
    table = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in docs], none.schema)
    got = {r.key: (r.n_shingles, r.component_id) for r in jaccard.groups(table).collect()}
    assert got == brute_groups(docs)
    rows = table.select(F.col("doc_id").alias("key"), F.xxhash64("text").alias("text_hash"), "text")
    schema = "block long, keys array<long>, text_hashes array<long>, nodes array<long>, sizes array<long>, hashes binary"
    blocks = rows.mapInArrow(jaccard._blocks_of_texts(pa.int64()), schema).cache()
    left = jaccard.candidates(blocks, 75).collect()
    assert sorted(r.n for r in left) == [54, 56]


BLOCKS = "block long, keys array<long>, text_hashes array<long>, nodes array<long>, sizes array<long>, hashes binary"


def blocks_of(table):
    rows = table.select(F.col("doc_id").alias("key"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(jaccard._blocks_of_texts(pa.int64()), BLOCKS)


def test_a_passage_of_all_texts_makes_no_family(spark, none):
    passage = " ".join(f"q{j}" for j in range(30))
    own = [[f"u{i}v{j}" for j in range(60)] for i in range(40)]
    docs = [(2 * i + k, " ".join(words[: 60 - k]) + " " + passage) for i, words in enumerate(own) for k in range(2)]
    table = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in docs], none.schema)
    members = jaccard.families(jaccard.candidates(blocks_of(table).cache(), 75)).groupBy("root").count()
    assert sorted(r["count"] for r in members.collect()) == [2] * 40
    got = {r.key: (r.n_shingles, r.component_id) for r in jaccard.groups(table).collect()}
    assert got == brute_groups(docs)


def test_sets_left_over_meet_no_square_of_parts(spark, none, monkeypatch):
    chance, kept = random.Random(4), {}
    base = [f"w{i}" for i in range(200)]

    def changed(places):
        return " ".join(f"x{chance.randrange(10**9)}" if i in places else w for i, w in enumerate(base))

    texts = [changed({chance.randrange(5, 195)}) for _ in range(60)] + [changed({10 + i, *range(40 + i, 190, 30)}) for i in range(3)]
    docs = list(enumerate(texts))  # the last three share a prefix with the others and link with nothing

    def kept_state(state, label="state", path=None):
        kept[label] = persist_state(state, label, path)
        return kept[label]

    monkeypatch.setattr(jaccard, "persist_state", kept_state)
    table = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in docs], none.schema)
    got = {r.key: (r.n_shingles, r.component_id) for r in jaccard.groups(table, part_shingles=1000).collect()}
    assert got == brute_groups(docs) and sorted({c for _, c in got.values()}) == [0, 60, 61, 62]
    parts = kept["families"].agg(F.max("parts")).first()[0]
    assert parts > 12 and 0 < kept["met"].count() < 4 * len(docs)  # pair by pair each would be moved parts - 2 times


def test_blocks_stay_where_they_are_and_go_once_read(spark, none, monkeypatch):
    paths = []
    monkeypatch.setattr(jaccard, "new_path", lambda session, label: paths.append(new_path(session, label)) or paths[-1])
    docs = near_copies(3, 4, 6)
    table = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in docs], none.schema)
    stored = jaccard._stored(blocks_of(table), new_path(spark, "sets"))
    plan = jaccard.linkable(stored, 75)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(of_block" in plan and "hashpartitioning(block" not in plan
    found = jaccard.groups(table)
    assert len(paths) == 2 and not any(os.path.exists(p.removeprefix("file:")) for p in paths)
    assert {r.key: (r.n_shingles, r.component_id) for r in found.collect()} == brute_groups(docs)


def pipeline_rows(none, spark):
    chance, rows, labels = random.Random(8), [], []
    for i in range(260):
        words = [f"w{chance.randrange(250)}" for _ in range(chance.randrange(30, 90))]
        toxic, poor = i % 6 == 0, i % 9 == 1
        if toxic:
            for _ in range(6):
                words.insert(chance.randrange(len(words)), chance.choice(["vile", "rotten"]))
        text = " ".join(f"{w.upper()}!!" if poor else w for w in words)
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, int(not poor), int(toxic)))
    rows += [(1000 + i, rows[2 + 6 * i][1] + " more", "en", "s0", 1) for i in range(10)]
    return spark.createDataFrame(rows, none.schema), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_pipeline_stages_and_run(spark, none, tmp_path):
    docs, labels = pipeline_rows(none, spark)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    rows, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, rows, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if i + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == docs.columns
        kept[name], before, rows = out, rows, out
    ids = {name: {r.doc_id for r in df.select("doc_id").collect()} for name, df in kept.items()}
    marks = {r.doc_id: r for r in labels.collect()}
    held = [m for k, m in marks.items() if zlib.crc32(str(k).encode()) % 5 == 0]
    assert sum((m.doc_id not in ids["toxicity"]) == bool(m.toxic) for m in held) >= 0.95 * len(held)
    good = [m for m in held if m.doc_id in ids["toxicity"]]
    assert sum((m.doc_id in ids["quality_classifier"]) == bool(m.quality) for m in good) >= 0.95 * len(good)
    texts = [(r.doc_id, r.text) for r in kept["quality_classifier"].collect()]
    assert ids["ngram_jaccard_join"] == {c for _, c in brute_groups(texts).values()}
    mixed = mixing.mix(kept["ngram_jaccard_join"], word_count(F.col("text")), corpus_pipeline.WEIGHTS)
    copies = {r.key: r.copies for r in mixed.collect() if r.copies}
    got = defaultdict(int)
    for r in kept["mixing_sources"].collect():
        got[r.doc_id] += 1
    assert got == copies
    ran = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(ran.collect()) == sorted(kept["bpe"].collect())
    assert len(kept["bpe"].columns) == 5 and kept["bpe"].count() == kept["mixing_sources"].count()


def test_stages_of_odd_rows(spark, odd, none, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for table in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, str(tmp_path))
            assert name == "bpe" or out.columns == table.columns
            assert out.count() <= 4 * table.count()


def test_queries_are_registered():
    import __spark_entry__

    names = list(__spark_entry__.queries())
    assert "pipeline" in names and all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11))
    assert math.isclose(toxicity.MIN_Z, 3.2)
