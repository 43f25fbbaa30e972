import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabflow.llm import mixing, search, sharding
from tabflow.llm.common import word_count


def filled(sizes, weights, stop, budget):
    """Water-filling by bisection of the level."""
    low, high = 0.0, budget + 1
    for _ in range(200):
        level = (low + high) / 2
        if sum(min(stop * s, w * level) for s, w in zip(sizes, weights)) < budget:
            low = level
        else:
            high = level
    return [min(stop * s, w * low) for s, w in zip(sizes, weights)]


@pytest.mark.parametrize("sizes", [[10, 1000, 5, 300], [1, 1, 1], [0, 7, 900], [50]])
def test_targets_meet_the_budget_below_their_stops(spark, sizes):
    weights = [float(1 + i % 3) for i in range(len(sizes))]
    rows = spark.createDataFrame(list(zip(map(str, range(len(sizes))), sizes, weights)), "source string, source_size long, weight double")
    got = {r.source: r.target for r in mixing.water_fill(rows).collect()}
    expected = filled(sizes, weights, 3, sum(sizes))
    assert [got[str(i)] for i in range(len(sizes))] == pytest.approx(expected, rel=1e-9, abs=1e-6)


def test_taken_words_come_near_their_targets(spark, smoke):
    docs = spark.read.parquet(f"{smoke}/documents.parquet")
    mixed = mixing.mix(docs, word_count(F.col("text")), [1, 2, 3])
    per_source = mixed.groupBy("source").agg(
        F.first("target").alias("target"), F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("size").alias("largest"),
        F.max("copies").alias("most"),
    ).collect()
    for row in per_source:
        assert abs(row.taken - row.target) <= row.largest / 2 + 1
        assert row.most <= 3
    again = mixing.mix(docs.repartition(7), word_count(F.col("text")), [1, 2, 3])
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, again.collect()))


def test_cutoffs_are_those_of_a_sorted_source(spark):
    chance = np.random.default_rng(5)
    rows = [("s", int(d), int(n)) for d, n in zip(chance.integers(0, 1 << 60, 500), chance.integers(0, 50, 500))]
    quota = 0.37 * sum(r[2] for r in rows)
    got = mixing.cutoffs(
        spark.createDataFrame(rows, "source string, draw long, size long"),
        spark.createDataFrame([("s", quota)], "source string, quota double"),
    ).first()["cutoff"]
    running, taken = 0, set()
    for _, d, n in sorted(rows, key=lambda r: r[1]):
        running += n
        if 2 * running - n <= 2 * quota:
            taken.add(d)
    assert {d for _, d, n in rows if d <= got and n} == {d for _, d, n in rows if d in taken and n}


def test_mix_of_odd_rows(spark, odd, none):
    mixed = mixing.mix(odd, word_count(F.col("text")), [1, 2, 3])
    assert mixed.count() == odd.count()
    ties = {tuple(r) for r in mixed.filter("key = 7").collect()}
    assert len(ties) == 1
    assert mixing.mix(none, word_count(F.col("text")), [1, 2, 3]).count() == 0
    whole = mixing.mixed_documents(odd, word_count(F.col("text")), [1, 2, 3])
    assert whole.columns == odd.columns
    assert whole.count() == sum(r.copies for r in mixed.collect())


def jumped(key, shards):
    b, j = -1, 0
    while j < shards:
        b, key = j, (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1), min_size=1, max_size=20), st.integers(1, 300))
def test_jump_is_the_published_loop(keys, shards):
    got = sharding.jump(np.array(keys, np.uint64), shards)
    assert got.tolist() == [jumped(k, shards) for k in keys]


def test_shards_of_odd_rows(spark, odd, odd_rows, none):
    rows = sharding.shards_by_key(odd, 4).collect()
    assert sorted((r.size, r.text_crc32) for r in rows) == sorted(
        (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, *_ in odd_rows
    )
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 4)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r.shard for r in rows if r.key is None}) == 1
    assert sharding.shards_by_key(none, 4).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("key"), 0)


def test_slots_are_gapless_over_many_intervals(spark):
    rows = spark.range(5000).select((F.col("id") % 3).alias("shard"), "id")
    placed = sharding.numbered(rows, F.xxhash64("id"), bucket_rows=50)
    for r in placed.groupBy("shard").agg(F.collect_list("slot").alias("s")).collect():
        assert sorted(r.s) == list(range(len(r.s)))


def test_written_shards_hold_every_row(spark, odd, tmp_path):
    path = str(tmp_path / "shards")
    named = odd.withColumn("shard", F.lit("own"))
    sharding.write_shards(named, path, 3, files_per_shard=2)
    back = spark.read.parquet(path)
    assert sorted(map(repr, back.select([F.col(f"`{c}`") for c in named.columns]).collect())) == sorted(map(repr, named.collect()))
    placed = {(r.doc_id, r.shard_folder) for r in back.collect()}
    assert placed == {(r.key, r.shard) for r in sharding.shards_by_key(odd, 3).collect()}
    with pytest.raises(ValueError):
        sharding.write_shards(named, path, 3, folder="shard")


def brute_top(vectors, k):
    whole = {i: [math.floor(256 * float(x)) for x in v] for i, v in vectors.items()}
    out = set()
    for q in (i for i in whole if i % 50 == 0):
        scored = [(sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q])]
        out |= {(q, r + 1, i, s) for r, (s, i) in enumerate(sorted(scored, key=lambda x: (-x[0], x[1]))[:k])}
    return out


@pytest.mark.parametrize("shard_rows, fan_in", [(4096, 16), (7, 2)])
def test_top_k_is_brute_force(spark, shard_rows, fan_in):
    chance = np.random.default_rng(3)
    vectors = {i: chance.integers(-3, 3, 4).astype(float) / 8 for i in range(120)}
    rows = [(i, v.tolist()) for i, v in vectors.items()]
    odd = [(200, None), (201, [1.0, None, 0.0, 0.0]), (202, [float("nan")] * 4), (203, [float("inf")] * 4), (None, [1.0] * 4)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    got = search.top_k(table, F.col("vec_id") % 50 == 0, 5, query_rows=2, shard_rows=shard_rows, fan_in=fan_in)
    assert {tuple(r) for r in got.collect()} == brute_top(vectors, 5)


def test_top_k_of_few_large_and_unequal_vectors(spark):
    big = float(1 << 23)
    rows = [(0, [big, 1.0]), (1, [big, big]), (2, [1.0, 2.0, 3.0]), (50, [0.0, 0.0]), (50, [0.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {tuple(r) for r in search.top_k(table, F.col("vec_id") % 50 == 0, 5).collect()}
    scale = 256 * (1 << 23)  # a product of 62 bits, which no double holds
    assert (0, 1, 1, scale * scale + 256 * scale) in got
    assert {r[:3] for r in got} == {(0, 1, 1), (0, 2, 50), (0, 3, 50), (50, 1, 0), (50, 2, 1)}
    assert search.top_k(table.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_products_beyond_64_bits_are_the_nearest(spark):
    big = float(1 << 24)
    rows = [(0, [big, 1.0]), (1, [big, big]), (2, [-big, 0.0]), (3, [2.0 * big, big]), (4, [1e300, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    table = table.select("*", F.lit(1).alias("a.b"), F.lit("t").alias("tile"), F.lit("v").alias("v"))
    got = [tuple(r) for r in search.top_k(table, F.col("vec_id") == 0, 5).orderBy("rank").collect()]
    most, least = (1 << 63) - 1, -(1 << 63)
    assert got == [(0, 1, 1, most), (0, 2, 3, most), (0, 3, 4, most), (0, 4, 2, least)]
