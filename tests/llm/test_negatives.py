import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabflow.llm import negatives

SCHEMA = "vec_id long, label int, embedding array<double>"


def brute(rows, positives=5, count=10):
    """Every anchor against every row, as the contract states it."""
    whole = [(i, l, [math.floor(256 * x) for x in v]) for i, l, v in rows]
    out = []
    anchors = {}
    for i, l, v in whole:
        if i % 100 == 0:
            anchors[i] = min(anchors.get(i, (l, v)), (l, v))
    for a, (label, vector) in anchors.items():
        scored = [(sum(x * y for x, y in zip(vector, v)), i, l == label) for i, l, v in whole if i != a and len(v) == len(vector)]
        scored.sort(key=lambda x: (-x[0], x[1]))
        for p, i, _ in [s for s in scored if s[2]][:positives]:
            fit = [s for s in scored if not s[2] and 30 * p <= 100 * s[0] <= 90 * p][:count]
            out += [(a, i, r + 1, n, p, s) for r, (s, n, _) in enumerate(fit)]
    return sorted(out)


def mined(spark, rows, schema=SCHEMA, **sizes):
    table = spark.createDataFrame(rows, schema).repartition(3)
    return sorted(tuple(r) for r in negatives.hard_negatives(table, F.col("vec_id") % 100 == 0, **sizes).collect())


@pytest.mark.parametrize("sizes", [{}, {"tile_rows": 3, "shard_rows": 40}])
def test_mining_is_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(negatives, "FIRST_BLOCK", 8)
    chance = np.random.default_rng(11)
    rows = [(i, int(chance.integers(0, 3)), (chance.integers(-4, 5, 6) / 8).tolist()) for i in range(1500)]
    rows += [(1500 + i, 1, rows[7][2]) for i in range(80)]  # copies
    rows += [(1700, 0, [0.0] * 6), (1800, 2, [0.25, 0.5]), (1801, 2, [0.5, 0.5]), (1802, 1, [0.5, 0.25])]
    rows += [(1900, 2, [1.0] * 6), (1900, 1, [2.0] * 6), rows[5], rows[5]]  # an anchor in two rows, repeated rows
    assert mined(spark, rows, **sizes) == brute(rows)


def test_lists_end_early_and_lose_nothing():
    """Anchors in a narrow cone: the walk looks at few candidates and finds what all products give."""
    chance = np.random.default_rng(2)
    centre = chance.normal(size=16) * 100
    members = np.floor(centre + chance.normal(size=(20, 16)))
    candidates = np.floor(chance.normal(size=(4000, 16)) * 20 * chance.uniform(0.1, 3, size=(4000, 1)))
    low, high = np.full((20, 1), negatives.LEAST), np.full((20, 1), negatives.MOST)
    ids, own = np.arange(20), np.zeros(20, np.int64)
    others, labels = np.arange(100, 4100), np.ones(4000, np.int64)
    kept, looked = negatives.walk(ids, own, members, low, high, others, labels, candidates, 10, same=False)
    scores = (members @ candidates.T).astype(np.int64)
    member, _, score, found = kept.rows
    for m in range(20):
        order = np.lexsort((others, -scores[m]))[:10]
        assert found[member == m].tolist() == others[order].tolist()
        assert score[member == m].tolist() == scores[m][order].tolist()
    assert looked < 20 * 4000 / 4


def test_rows_without_part_and_clashing_columns(spark):
    part = [(0, 1, [1.0, 0.5]), (1, 1, [1.0, 1.0]), (2, 2, [0.5, 0.5]), (3, 2, [0.25, 0.25])]
    none = [(4, None, [1.0, 1.0]), (5, 1, None), (6, 1, [1.0, None]), (7, 1, [float("nan"), 1.0]), (8, 1, [float("inf"), 0.0]), (None, 1, [1.0, 1.0])]
    clashing = f"{SCHEMA}, shard string, cluster string, tile string, draw string, low string, `a.b` string"
    rows = [(*r, *"abcdef") for r in part + none]
    assert mined(spark, rows, clashing) == brute(part)
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1.0])]) == []  # no anchor


def test_products_beyond_64_bits_are_the_nearest(spark):
    big = float(1 << 45)
    rows = [(0, 1, [big]), (1, 1, [big]), (2, 2, [big / 2]), (3, 2, [-big])]
    found = mined(spark, rows)
    assert found == []  # both products are the largest number, above 90 percent of it
    rows += [(4, 2, [big * 0.5 / (1 << 50)])]
    assert mined(spark, rows) == []
