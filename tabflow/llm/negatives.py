"""Hard-negative mining by lists that the anchors of a cluster share.

Anchors are clustered by direction. For a cluster with centre c and largest angle b between c and a
member, no member's inner product with x is above |member| |x| cos(angle(c, x) - b). A cluster sorts the
candidates by that bound once; its members walk the list together, and a member leaves when the bound is
below all scores that it still needs: what lies behind is certified not to be among its best.

The candidates are dealt into shards and the anchors into tiles of whole clusters; a task sorts and walks
the lists of one tile over one shard. A small part of the shards goes first, and the scores found there
are where the walks over the others may stop at the latest, so these return few rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabflow.llm.common import picked
from tabflow.llm.search import products
from tabflow.sources.shared import persist_state

FOUND = "anchor_id long, band int, vec_id long, score long"
LEAST, MOST = -(1 << 63), (1 << 63) - 1
ANGLE_ERROR = 1e-6  # above that of an arccos in doubles near 0
RELATIVE_ERROR = 1e-9  # above that of norms and products in doubles
FIRST_BLOCK, LARGEST_BLOCK = 128, 1024  # candidates between two looks at the bounds
SAMPLE, ROUNDS = 4096, 8  # anchors that the centres are fitted on, and rounds of that


def labelled_vectors(table: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """Rows (vec_id, label, v, dim, draw): floor(scale * x) of every component, within 64 bits.

    A null key, label or vector, and a null, NaN or infinite component, leave the row out. `draw` deals
    the rows; equal rows have different ones.
    """
    rows = picked(table, vec_id=key, label=label, v=vector)
    rows = rows.select(*[F.col(c).cast("long") for c in ("vec_id", "label")], F.col("v").cast("array<double>"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.dropna().filter(finite)
    whole = F.transform("v", lambda x: F.floor(x * scale).cast("double"))
    return rows.select("vec_id", "label", whole.alias("v"), F.size("v").alias("dim"), F.monotonically_increasing_id().alias("draw"))


def directions(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and lengths; a zero vector has no direction and stays zero."""
    lengths = np.sqrt((vectors * vectors).sum(axis=1))
    return vectors / np.where(lengths > 0, lengths, 1)[:, None], lengths


def centres(sample: np.ndarray, clusters: int) -> np.ndarray:
    """Centres of directions by rounds of nearest centre and mean direction."""
    units, lengths = directions(sample)
    units = np.unique(units[lengths > 0], axis=0)
    chosen = units[np.random.default_rng(13).permutation(len(units))[:clusters]]
    for _ in range(ROUNDS if len(units) else 0):
        nearest = (units @ chosen.T).argmax(axis=1)
        sums = np.zeros_like(chosen)
        np.add.at(sums, nearest, units)
        moved, held = directions(sums)
        chosen = np.where((held > 0)[:, None], moved, chosen)
    return chosen


def clustered(anchors: DataFrame, clusters: int, tile_rows: int) -> DataFrame:
    """Adds `cluster` and `tile`: tiles hold about `tile_rows` anchors of neighbouring clusters, and a
    cluster with more of them lies in several tiles. Centres come from a sample of 4,096 anchors."""
    sample = [r.v for r in anchors.orderBy(F.xxhash64("vec_id")).limit(SAMPLE).select("v").collect()]
    dims = [len(v) for v in sample]
    dim = max(set(dims), key=dims.count) if dims else 0
    fitting = [v for v in sample if len(v) == dim]
    chosen = centres(np.array(fitting, float).reshape(len(fitting), dim), clusters)

    @F.pandas_udf("int")
    def nearest(vectors: pd.Series) -> pd.Series:
        fit = vectors.map(len).to_numpy() == dim
        out = np.full(len(vectors), -1, np.int32)
        if fit.any() and len(chosen):
            out[fit] = (np.stack(vectors[fit].to_numpy()) @ chosen.T).argmax(axis=1)
        return pd.Series(out)

    anchors = persist_state(anchors.withColumn("cluster", nearest("v")), "anchors")
    counts = anchors.groupBy("cluster").agg(F.count("*").alias("members"))
    before = F.sum("members").over(Window.orderBy("cluster")) - F.col("members")
    places = counts.select(F.col("cluster").alias("of_cluster"), "members", before.alias("offset"))  # a row per cluster
    share = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(1 << 30)) / float(1 << 30)
    placed = anchors.join(F.broadcast(places), F.col("cluster") == F.col("of_cluster"))
    tile = F.floor((F.col("offset") + share * F.col("members")) / tile_rows).cast("int")
    return placed.withColumn("tile", tile).drop("of_cluster", "members", "offset")


class Kept:
    """The k best (score, id) per member and band, and the score below which nothing more is needed."""

    def __init__(self, k: int, low: np.ndarray) -> None:
        self.k, self.low = k, low.copy()
        self.rows = tuple(np.zeros(0, np.int64) for _ in range(4))  # member, band, score, id

    def add(self, *more: np.ndarray) -> None:
        member, band, score, ids = (np.concatenate(x) for x in zip(self.rows, more))
        order = np.lexsort((ids, ~score, band, member))  # ~ turns the order without an overflow
        member, band, score, ids = (x[order] for x in (member, band, score, ids))
        first = np.flatnonzero(np.diff(member, prepend=-1) | np.diff(band, prepend=-1))
        rank = np.arange(len(member)) - np.repeat(first, np.diff(first, append=len(member)))
        last = rank == self.k - 1
        self.low[member[last], band[last]] = np.maximum(self.low[member[last], band[last]], score[last])
        self.rows = tuple(x[rank < self.k] for x in (member, band, score, ids))


def walk(
    ids: np.ndarray, own: np.ndarray, vectors: np.ndarray, low: np.ndarray, high: np.ndarray,
    others: np.ndarray, labels: np.ndarray, candidates: np.ndarray, k: int, same: bool,
) -> tuple[Kept, int]:
    """The k best candidates of every member of one cluster, per band of scores from `low` to `high`, and
    how many products that took. Candidates of the member's own label count, or else those of others."""
    units, lengths = directions(vectors)
    centre = directions(units.sum(axis=0)[None])[0][0]
    widest = np.arccos(np.clip(units[lengths > 0] @ centre, -1, 1)).max(initial=0) + ANGLE_ERROR
    turned, sizes = directions(candidates)
    angle = np.arccos(np.clip(turned @ centre, -1, 1))
    bound = sizes * np.cos(np.maximum(0, angle - widest))
    order = np.argsort(-bound, kind="stable")
    kept, at, block, looked = Kept(k, low), 0, FIRST_BLOCK, 0
    while at < len(order):
        reach = bound[order[at]] * lengths
        reach += np.abs(sizes.max() * lengths) * RELATIVE_ERROR + 1
        needed = np.where(kept.low <= high, kept.low, MOST).min(axis=1)
        members = np.flatnonzero(reach >= needed.astype(float))
        members = members[(kept.low[members] <= high[members]).any(axis=1)]
        if not len(members):
            break
        part = order[at : at + block]
        at, block = at + block, min(2 * block, LARGEST_BLOCK)
        scores = products(vectors[members], candidates[part])
        looked += scores.size
        fit = (own[members][:, None] == labels[part]) == same
        fit &= ids[members][:, None] != others[part]
        for band in range(low.shape[1]):
            within = fit & (scores >= kept.low[members, band][:, None]) & (scores <= high[members, band][:, None])
            row, column = np.nonzero(within)
            if len(row):
                kept.add(members[row], np.full(len(row), band), scores[row, column], others[part[column]])
    return kept, looked


def _walker(k: int, same: bool):
    def best(asked: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        names = ["anchor_id", "band", "vec_id", "score"]
        out = [pd.DataFrame({c: pd.Series(dtype="int64") for c in names})]
        if len(asked) and len(shard):
            others, labels, candidates = shard["vec_id"].to_numpy(), shard["label"].to_numpy(), np.stack(shard["v"].to_numpy())
            for _, members in asked.groupby("cluster"):
                ids, own = members["vec_id"].to_numpy(), members["label"].to_numpy()
                vectors, low, high = (np.stack(members[c].to_numpy()) for c in ("v", "low", "high"))
                kept, _ = walk(ids, own, vectors, low, high, others, labels, candidates, k, same)
                member, band, score, found = kept.rows
                out.append(pd.DataFrame({"anchor_id": ids[member], "band": band, "vec_id": found, "score": score}))
        return pd.concat(out)

    return best


def best_in_bands(asked: DataFrame, rows: DataFrame, shards: int, tiles: int, k: int, same: bool) -> DataFrame:
    """Rows (anchor_id, band, rank, vec_id, score): the k best rows per anchor and band of scores.

    `asked` has the anchors with `tile`, `cluster` and arrays `low` and `high`, a place per band; `rows`
    have `shard`. Shards go in parts of 1/1024, 1/32 and the rest; `low` rises from part to part.
    """
    bands = asked.withColumn("low_of", F.col("low"))
    order = Window.partitionBy("anchor_id", "band").orderBy(F.col("score").desc(), "vec_id")
    stops, begin, found = sorted({-(-shards // 1024), -(-shards // 32), shards}), 0, None
    for stop in stops:
        spread = F.explode(F.sequence(F.lit(begin), F.lit(stop - 1))).alias("shard")
        left = bands.select("vec_id", "label", "v", "cluster", "low", "high", "dim", "tile", spread)
        part = rows.filter((F.col("shard") >= begin) & (F.col("shard") < stop))
        copies = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile")
        right = part.select(*[F.col(c).alias(c) for c in ("vec_id", "label", "v", "dim", "shard")], copies)
        pair = ["dim", "tile", "shard"]
        seen = left.groupBy(*pair).cogroup(right.groupBy(*pair)).applyInPandas(_walker(k, same), FOUND)
        seen = persist_state(seen, "found")
        found = seen if found is None else found.unionByName(seen)
        begin = stop
        if stop < shards:
            last = found.withColumn("at", F.row_number().over(order)).filter(F.col("at") == k)
            reached = last.groupBy(F.col("anchor_id").alias("of_anchor")).agg(
                F.map_from_entries(F.collect_list(F.struct("band", "score"))).alias("reached")
            )
            risen = F.transform("low_of", lambda x, i: F.greatest(x, F.coalesce(F.col("reached")[i], x)))
            joined = asked.withColumn("low_of", F.col("low")).join(reached, F.col("vec_id") == F.col("of_anchor"), "left")
            bands = joined.withColumn("low", F.coalesce(risen, F.col("low"))).drop("of_anchor", "reached")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("anchor_id", "band", "rank", "vec_id", "score")


def filled(limit: str, places: int, empty: int) -> Column:
    """One limit of all bands; a place without a positive gets one that nothing meets."""
    held = F.col("bands")[limit]
    return F.transform(F.sequence(F.lit(0), F.lit(places - 1)), lambda i: F.coalesce(F.get(held, i), F.lit(empty))).alias(limit)


def hard_negatives(
    table: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low_percent: int = 30,
    high_percent: int = 90, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    scale: int = 256, tile_rows: int = 2048, shard_rows: int = 32_768,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `is_anchor` is a condition on `vec_id`. An anchor's positives are its best rows of the same integer
    label; its negatives for a positive are the best rows of other labels whose score is between the two
    percentages of the positive's score. Scores are inner products within 64 bits: a product beyond is
    the nearest of them. Only vectors of equal length are compared. An id given to several rows is one
    anchor, with the least label and vector of them; as candidates its rows count each. Equal scores come
    by ascending id. A positive score below 0 has no negatives; an empty table gives no rows.
    """
    rows = persist_state(labelled_vectors(table, key, vector, label, scale), "vectors")
    n = rows.count()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    shards = max(1, -(-n // shard_rows), min(cores, -(-n // 4096)))
    rows = rows.withColumn("shard", F.pmod("draw", F.lit(shards)).cast("int"))
    anchors = rows.filter(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row"))
    anchors = persist_state(anchors.select("vec_id", "row.label", "row.v", F.size("row.v").alias("dim")), "anchors")
    m = anchors.count()
    tiles = max(1, -(-m // tile_rows))
    anchors = persist_state(clustered(anchors, min(256, max(1, m // 32)), tile_rows), "anchors")
    whole = anchors.select("*", F.array(F.lit(LEAST)).alias("low"), F.array(F.lit(MOST)).alias("high"))
    near = persist_state(best_in_bands(whole, rows, shards, tiles, positives, same=True), "positives")

    p, rest = F.col("score"), F.pmod("score", F.lit(100))
    hundreds = F.expr("(score - pmod(score, 100)) div 100")
    near = near.filter(p >= 0).select(
        F.col("anchor_id").alias("of_anchor"), (F.col("rank") - 1).alias("place"), "vec_id", "score",
        (hundreds * low_percent + F.ceil(rest * low_percent / 100)).alias("low"),
        (hundreds * high_percent + F.floor(rest * high_percent / 100)).alias("high"),
    )
    bands = near.groupBy("of_anchor").agg(F.sort_array(F.collect_list(F.struct("place", "low", "high"))).alias("bands"))
    asked = anchors.join(bands, F.col("vec_id") == F.col("of_anchor")).select(
        "vec_id", "label", "v", "dim", "cluster", "tile", filled("low", positives, MOST), filled("high", positives, LEAST)
    )
    asked = persist_state(asked, "asked")
    far = best_in_bands(asked, rows, shards, tiles, negatives, same=False)
    far = far.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
    named = near.select("of_anchor", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    joined = far.join(named, (F.col("anchor_id") == F.col("of_anchor")) & (F.col("band") == F.col("place")))
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
