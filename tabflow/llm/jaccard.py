"""N-gram Jaccard join: groups of texts whose sets of word shingles are alike, by signature trees.

Only sets that share enough shingles with other sets can be alike; the others are left out by exact
counts over all texts. Sets that can be alike share one of their first shingles in a common order, the
rarest first (prefix filter), so the sets that shingles connect in this way form families, and a passage
that very many texts share makes no family. Within a family signature trees find the links; large families
are cut into parts, every part has a tree, and parts are joined with one part first; after that only sets
that share one of their first shingles with a set they are not connected with meet that set's part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tabflow.llm.common import chunks, lower_words, named, raw_texts, release
from tabflow.llm.sigtree import Links, Tree, link
from tabflow.sources.buckets import write_buckets
from tabflow.sources.shared import new_path, persist_state, remove, shuffles_freed

SHINGLE = 5
PERCENT = 75
KEPT_BITS = 48  # of a shingle's hash, kept after the distinct shingles of a text are counted
SPARE_BITS = 12  # a shingle passes for one found elsewhere by chance once in 2 ** SPARE_BITS times
BLOCK_SHINGLES = 500_000  # shingles of the sets in one row; a larger set is a row of its own
BUCKET_SHINGLES = 1_000_000  # shingles that are counted in one group
PART_SHINGLES = 2_000_000  # shingles of the sets that one tree holds; a larger set is a part of its own
BITMAP_SHINGLES = 64  # of so many shingles a set's bitmap has the size, and counts as so many in a part
FACTOR = np.uint64(0x9E3779B97F4A7C15)
KEPT = np.uint64((1 << KEPT_BITS) - 1)


def shingles(words: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of `size` words; of the whole sequence if it is shorter."""
    if not words:
        return np.zeros(0, np.uint64)
    size = min(size, len(words))
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(codes) - size + 1
    mixed = np.full(n, size, np.uint64)
    for i in range(size):
        mixed = mixed * FACTOR + codes[i : i + n]
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xA0761D6478BD642F)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def fingerprint(hashes: np.ndarray) -> int | None:
    """A signed 64-bit name of a set; None for the empty set."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())))) if len(hashes) else None


def kept_bits(hashes: np.ndarray) -> np.ndarray:
    """The leading bits of sorted hashes, which keep their order."""
    return hashes >> np.uint64(64 - KEPT_BITS)


def pack(values: np.ndarray) -> bytes:
    """Differences of values of KEPT_BITS bits, byte by byte, compressed; any order of values is kept."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    planes = steps.view(np.uint8).reshape(-1, 8).T[: KEPT_BITS // 8]
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(packed: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(KEPT_BITS // 8, n)
    steps = np.zeros((n, 8), np.uint8)
    steps[:, : KEPT_BITS // 8] = planes.T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64) & KEPT


class _Block:
    """Sets on their way into one row: numbers of the sets, sizes, and all hashes behind each other."""

    def __init__(self, number: int, keyed: pa.DataType | None = None) -> None:
        self.number, self.keyed, self.held = number, keyed, 0
        self.columns: list[list] = [[] for _ in range(4)]
        self.hashes: list[np.ndarray] = [np.zeros(0, np.uint64)]

    def add(self, key, text_hash: int | None, node: int | None, hashes: np.ndarray) -> None:
        for column, value in zip(self.columns, (key, text_hash, node, len(hashes))):
            column.append(value)
        self.hashes.append(hashes)
        self.held += len(hashes)

    def full(self) -> bool:
        return self.held >= BLOCK_SHINGLES or len(self.columns[0]) >= BLOCK_SHINGLES // 10

    def row(self) -> pa.RecordBatch:
        long, names = pa.int64(), ["keys", "text_hashes", "nodes", "sizes"]
        arrays = [pa.array([c], pa.list_(t)) for c, t in zip(self.columns, (self.keyed or long, long, long, long))]
        first = 0 if self.keyed else 2
        packed = pa.array([pack(np.concatenate(self.hashes))], pa.binary())
        columns = [pa.array([self.number], long), *arrays[first:], packed]
        return pa.RecordBatch.from_arrays(columns, ["block", *names[first:], "hashes"])


def _blocks_of_texts(kind: pa.DataType):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(TaskContext.get().partitionId() << 32, kind)
        for batch in (c for b in batches for c in chunks(b)):
            keys, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for key, text_hash, raw in zip(keys, hashes, raw_texts(batch.column(2))):
                found = shingles(lower_words(raw))
                block.add(key, text_hash, fingerprint(found), kept_bits(found))
                if block.full():
                    yield block.row()
                    block = _Block(block.number + 1, kind)
        if block.columns[0]:
            yield block.row()

    return read


def _blocks_of_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = _Block(TaskContext.get().partitionId() << 32)
    for batch in batches:
        for node, n, hashes in zip(*(batch.column(i).to_pylist() for i in range(3))):
            block.add(None, None, node, unpack(hashes, n))
            if block.full():
                yield block.row()
                block = _Block(block.number + 1)
    if block.columns[0]:
        yield block.row()


def _packs(bits: int, cut: int):
    """Per block and bucket of the hash space: the distinct hashes, and how often each comes in the block.

    The last `cut` bits of the hashes stay behind: those before them tell nearly all shingles apart.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (c for b in batches for c in chunks(b, 1)):
            block, sizes = row.column("block")[0].as_py(), row.column("sizes")[0].as_py()
            values = unpack(row.column("hashes")[0].as_py(), sum(sizes)) >> np.uint64(cut)
            distinct, times = np.unique(values, return_counts=True)
            bucket = distinct >> np.uint64(KEPT_BITS - cut - bits)
            edges = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(distinct)]
            spans = [(a, b) for a, b in zip(edges, edges[1:]) if b > a]
            columns = [
                pa.array([int(bucket[a]) for a, _ in spans], pa.int64()),
                pa.array([block] * len(spans), pa.int64()),
                pa.array([b - a for a, b in spans], pa.int64()),
                pa.array([pack(distinct[a:b]) for a, b in spans], pa.binary()),
                pa.array([_squeezed(np.minimum(times[a:b], 255)) for a, b in spans], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "block", "n", "hashes", "times"])

    return split


def _squeezed(small: np.ndarray) -> bytes:
    """Numbers below 256, a byte each, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(small.astype(np.uint8).tobytes())


def _small(squeezed: list[bytes]) -> np.ndarray:
    one = zstandard.ZstdDecompressor()
    return np.concatenate([np.frombuffer(one.decompress(x), np.uint8) for x in squeezed])


def _levels(group: pa.Table) -> pa.Table:
    """Of one bucket: how common the hashes of each block are, from 0 (found nowhere else) to 255.

    A level grows with the logarithm of the count. It depends on the hash alone (counts within a block
    stop at 255), so it orders the shingles of all sets alike.
    """
    release()
    sizes = group.column("n").to_pylist()
    hashes = np.concatenate([unpack(x, n) for x, n in zip(group.column("hashes").to_pylist(), sizes)])
    times = _small(group.column("times").to_pylist())
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    counts = np.add.reduceat(times[order], first, dtype=np.int64)
    found = np.minimum(np.ceil(8 * np.log2(counts)), 255).astype(np.uint8)
    levels = np.empty(len(order), np.uint8)
    levels[order] = np.repeat(found, np.diff(first, append=len(order)))
    ends = np.cumsum(sizes)
    packed = [_squeezed(levels[b - n : b]) for b, n in zip(ends, sizes)]
    return pa.table([group.column("block"), group.column("bucket"), pa.array(packed, pa.binary())], ["of_block", "bucket", "levels"])


def _linkable(percent: int, cut: int):
    """The sets that can be alike with others, and their first shingles in the order (level, hash).

    A set that is alike with another shares at least `percent` of its shingles, so its first
    n - percent * n + 1 hold a shared one; those of level 0 among these are found nowhere else.
    """

    def choose(block: pa.Table, found: pa.Table) -> pa.Table:
        release()
        names = ["node", "n", "hashes", "prefix"]
        types = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
        rows: list[list] = [[], [], [], []]
        if block.num_rows and found.num_rows:
            found = found.sort_by("bucket")
            sizes = np.array(block.column("sizes")[0].as_py(), np.int64)
            values = unpack(block.column("hashes")[0].as_py(), int(sizes.sum()))
            levels = _small(found.column("levels").to_pylist())[np.unique(values >> np.uint64(cut), return_inverse=True)[1]]
            ends, upto = np.cumsum(sizes), np.concatenate([[0], np.cumsum(levels > 0)])
            alone = sizes - (upto[ends] - upto[ends - sizes])
            wanted = sizes - -(-percent * sizes // 100) + 1 - alone
            nodes = block.column("nodes")[0].as_py()
            for i in np.flatnonzero((wanted > 0) & (sizes > 0)).tolist():
                span = slice(ends[i] - sizes[i], ends[i])
                order = np.argsort(levels[span], kind="stable")[alone[i] : alone[i] + wanted[i]]
                first = values[span][order].astype(np.int64)
                for column, value in zip(rows, (nodes[i], int(sizes[i]), pack(values[span]), first)):
                    column.append(value)
        return pa.table([pa.array(c, t) for c, t in zip(rows, types)], names)

    return choose


def linkable(blocks: DataFrame, percent: int) -> DataFrame:
    """Rows (node, n, hashes, prefix) of the blocks' sets that may link; exact for any data.

    Hashes are counted per bucket of the hash space. A block sends a hash at most once, so a shingle of
    very many texts is as many values as there are blocks, and gets one level back for each. As many leading
    bits of a hash are sent as the number of shingles needs; two that agree in these only count as
    shared, which can add candidates and never loses one. The levels are written, so what was sent can go
    before they meet the blocks; blocks stored in buckets of their number stay where they are.
    """
    rows = blocks.select("block", "nodes", "sizes", "hashes")
    total = rows.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    bits = math.ceil(math.log2(max(2, total / BUCKET_SHINGLES)))
    cut = max(0, KEPT_BITS - max(bits, math.ceil(math.log2(max(2, total))) + SPARE_BITS))
    packs = rows.mapInArrow(_packs(bits, cut), "bucket long, block long, n long, hashes binary, times binary")
    levels = persist_state(packs.groupBy("bucket").applyInArrow(_levels, "of_block long, bucket long, levels binary"), "levels")
    together = rows.groupBy("block").cogroup(levels.groupBy("of_block"))
    return together.applyInArrow(_linkable(percent, cut), "node long, n long, hashes binary, prefix array<long>")


def _stored(blocks: DataFrame, path: str) -> DataFrame:
    """Blocks written where they are made, in buckets of their number; as many as a shuffle has partitions,
    since Spark would move the blocks to fewer."""
    conf = blocks.sparkSession.conf
    most = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or conf.get("spark.sql.shuffle.partitions")
    return write_buckets(blocks, ["block"], int(most), path, moved=False)


def candidates(blocks: DataFrame, percent: int, path: str | None = None) -> DataFrame:
    """The sets of `linkable`, once each, after a second count among themselves.

    The first count sees every copy of a text; in the second each set counts once. The folder `path`, that
    of the blocks, is deleted once they are read.
    """
    spark, own = blocks.sparkSession, new_path(blocks.sparkSession, "blocks")
    first = linkable(blocks, percent).groupBy("node").agg(F.first("n").alias("n"), F.first("hashes").alias("hashes"))
    again = first.mapInArrow(_blocks_of_sets, "block long, nodes array<long>, sizes array<long>, hashes binary")
    again = _stored(again, own)
    if path is not None:
        remove(spark, path)
    found = persist_state(linkable(again, percent), "candidates")
    remove(spark, own)
    return found


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of the edges (a, b): root is the smallest connected node.

    Alternating large-star and small-star rounds (Kiveris and others): minima are summed on the map side
    and joined back, so a hub with very many neighbours is no hot task. Every round is written, which
    cuts the lineage; rounds end when the edges stay as they are.
    """

    def low(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("low"))

    def signature(pairs: DataFrame):
        return pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    oriented = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b")
    pairs, before = persist_state(oriented.distinct(), "edges"), None
    while (now := signature(pairs)) != before:
        before = now
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = low(both).withColumn("low", F.least("low", "of"))
        star = both.filter("b > a").join(least, F.col("a") == F.col("of")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        pairs = persist_state(star.filter("a != b").distinct(), "edges")
        hung = pairs.join(low(pairs), F.col("a") == F.col("of")).select("a", "b", "low")
        moved = hung.select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a != b")
        pairs = persist_state(moved.union(hung.select("a", F.col("low").alias("b"))).distinct(), "edges")
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return persist_state(pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots), "roots")


def families(sets: DataFrame) -> DataFrame:
    """Rows (node, root) of all sets that share a prefix shingle with another set."""
    each = sets.filter(F.size("prefix") > 0).select("node", F.explode("prefix").alias("shingle"))
    held = each.groupBy("shingle").agg(F.min("node").alias("hub"), F.max("node").alias("last"))
    shared = persist_state(held.filter("hub != last").select(F.col("shingle").alias("of"), "hub"), "shared")
    edges = each.join(shared, F.col("shingle") == F.col("of")).filter("node != hub")
    return components(edges.select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct())


def _table_sets(table: pa.Table) -> list[np.ndarray]:
    return [unpack(x, n) for x, n in zip(table.column("hashes").to_pylist(), table.column("n").to_pylist())]


def _edges(nodes: np.ndarray, links: Links) -> pa.Table:
    roots = links.roots()
    moved = np.flatnonzero(roots != np.arange(len(roots)))
    return pa.table([pa.array(nodes[moved], pa.int64()), pa.array(nodes[roots[moved]], pa.int64())], ["a", "b"])


def _within(percent: int):
    def joined(group: pa.Table) -> pa.Table:
        """Links inside each family of the group: a tree against itself."""
        release()
        found = []
        family = group.column("family").to_numpy()
        order = np.argsort(family, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(family[order])) + 1):
            part = group.take(pa.array(at))
            sets, links = _table_sets(part), Links(len(at))
            tree = Tree(sets)
            link(tree, tree, sets, sets, 0, links, percent)
            found.append(_edges(part.column("node").to_numpy(), links))
        return pa.concat_tables(found)

    return joined


def _between(percent: int):
    def joined(group: pa.Table) -> pa.Table:
        """Links between two parts of a family, or in one part, starting from what is connected already."""
        release()
        side = group.column("side").to_numpy()
        order = np.argsort(side, kind="stable")
        group, split = group.take(pa.array(order)), int((side == 0).sum())
        sets, links = _table_sets(group), Links(len(order))
        first: dict[int, int] = {}
        for i, root in enumerate(group.column("root").to_pylist()):
            links.connect(i, first.setdefault(root, i))
        if group.column("i")[0] == group.column("j")[0]:
            tree = Tree(sets)
            link(tree, tree, sets, sets, 0, links, percent)
        elif 0 < split < len(order):
            left, right = sets[:split], sets[split:]
            link(Tree(left), Tree(right), left, right, split, links, percent)
        return _edges(group.column("node").to_numpy(), links)

    return joined


EDGES = "a long, b long"


def _with_roots(parts: DataFrame, edges: DataFrame) -> DataFrame:
    """The parts with the root that each set has by now."""
    roots = components(edges).select(F.col("node").alias("of"), "root")
    return parts.join(roots, F.col("node") == F.col("of"), "left").drop("of").withColumn("root", F.coalesce("root", "node"))


def _with_first(parts: DataFrame, percent: int) -> DataFrame:
    """Links between the first part of each family and its other parts."""
    columns = ["family", "node", "root", "n", "hashes"]
    number, first = F.lit(1).cast("long"), F.col("part") == 0
    left = parts.filter(first).select(*columns, F.lit(0).alias("side"), "part", F.explode(F.sequence(number, F.col("parts") - 1)).alias("j"))
    right = parts.filter(~first).select(*columns, F.lit(1).alias("side"), (number - 1).alias("part"), F.col("part").alias("j"))
    return left.unionByName(right).withColumnRenamed("part", "i").groupBy("family", "i", "j").applyInArrow(_between(percent), EDGES)


def _still_open(parts: DataFrame, percent: int, part_shingles: int) -> DataFrame:
    """Links between sets that are not connected yet.

    Two of them that link share a prefix shingle, so a shingle whose sets are all connected is done with. The
    sets of the others are dealt out anew, those with one root together unless they need parts of their own,
    and a set meets another part only where that has a shingle of its prefix in a set of another root. What is
    moved so follows the sets that are left over, not the square of the family.
    """
    own = parts.select(F.col("node").alias("of"), F.explode("prefix").alias("shingle"))
    roots = parts.select("node", "root")
    each = persist_state(own.join(roots, F.col("node") == F.col("of")).select("node", "root", "shingle"), "prefixes")
    ends = each.groupBy(F.col("shingle").alias("of")).agg(F.min("root").alias("low"), F.max("root").alias("high"))
    each = each.join(ends.filter("low != high").select("of"), F.col("shingle") == F.col("of"), "left_semi")
    nodes = each.select(F.col("node").alias("of")).distinct()
    rest = parts.select("node", "family", "root", "n").join(nodes, F.col("node") == F.col("of"), "left_semi")
    rest = persist_state(rest, "rest")
    sizes = rest.groupBy("family", "root").agg(F.sum(F.col("n") + BITMAP_SHINGLES).alias("total"))
    sizes = sizes.withColumn("own", F.ceil(F.col("total") / part_shingles))
    light = sizes.groupBy("family").agg(F.sum(F.when(F.col("own") <= 1, F.col("total"))).alias("light"))
    light = light.select(F.col("family").alias("of_family"), F.ceil(F.col("light") / part_shingles).alias("bundles"))
    sizes = sizes.join(light, F.col("family") == F.col("of_family")).select(F.col("root").alias("of"), "own", "bundles")
    alone = F.xxhash64("root", F.pmod(F.xxhash64("node"), "own"))
    place = F.when(F.col("own") > 1, alone).otherwise(F.xxhash64("family", F.pmod(F.xxhash64("root"), "bundles"), F.lit("light")))
    places = rest.join(sizes, F.col("root") == F.col("of")).select(F.col("node").alias("of"), place.alias("place"))
    each = persist_state(each.join(places, F.col("node") == F.col("of")).select("node", "root", "place", "shingle"), "open")
    there = each.groupBy(F.col("shingle").alias("of"), F.col("place").alias("other")).agg(F.min("root").alias("low"), F.max("root").alias("high"))
    met = each.join(there, F.col("shingle") == F.col("of")).filter("low != root or high != root")
    met = met.select(F.col("node").alias("of"), "place", "other").distinct()
    pair = [F.least("place", "other").alias("i"), F.greatest("place", "other").alias("j"), (F.col("place") > F.col("other")).cast("int").alias("side")]
    met = persist_state(met.select("of", *pair), "met")
    moved = parts.join(met, F.col("node") == F.col("of")).select("node", "root", "n", "hashes", "i", "j", "side")
    return moved.groupBy("i", "j").applyInArrow(_between(percent), EDGES)


def link_members(held: DataFrame, percent: int = PERCENT, part_shingles: int = PART_SHINGLES) -> DataFrame:
    """Edges (a, b) that connect exactly the sets that links connect, from the members of families.

    Small families share a task up to `part_shingles`. A larger family has as many parts as it takes:
    its trees are joined with themselves, with part 0, and then where sets are left unconnected, so near
    copies, however many, cost a multiple of their number and not its square.
    """
    totals = held.groupBy("family").agg(F.sum(F.col("n") + BITMAP_SHINGLES).alias("total"))
    totals = persist_state(totals.withColumn("parts", F.ceil(F.col("total") / part_shingles)), "families")
    small, most = totals.filter("parts <= 1").agg(F.sum("total")).first()[0] or 0, totals.agg(F.max("parts")).first()[0] or 0
    bundles = -(-small // part_shingles) or 1
    sized = totals.select(F.col("family").alias("of_family"), "parts")
    rows = held.join(sized, F.col("family") == F.col("of_family")).drop("of_family")
    part = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("node"), F.col("parts")))
    rows = rows.withColumn("part", part.otherwise(F.pmod(F.xxhash64("family"), F.lit(bundles))))
    owner = F.when(F.col("parts") > 1, F.col("family"))
    columns = ["family", "node", "n", "hashes"]
    grouped = rows.select(*columns, owner.alias("owner"), "part").groupBy("owner", "part")
    edges = persist_state(grouped.applyInArrow(_within(percent), EDGES), "links")
    if most <= 1:
        return edges
    large = rows.filter("parts > 1").select(*columns, "prefix", "parts", "part")
    edges = persist_state(edges.union(_with_first(_with_roots(large, edges), percent)), "links")
    return persist_state(edges.union(_still_open(_with_roots(large, edges), percent, part_shingles)), "links")


def groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, part_shingles: int = PART_SHINGLES
) -> DataFrame:
    """Rows (key, text_hash, n_shingles, component_id, representative), one per document.

    Two documents link when 100 * overlap >= percent * union of their sets of 5-word shingles (lower case
    A-Z; fewer words are one shingle). `component_id` is the smallest key that links reach, itself
    included. The representative of a group is its row of the smallest key (null keys last), then the
    smallest hash of the text; repeated rows are all marked. A text without words links with nothing and
    represents itself. A group of null keys alone has a null component. An empty table gives no rows.
    """
    rows = docs.select(named(key).alias("key"), F.xxhash64(named(text)).alias("text_hash"), named(text).alias("text"))
    kind = rows.schema["key"].dataType
    schema = (
        f"block long, keys array<{kind.simpleString()}>, text_hashes array<long>, nodes array<long>, sizes array<long>,"
        " hashes binary"
    )
    spark, path = docs.sparkSession, new_path(docs.sparkSession, "sets")
    with shuffles_freed(spark):
        blocks = _stored(rows.mapInArrow(_blocks_of_texts(to_arrow_type(kind)), schema), path)
        each = F.inline(F.arrays_zip("keys", "text_hashes", "nodes", "sizes"))
        placed = persist_state(blocks.select(each).toDF("key", "text_hash", "node", "n_shingles"), "keys")
        found = candidates(blocks, percent, path)
        family = families(found).select(F.col("node").alias("of"), F.col("root").alias("family"))
        held = found.join(family, F.col("node") == F.col("of")).select("node", "family", "n", "hashes", "prefix")
        links = link_members(persist_state(held, "members"), percent, part_shingles)
        roots = components(links).select(F.col("node").alias("of"), "root")
    placed = placed.join(roots, F.col("node") == F.col("of"), "left").drop("of")
    placed = placed.withColumn("root", F.coalesce("root", "node"))
    place = F.struct(F.col("key").isNull().alias("missing"), "key", "text_hash")
    firsts = placed.filter("root is not null").groupBy("root").agg(F.min(place).alias("first"))
    # Written, so that the join below may split the rows of a very large group.
    with shuffles_freed(spark):
        firsts = persist_state(firsts.select(F.col("root").alias("of"), "first"), "groups")
    found = placed.join(firsts, F.col("root") == F.col("of"), "left")
    alone = F.col("root").isNull()
    return found.select(
        "key",
        "text_hash",
        "n_shingles",
        F.when(alone, F.col("key")).otherwise(F.col("first.key")).alias("component_id"),
        (alone | place.eqNullSafe(F.col("first"))).alias("representative"),
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The representative document of each group, with all its columns.

    Rows with equal key and text are one document; texts without words all stay.
    """
    found = groups(docs, key, text, percent).filter("representative").select(F.col("key").alias("k"), F.col("text_hash").alias("h"))
    whole = F.struct(*[named(c) for c in docs.columns]).alias("row")
    rows = docs.select(whole, named(key).alias("key"), F.xxhash64(named(text)).alias("text_hash"))
    kept = rows.join(found.distinct(), F.col("key").eqNullSafe(F.col("k")) & (F.col("text_hash") == F.col("h")), "left_semi")
    return kept.dropDuplicates(["key", "text_hash"]).select("row.*")
