"""Ranked lexical search by hashed max-sketches.

A document's sketch has a byte per coordinate: each of its terms is hashed to HASHES coordinates, and a
coordinate holds the largest term frequency among the terms that fall on it. A term's impact grows with
its frequency when the document is given, so these are the coordinatewise maxima of the impacts under any
collection statistics. The smallest of a query term's coordinates bounds its impact from above, and the
weighted sum over the query's terms bounds the score. Documents are scored exactly in descending order of
their bounds until the bounds fall below the k-th best score.

The index is written once and serves any queries. Its rows are dealt by hash digits into three levels of
about 1/1024, 1/32 and the rest. They are searched one after the other, all rows of each: what the small
levels find is the threshold with which the next one starts, so a task of the large one returns few rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabflow.llm.common import chunks, picked, raw_texts
from tabflow.sources.shared import new_path, persist_state

# A term is a run of characters other than ASCII ones that are no letters or digits; only
# A-Z is lowered. In UTF-8 the other bytes are above 127, so a table of bytes says it.
TERMS = bytes(c | 32 if 65 <= c <= 90 else c if chr(c).isalnum() or c > 127 else 32 for c in range(256))
# Odd multipliers of the hashes of a term's crc32.
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
HASHES = len(MULTIPLIERS)
WIDTH_PER_TERM, LEAST_WIDTH = 8, 64  # coordinates, rounded up to a power of two
CLIPPED = 255  # this and larger frequencies: the document's largest one holds
LEVELS = (2, 1, 0)
CELLS = 1 << 21  # of the dense matrices of a task
STEP = 32  # documents scored between two looks at the threshold

INDEX = "doc_id long, n long, top long, width int, sketch binary, terms binary, counts binary"
FOUND = "item int, doc_id long, score long"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERMS).split()


def coordinates(crcs: np.ndarray, which: int, widths: np.ndarray | int) -> np.ndarray:
    """A coordinate of each term in a sketch of a power of two of coordinates."""
    mixed = (crcs.astype(np.uint64) + np.uint64(1)) * MULTIPLIERS[which]
    return (mixed >> np.uint64(32)).astype(np.int64) & (np.int64(widths) - 1 if np.isscalar(widths) else widths - 1)


def sketch(terms: list[dict[bytes, int]]) -> tuple[np.ndarray, list[bytes]]:
    """Width and sketch of each document, given its frequencies by term."""
    sizes = np.array([len(t) for t in terms], np.int64)
    least = np.maximum(sizes * WIDTH_PER_TERM, LEAST_WIDTH)
    widths = np.where(sizes > 0, 1 << np.ceil(np.log2(least)).astype(np.int64), 0)
    ends = np.cumsum(widths)
    crcs = np.array([crc32(t) for doc in terms for t in doc], np.uint32)
    counts = np.array([min(c, CLIPPED) for doc in terms for c in doc.values()], np.uint8)
    folded = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    base, width = np.repeat(ends - widths, sizes), np.repeat(widths, sizes)
    for which in range(HASHES):
        np.maximum.at(folded, base + coordinates(crcs, which, width), counts)
    raw = folded.tobytes()
    return widths, [raw[e - w : e] for e, w in zip(ends.tolist(), widths.tolist())]


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (c for b in batches for c in chunks(b)):
        counted = [Counter(terms_of(t)) for t in raw_texts(batch.column(1))]
        held = [i for i, c in enumerate(counted) if c]
        docs = [counted[i] for i in held]
        widths, sketches = sketch(docs)
        long = pa.int64()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(held, long)),
                pa.array([c.total() for c in docs], long),
                pa.array([max(c.values()) for c in docs], long),
                pa.array(widths, pa.int32()),
                pa.array(sketches, pa.binary()),
                pa.array([b" ".join(c) for c in docs], pa.binary()),
                pa.array([np.array([*c.values()], "<u4").tobytes() for c in docs], pa.binary()),
            ],
            ["doc_id", "n", "top", "width", "sketch", "terms", "counts"],
        )


def write_index(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Sketches and frequencies of whole texts, one row per document with a term, without a shuffle.

    Repeated rows and keys stay documents of their own. A null, empty or termless text is in no index.
    """
    rows = picked(docs, key=key, text=text).select(F.col("key").cast("long"), "text")
    digits = F.pmod(F.xxhash64("doc_id", "terms"), F.lit(1024))
    level = F.when(digits == 0, 2).when(digits % 32 == 0, 1).otherwise(0)
    indexed = rows.mapInArrow(_index, INDEX).withColumn("level", level)
    indexed.write.mode("overwrite").option("compression", "zstd").partitionBy("level").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{INDEX}, level int").parquet(path)


def impacts(tf: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * norms)


class Asked:
    """A block of items as arrays: their terms by number, and per item its terms and weights."""

    def __init__(self, texts: list[bytes]) -> None:
        sets = [set(terms_of(t)) for t in texts]
        self.terms = sorted(set().union(*sets))
        self.number = {t: i for i, t in enumerate(self.terms)}
        self.of_item = [np.array(sorted(self.number[t] for t in s), np.int64) for s in sets]
        self.crcs = np.array([crc32(t) for t in self.terms], np.uint32)

    def weigh(self, documents: int, total: int, df: dict[int, int]) -> None:
        self.documents, self.total = documents, total
        ratio = [(2 * documents + 2) / (2 * df.get(i, 0) + 1) for i in range(len(self.terms))]
        self.weights = np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)

    @property
    def rows(self) -> int:
        """Documents whose dense matrices have CELLS cells."""
        return max(8, min(512, CELLS // max(1, len(self.terms))))


class Chunk:
    """Some documents of the index against a block of items."""

    def __init__(self, asked: Asked, batch: pa.RecordBatch) -> None:
        self.asked, self.n = asked, batch.num_rows
        keys, n, top, width = (batch.column(i) for i in range(4))
        self.keys = keys.to_pylist()
        self.top = top.to_numpy()
        self.norms = 50 + (50 * n.to_numpy() * asked.documents) // asked.total
        self.width = width.to_numpy()
        self.sketches, self.terms, self.counts = (batch.column(i) for i in (4, 5, 6))
        self.exact = np.zeros((len(asked.terms), self.n), np.int64)
        self.parsed = np.zeros(self.n, bool)

    def upper(self) -> np.ndarray:
        """Upper bounds of the impacts, terms x documents."""
        out = np.zeros((len(self.asked.terms), self.n))
        for width in np.unique(self.width):
            docs = np.flatnonzero(self.width == width)
            held = np.stack([np.frombuffer(self.sketches[i].as_buffer(), np.uint8) for i in docs.tolist()])
            least = held[:, coordinates(self.asked.crcs, 0, int(width))]
            for which in range(1, HASHES):
                np.minimum(least, held[:, coordinates(self.asked.crcs, which, int(width))], out=least)
            at, term = np.nonzero(least)
            tf, doc = least[at, term].astype(np.int64), docs[at]
            tf = np.where(tf == CLIPPED, self.top[doc], tf)
            out[term, doc] = impacts(tf, self.norms[doc])
        return out

    def parse(self, docs: np.ndarray) -> None:
        """Exact impacts of documents not looked at before."""
        number = self.asked.number
        for doc in docs[~self.parsed[docs]].tolist():
            known = [number.get(t, -1) for t in self.terms[doc].as_py().split()]
            ids = np.array(known, np.int64)
            place = np.flatnonzero(ids >= 0)
            tf = np.frombuffer(self.counts[doc].as_buffer(), "<u4")[place].astype(np.int64)
            self.exact[ids[place], doc] = impacts(tf, self.norms[doc])
        self.parsed[docs] = True

    def scores(self, item: int, docs: np.ndarray) -> np.ndarray:
        self.parse(docs)
        terms = self.asked.of_item[item]
        return self.asked.weights[terms] @ self.exact[np.ix_(terms, docs)]


class Best:
    """The k best (score, document) of an item so far; equal scores by ascending key, a null key first."""

    def __init__(self, k: int, threshold: int) -> None:
        self.k, self.threshold = k, threshold
        self.held: list[tuple[int, int, int | None]] = []

    def add(self, scores: np.ndarray, keys: list[int | None]) -> None:
        low = -(1 << 63)
        self.held += [(-s, low if d is None else d, d) for s, d in zip(scores.tolist(), keys) if s >= self.threshold]
        if len(self.held) >= self.k:
            self.held = sorted(self.held, key=lambda x: x[:2])[: self.k]
            self.threshold = max(self.threshold, -self.held[-1][0])


def _walk(chunk: Chunk, best: list[Best]) -> None:
    upper = chunk.upper()
    for item, (terms, kept) in enumerate(zip(chunk.asked.of_item, best)):
        if not len(terms):
            continue
        # Sums of whole numbers are exact below 2^53; the factor covers longer items.
        bounds = (chunk.asked.weights[terms] @ upper[terms]) * (1 + 1e-9)
        docs = np.flatnonzero(bounds >= kept.threshold)
        docs = docs[np.argsort(-bounds[docs], kind="stable")]
        for at in range(0, len(docs), STEP):
            part = docs[at : at + STEP]
            part = part[bounds[part] >= kept.threshold]
            if not len(part):
                break
            kept.add(chunk.scores(item, part), [chunk.keys[d] for d in part.tolist()])


def _searcher(asked: Asked, k: int, thresholds: list[int]):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k, t) for t in thresholds]
        for batch in (c for b in batches for c in chunks(b, asked.rows)):
            _walk(Chunk(asked, batch), best)
        rows = [(i, d, -s) for i, kept in enumerate(best) for s, _, d in kept.held]
        items, keys, scores = zip(*rows) if rows else ((), (), ())
        types = (pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip((items, keys, scores), types)], ["item", "doc_id", "score"]
        )

    return search


def _counter(number: dict[bytes, int]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[int] = Counter()
        for batch in (c for b in batches for c in chunks(b)):
            for terms in batch.column(0).to_pylist():
                found.update([number[t] for t in terms.split() if t in number])
        yield pa.RecordBatch.from_arrays([pa.array([*found], pa.int32()), pa.array([*found.values()], pa.int64())], ["term", "df"])

    return count


def _search_block(spark: SparkSession, path: str, texts: list[bytes], documents: int, total: int, k: int) -> DataFrame:
    """Rows (item, doc_id, score) that hold the k best of every item of a block."""
    asked = Asked(texts)
    held = read_index(spark, path)
    df = held.select("terms").mapInArrow(_counter(asked.number), "term int, df long").groupBy("term").agg(F.sum("df"))
    asked.weigh(documents, total, {r[0]: r[1] for r in df.collect()})  # a row per term of the block
    thresholds, found = [1] * len(texts), None
    columns = [c.split()[0] for c in INDEX.split(", ")]
    for level in LEVELS:
        rows = held.filter(F.col("level") == level).select(*columns)
        seen = persist_state(rows.mapInArrow(_searcher(asked, k, thresholds), FOUND), "found")
        found = seen if found is None else found.unionByName(seen)
        if level:
            order = Window.partitionBy("item").orderBy(F.col("score").desc())
            last = found.withColumn("at", F.row_number().over(order)).filter(F.col("at") == k)
            for row in last.select("item", "score").collect():  # a row per item of the block
                thresholds[row.item] = max(thresholds[row.item], row.score)
    return found


def search(
    spark: SparkSession, path: str, items: DataFrame, k: int = 50, key: str = "item_id", text: str = "text",
    block_terms: int = 16_384,
) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): each item's k best documents of the index with a score above 0.

    Items are taken in blocks of about `block_terms` terms, against all documents each. An id in several
    rows is answered once, by its least text; a null id is an id. Items without terms and empty tables
    give no rows. Equal scores come by ascending document, null first; repeated documents are ranked each.
    """
    asked = picked(items, item_id=key, text=text).groupBy("item_id").agg(F.min("text").alias("text"))
    asked = persist_state(asked.withColumn("chars", F.coalesce(F.length("text"), F.lit(0))), "items")
    documents, total = read_index(spark, path).agg(F.count("*"), F.sum("n")).first()
    blocks = math.ceil((asked.agg(F.sum("chars")).first()[0] or 0) / (4 * block_terms)) if documents else 0
    number = F.pmod(F.xxhash64("item_id"), F.lit(max(1, blocks)))
    kind = asked.schema["item_id"].dataType.simpleString()
    ranked = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    for block in range(blocks):
        rows = asked.filter(number == block).select("item_id", "text").collect()  # of bounded size
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], f"item int, item_id {kind}")
        found = _search_block(spark, path, [(r.text or "").encode() for r in rows], documents, total, k)
        best = found.join(F.broadcast(names), "item").withColumn("rank", F.row_number().over(order))
        best = best.filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
        ranked = ranked.unionByName(best)
    return ranked


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """Index and search in one: columns doc_id and text of `docs`, item_id and text of `items`."""
    spark = docs.sparkSession
    path = new_path(spark, "sketches")
    write_index(docs, path)
    return search(spark, path, items, k)
