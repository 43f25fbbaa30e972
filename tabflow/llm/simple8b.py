"""Simple-8b word-aligned coding of token ids, vectorised, and files of documents in this coding.

A stream is cut into runs of RUN values. Each run is coded alone: a 64-bit word holds a 4-bit selector
and as many values as fit its width; values of 60 bits and more go to an exception list, and an escape
word holds their place in it. The header gives the first word of every run, so a range of values is
decoded without what lies before it, and each selector is decoded for all its words at once.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabflow.llm.common import chunks, named, text_chunks
from tabflow.llm.vocab import broadcast_spec, vocabulary

# The published selectors as (values per word, bits per value). Selector 0 is the escape.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([60, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.uint64)
ESCAPE, WIDEST = 0, 15
NARROWEST = np.array([1 + int(np.searchsorted(WIDTHS[1:], b)) for b in range(61)], np.uint8)  # by bit length
RUN = 16_384
MAGIC = b"S8B1"
HEADER = struct.Struct("<4sIIII")  # magic, values, words, exceptions, runs
DATA_BITS = np.uint64(60)
DATA = np.uint64((1 << 60) - 1)


def _narrowest(values: np.ndarray) -> np.ndarray:
    """The narrowest selector that holds each value; 16 for those that need the escape."""
    if values.max(initial=0) < 1 << 53:  # exact as doubles, whose exponents are the bit lengths
        return NARROWEST[np.frexp(values.astype(np.float64))[1]]
    limits = np.uint64(1) << WIDTHS[1:]
    return (np.searchsorted(limits, values, side="right") + 1).astype(np.uint8)


def _encode_run(values: np.ndarray, exceptions: list[int]) -> np.ndarray:
    n = len(values)
    need = _narrowest(values)
    escaped = need > WIDEST
    padded = np.concatenate([need, np.ones(int(COUNTS.max()), np.uint8)])
    # A word that can hold the next c values in one width can hold fewer in a larger one, so the number
    # of selectors that fit tells the best. `widest` is the need among the next values, as many as `have`.
    choice, widest, have = np.full(n, WIDEST, np.uint8), padded, 1
    for selector in range(WIDEST - 1, 0, -1):
        count = int(COUNTS[selector])
        while have < count:
            step = min(have, count - have)
            widest = np.maximum(widest[:-step], widest[step:])
            have += step
        fits = widest[:n] <= selector
        if not fits.any():
            break
        choice -= fits
    choice[escaped] = ESCAPE
    # The first value of every word: those of the first 2^k words, moved on by 2^k words, are the next 2^k.
    first, ahead = np.zeros(min(n, 1), np.int64), np.minimum(np.arange(n) + COUNTS[choice], n)
    ahead = np.append(ahead, n)
    while len(more := ahead[first]) and more[0] < n:
        first = np.concatenate([first, more[more < n]])
        ahead = ahead[ahead]
    selectors = choice[first]
    words = selectors.astype(np.uint64) << DATA_BITS
    padded_values = np.concatenate([values, np.zeros(int(COUNTS.max()), np.uint64)])
    for selector in np.unique(selectors):
        place = np.flatnonzero(selectors == selector)
        if selector == ESCAPE:
            words[place] |= np.arange(len(exceptions), len(exceptions) + len(place), dtype=np.uint64)
            exceptions += values[first[place]].tolist()
        elif WIDTHS[selector]:
            lanes = np.arange(COUNTS[selector])
            held = padded_values[first[place][:, None] + lanes] << (lanes.astype(np.uint64) * WIDTHS[selector])
            words[place] |= np.bitwise_or.reduce(held, axis=1)
    return words


def _decode_run(words: np.ndarray, n: int, exceptions: np.ndarray) -> np.ndarray:
    selectors = (words >> DATA_BITS).astype(np.int64)
    counts = COUNTS[selectors]
    first = np.cumsum(counts) - counts
    out = np.zeros(n + int(COUNTS.max()), np.uint64)
    for selector in np.unique(selectors):
        place = np.flatnonzero(selectors == selector)
        held = words[place] & DATA
        if selector == ESCAPE:
            out[first[place]] = exceptions[held.astype(np.int64)]
        elif width := int(WIDTHS[selector]):
            lanes = np.arange(COUNTS[selector])
            shifted = held[:, None] >> (lanes.astype(np.uint64) * np.uint64(width))
            out[first[place][:, None] + lanes] = shifted & np.uint64((1 << width) - 1)
    return out[:n]


def encode(values: np.ndarray) -> bytes:
    """Any unsigned 64-bit values as one self-describing block; an empty array gives a header alone."""
    values, exceptions, coded = values.astype(np.uint64), [], []
    for at in range(0, len(values), RUN):
        coded.append(_encode_run(values[at : at + RUN], exceptions))
    offsets = np.cumsum([0, *map(len, coded)])[:-1].astype("<u4")
    words = np.concatenate(coded) if coded else np.zeros(0, np.uint64)
    header = HEADER.pack(MAGIC, len(values), len(words), len(exceptions), len(coded))
    return header + offsets.tobytes() + words.astype("<u8").tobytes() + np.array(exceptions, "<u8").tobytes()


def decode(block: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Values start to stop of a block; only the runs that they lie in are decoded."""
    magic, n, n_words, n_exceptions, runs = HEADER.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("not a Simple-8b block")
    stop = n if stop is None else min(stop, n)
    at = HEADER.size
    offsets = np.frombuffer(block, "<u4", runs, at).tolist() + [n_words]
    words = np.frombuffer(block, "<u8", n_words, at + 4 * runs)
    exceptions = np.frombuffer(block, "<u8", n_exceptions, at + 4 * runs + 8 * n_words)
    if start >= stop:
        return np.zeros(0, np.uint64)
    first, last = start // RUN, (stop - 1) // RUN
    parts = [
        _decode_run(words[offsets[r] : offsets[r + 1]], min(RUN, n - r * RUN), exceptions)
        for r in range(first, last + 1)
    ]
    return np.concatenate(parts)[start - first * RUN : stop - first * RUN]


FILE_SCHEMA = "part long, block long, before long, doc_ids array<long>, lengths array<long>, payload binary"
READ_SCHEMA = "doc_id long, start long, n_tokens long, ids binary"


class _Block:
    """Documents on their way into one block of a part; `before` counts the part's ids ahead of it."""

    def __init__(self, part: int, block: int = 0, before: int = 0) -> None:
        self.place = (part, block, before)
        self.keys: list[int | None] = []
        self.ids: list[bytes] = []
        self.held = 0

    def add(self, key: int | None, ids: bytes) -> None:
        self.keys.append(key)
        self.ids.append(ids)
        self.held += len(ids) // 4

    def next(self) -> "_Block":
        part, block, before = self.place
        return _Block(part, block + 1, before + self.held)

    def row(self) -> pa.RecordBatch:
        lengths = [len(x) // 4 for x in self.ids]
        payload = encode(np.frombuffer(b"".join(self.ids), "<u4"))
        long, longs = pa.int64(), pa.list_(pa.int64())
        types = (long, long, long, longs, longs, pa.binary())
        cells = (*self.place, self.keys, lengths, payload)
        names = ["part", "block", "before", "doc_ids", "lengths", "payload"]
        return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, types)], names)


def write_ids(
    docs: DataFrame, spec_path: str, path: str, end_id: int = 0, key: str = "doc_id", text: str = "text",
    block_ids: int = 65_536,
) -> None:
    """Encode whole texts and write their ids, each document closed by `end_id`, in ascending key order.

    Rows are dealt to parts by ranges of the key (null keys first; equal keys by the text's digest, so
    no key, null or not, has to fit one task) and each task writes one part as rows of Simple-8b blocks
    of whole documents. A null text is empty and has its end id alone; an empty table gives an empty file.
    """
    spec = broadcast_spec(docs.sparkSession, spec_path)
    rows = docs.select(named(key).cast("long").alias("key"), named(text).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    order = [F.col("key").asc_nulls_first(), F.col("tie")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")
    ordered.mapInArrow(_writer(spec, end_id, block_ids), FILE_SCHEMA).write.mode("overwrite").parquet(path)


def _writer(spec: Broadcast, end_id: int, block_ids: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, block = vocabulary(spec), _Block(TaskContext.get().partitionId())
        end = np.array([end_id], "<u4").tobytes()
        for batch in (c for b in batches for c in text_chunks(b)):
            coded = known.encode_spaced([t or "" for t in batch.column(1).to_pylist()])
            for key, ids in zip(batch.column(0).to_pylist(), coded):
                block.add(key, ids + end)
                if block.held >= block_ids:
                    yield block.row()
                    block = block.next()
        if block.keys:
            yield block.row()

    return write


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in chunks(batch, 1):
            first, keys, lengths, payload = (row.column(i)[0].as_py() for i in range(4))
            raw = decode(payload).astype("<u4").tobytes()
            starts = np.cumsum([0, *lengths])
            ids = [raw[4 * a : 4 * b] for a, b in zip(starts, starts[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array(starts[:-1] + first, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                ["doc_id", "start", "n_tokens", "ids"],
            )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids) of the files: ids as little-endian 32-bit integers.

    `start` counts the ids of all documents before it: the block's place in its part is in the file,
    and the parts' totals, one row per part, are added up here.
    """
    files = spark.read.parquet(path)
    in_block = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    totals = files.select("part", in_block.alias("total")).groupBy("part").agg(F.sum("total").alias("total"))
    before = F.sum("total").over(Window.orderBy("part")) - F.col("total")
    parts = totals.select(F.col("part").alias("of_part"), before.alias("part_start"))
    placed = files.join(parts, F.col("part") == F.col("of_part"))
    first = (F.col("part_start") + F.col("before")).alias("first")
    return placed.select(first, "doc_ids", "lengths", "payload").mapInArrow(_read, READ_SCHEMA)
