"""Quality rules: per-document counts, and the frequency of lines across the documents of a host.

Normalised lines are hashed, the distinct documents of each host that hold a line are counted, lines
above the host's limit are removed, and documents that this depletes are rejected.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import chunks, named, raw_texts
from tabflow.sources.shared import persist_state

# Characters that count as symbols, and the white space between words.
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\v\f\r"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
LINES = "array<struct<hash:long,words:long>>"


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that are found at least twice in the text, the first one included."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
    _, window, times = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    found = times[window] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(found)] |= found
    return int(covered.sum())


def line_key(line: bytes) -> int:
    """64-bit hash of a line in lower case (A-Z) with single blanks."""
    normal = b" ".join(line.lower().split())
    return int.from_bytes(hashlib.blake2b(normal, digest_size=8).digest(), "little", signed=True)


def measured(raw: bytes) -> tuple[list[int], list[dict[str, int]]]:
    """The counts of one text, and its distinct normalised lines with the words on them."""
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip(SPACE)]
    code_points = len(raw.decode()) - sum(map(raw.count, (SPACE[i : i + 1] for i in range(len(SPACE)))))
    symbols = sum(map(raw.count, (SYMBOLS[i : i + 1] for i in range(len(SYMBOLS)))))
    held: Counter[int] = Counter()
    for line in lines:
        held[line_key(line)] += len(line.split())
    counts = [len(words), code_points, symbols, len(lines) - len(set(lines)), repeated_words(words)]
    return counts, [{"hash": h, "words": n} for h, n in held.items()]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    line = pa.list_(pa.struct([("hash", pa.int64()), ("words", pa.int64())]))
    for batch in (c for b in batches for c in chunks(b)):
        texts = raw_texts(batch.column(2))
        rows = [measured(t) for t in texts]
        counts = [pa.array([r[0][i] for r in rows], pa.int64()) for i in range(len(COUNTS))]
        digests = pa.array([hashlib.md5(t).digest() for t in texts], pa.binary())
        columns = [batch.column(0), batch.column(1), digests, *counts, pa.array([r[1] for r in rows], line)]
        yield pa.RecordBatch.from_arrays(columns, ["key", "host", "text_md5", *COUNTS, "lines"])


def measure(docs: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """Rows (key, host, text_md5, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines)."""
    rows = docs.select(named(key).alias("key"), named(host).alias("host"), named(text).alias("text"))
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:2]]
    counts = [f"{c} long" for c in COUNTS]
    return rows.mapInArrow(_measure, ", ".join([*kinds, "text_md5 binary", *counts, f"lines {LINES}"]))


def frequent_lines(measures: DataFrame, texts: DataFrame, max_documents: int, max_share: float) -> DataFrame:
    """Rows (host, hash) of lines in more distinct documents of the host than its limit.

    The limit is `max_documents`, or `max_share` of the host's distinct documents where that is more.
    """
    per_host = measures.select("host", "text_md5").distinct().groupBy("host").agg(F.count("*").alias("of_host"))
    per_line = texts.groupBy("host", "hash").agg(F.count("*").alias("documents"))
    often = per_line.filter(F.col("documents") > max_documents)
    hosts = per_host.select(F.col("host").alias("h"), "of_host")
    above = often.join(hosts, F.col("host").eqNullSafe(F.col("h")))
    return above.filter(F.col("documents") > F.col("of_host") * max_share).select("host", "hash")


def judge(
    measures: DataFrame,
    base_failed: Column,
    max_documents: int = 50,
    max_share: float = 0.002,
    min_left: float = 0.3,
) -> DataFrame:
    """Adds n_removed_words, base_failed and kept to the rows of `measure`, without their lines.

    Copies of one text are one document: a text is not boilerplate for being copied. A document is
    depleted if the lines left hold less than `min_left` of its words. The verdict depends on host and
    text alone, so lines are counted once per distinct text (summed on the map side, so that neither a
    line nor a group of copies with a third of the rows is one task) and equal rows get equal verdicts.
    Null hosts are one host; a null or empty text has no words; an empty table gives no rows.
    """
    measures = persist_state(measures, "measures")
    exploded = measures.select("host", "text_md5", F.explode("lines").alias("line"))
    texts = exploded.groupBy("host", F.col("line.hash").alias("hash"), "text_md5").agg(F.max("line.words").alias("words"))
    texts = persist_state(texts, "lines")
    frequent = persist_state(frequent_lines(measures, texts, max_documents, max_share), "frequent")
    frequent = frequent.select(F.col("host").alias("h"), F.col("hash").alias("of_hash"))
    matches = F.col("host").eqNullSafe(F.col("h")) & (F.col("hash") == F.col("of_hash"))
    removed = texts.join(frequent, matches, "left_semi").groupBy("host", "text_md5").agg(F.sum("words").alias("gone"))
    removed = removed.select(F.col("host").alias("of_host"), F.col("text_md5").alias("of_text"), "gone")
    same = F.col("host").eqNullSafe(F.col("of_host")) & (F.col("text_md5") == F.col("of_text"))
    rows = measures.drop("lines").join(removed, same, "left").drop("of_host", "of_text")
    left = F.col("n_words") - F.col("n_removed_words")
    rows = rows.withColumn("n_removed_words", F.coalesce("gone", F.lit(0))).drop("gone")
    rows = rows.withColumn("base_failed", base_failed)
    return rows.withColumn("kept", ~F.col("base_failed") & (left >= F.col("n_words") * min_left))
