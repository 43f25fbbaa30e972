"""Quality classifier by importance resampling: hashed n-gram models of target and raw text.

The log ratio of the two generative models is a text's importance weight; documents are sampled without
replacement by the Gumbel top-k of their weights.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import chunks, draw, named, raw_texts
from tabflow.llm.toxicity import MAX_LABELLED, labelled_sample
from tabflow.sources.shared import persist_state

BUCKETS = 1 << 16  # n-gram buckets of a model; its size is this, whatever the corpus
SMOOTHING = 8.0  # target n-grams added to each bucket of both models, so that rare ones say little
KEPT_WORDS = 150_000  # words whose codes a task keeps; beyond that it starts anew
DIGIT = 1 << 16
MIX = np.uint64(0x9E3779B97F4A7C15)
LOW = np.uint64((1 << 32) - 1)
# Upper case, lower case with everything beyond ASCII, and digits as one letter each; marks stay.
KINDS = bytes(65 if 65 <= i <= 90 else 97 if 97 <= i <= 122 or i >= 128 else 48 if 48 <= i <= 57 else i for i in range(256))
RUN = re.compile(rb"(.)\1+", re.DOTALL)



def shape(word: bytes) -> bytes:
    """Case, digits and marks of a word, runs of one kind as one."""
    return RUN.sub(rb"\1", word.translate(KINDS))


class Codes:
    """Hashes of words and of their shapes; those met before are kept, and go with the task."""

    def __init__(self) -> None:
        self.words: dict[bytes, int] = {}
        self.shapes: dict[bytes, int] = {}

    def _code(self, word: bytes) -> int:
        kinds = word.translate(KINDS)
        if kinds not in self.shapes:
            self.shapes[kinds] = zlib.crc32(shape(word))
        return zlib.crc32(word) << 32 | self.shapes[kinds]

    def of(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of a text's words, and of their shapes."""
        words = raw.split()
        for kept in (self.words, self.shapes):
            if len(kept) > KEPT_WORDS:
                kept.clear()
        for word in set(words).difference(self.words):
            self.words[word] = self._code(word)
        held = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        return held >> np.uint64(32), held & LOW


def _bucket(kind: int, codes: np.ndarray) -> np.ndarray:
    return ((codes + np.uint64(kind)) * MIX >> np.uint64(48)).astype(np.int64) % BUCKETS


def ngrams(raw: bytes, codes: Codes) -> np.ndarray:
    """Buckets of a text's words, of its pairs of word shapes, and of how each word follows the last.

    The third kind tells whether a word equals the one before and whether a pair of words was met
    earlier in the text, so that repetition is part of the language that the models describe.
    """
    words, shapes = codes.of(raw)
    if not len(words):
        return np.zeros(0, np.int64)
    pairs = shapes[:-1] * np.uint64(1 << 32) + shapes[1:]
    following = words[:-1] * np.uint64(1 << 32) + words[1:]
    _, first = np.unique(following, return_index=True)
    seen = np.ones(len(following), bool)
    seen[first] = False
    repeat = seen.astype(np.uint64) * np.uint64(2) + (words[:-1] == words[1:]).astype(np.uint64)
    runs = repeat[:-1] * np.uint64(4) + repeat[1:]
    return np.concatenate([_bucket(1, words), _bucket(2, pairs), _bucket(3, runs)])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket the n-grams of all texts and of the target texts of this task."""
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    none, codes = np.zeros(0, np.int64), Codes()
    for batch in (c for b in batches for c in chunks(b, 64)):
        found = [ngrams(t, codes) for t in raw_texts(batch.column(0))]
        chosen = [f for f, label in zip(found, batch.column(1).to_pylist()) if label == 1]
        raw += np.bincount(np.concatenate([none, *found]), minlength=BUCKETS)
        target += np.bincount(np.concatenate([none, *chosen]), minlength=BUCKETS)
    held = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays(
        [pa.array(held), pa.array(raw[held]), pa.array(target[held])], ["bucket", "raw", "target"]
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    key: str = "doc_id",
    text: str = "text",
    max_labelled: int = MAX_LABELLED,
) -> np.ndarray:
    """The log ratio of each bucket: target model over raw model, both with as many n-grams and smoothed alike.

    The raw model counts every document, the target model at most `max_labelled` labelled documents
    outside fold 0 with label 1; that bound lets the labels be broadcast, so no text is shuffled. Counts
    are added up per bucket by Spark; the driver receives one row per bucket. Without targets every
    ratio is 0.
    """
    sample = persist_state(labelled_sample(labels, label, key, max_labelled), "labelled")
    rows = docs.select(named(key).alias("key"), named(text).alias("text"))
    rows = rows.join(F.broadcast(sample), "key", "left").select("text", "label")
    counts = rows.mapInArrow(_counted, "bucket long, raw long, target long")
    summed = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in summed:
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    if not target.sum():
        return np.zeros(BUCKETS)
    expected = raw * (target.sum() / raw.sum())
    return np.log(target + SMOOTHING) - np.log(expected + SMOOTHING)


def log_weight(ratios: np.ndarray, docs: DataFrame) -> Column:
    """A function of a text column: the log importance weight, 0 for a null or empty text."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    @F.arrow_udf("double")
    def weigh(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held, codes = shared.value, Codes()
        for texts in batches:
            found = [float(held[ngrams(raw, codes)].sum()) for part in chunks(texts) for raw in raw_texts(part)]
            yield pa.array(found, pa.float64())

    return weigh


def _ordered(value: Column) -> Column:
    """A long with the order of a finite double rounded to 2**-20, for selection digit by digit."""
    return F.round(F.least(F.greatest(value, F.lit(-1e9)), F.lit(1e9)) * (1 << 20)).cast("long") + (1 << 52)


def kth_largest(rows: DataFrame, column: str, k: int) -> int | None:
    """The k-th largest of a column of longs in [0, 2**63): the digits of 16 bits from the top, one count
    per digit and round, so nothing is sorted and the driver holds one row per digit. None if k is 0."""
    if k <= 0:
        return None
    prefix, left = 0, k
    for bits in (48, 32, 16, 0):
        digit = F.shiftright(column, bits).bitwiseAND(DIGIT - 1)
        inside = rows if bits == 48 else rows.filter(F.shiftright(column, bits + 16) == F.lit(prefix))
        counts = sorted(((r["digit"], r["count"]) for r in inside.groupBy(digit.alias("digit")).count().collect()), reverse=True)
        for value, n in counts:
            if n >= left:
                prefix = (prefix << 16) | value
                break
            left -= n
        else:
            return 0  # k exceeds the rows: all are taken
    return prefix


def _rank(weight: Column, uniform_bits: Column) -> Column:
    """The Gumbel-perturbed log weight as a long; the noise is the row's hash draw, so reruns agree."""
    uniform = (uniform_bits + 0.5) / float(1 << 60)
    return _ordered(weight - F.log(-F.log(uniform)))


def _belongs(weight: Column, prior: float) -> Column:
    """The share of a document that the target explains: min(1, prior * weight)."""
    return F.exp(F.least(weight + float(np.log(max(prior, 1e-12))), F.lit(0.0)))


def cutoff(weighted: DataFrame, prior: float) -> int:
    """The least rank of a Gumbel top-k sample of rows (draw, log_weight), where k is the expected number
    of target documents. Rows of equal rank are taken or left together."""
    rows = weighted.select(_belongs(F.col("log_weight"), prior).alias("share"), _rank(F.col("log_weight"), F.col("draw")).alias("rank"))
    rows = persist_state(rows, "ranks")
    k = int(round(rows.agg(F.sum(F.col("share").cast("decimal(30,9)"))).first()[0] or 0))
    least = kth_largest(rows, "rank", k)
    return (1 << 62) if least is None else least


def target_share(labels: DataFrame, label: str = "quality", key: str = "doc_id", bound: int = MAX_LABELLED) -> float:
    """The share of label 1 among the labelled sample; 1 without labels, so that nothing is rejected."""
    share = labelled_sample(labels, label, key, bound).agg(F.avg("label")).first()[0]
    return 1.0 if share is None else float(share)


def sample_documents(
    docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", seed: int = 17
) -> DataFrame:
    """Rows (key, draw, log_weight, score, kept), one per document: a Gumbel top-k sample by importance.

    `score` is the share of the document that the target explains. A null or empty text has weight 1
    and is judged by the prior alone; null keys have draws by their text; equal rows are kept or left
    together; an empty table gives no rows.
    """
    weigh, prior = log_weight(fit(docs, labels, label, key, text), docs), target_share(labels, label, key)
    rows = docs.select(
        named(key).alias("key"), draw(seed, named(key), named(text)).alias("draw"), weigh(named(text)).alias("log_weight")
    )
    rows = persist_state(rows, "weights")
    kept = _rank(F.col("log_weight"), F.col("draw")) >= cutoff(rows, prior)
    return rows.select("*", _belongs(F.col("log_weight"), prior).alias("score"), kept.alias("kept"))


def sampled_documents(
    docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", seed: int = 17
) -> DataFrame:
    """The documents that `sample_documents` keeps, with all their columns and without a join."""
    weigh, prior = log_weight(fit(docs, labels, label, key, text), docs), target_share(labels, label, key)
    bits = draw(seed, named(key), named(text))
    least = cutoff(docs.select(bits.alias("draw"), weigh(named(text)).alias("log_weight")), prior)
    return docs.filter(_rank(weigh(named(text)), bits) >= least)
