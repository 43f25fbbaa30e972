"""Toxic passages by maximum-scoring segments of token log-odds, calibrated by extreme values.

Tokens of labelled texts give log-odds with a Dirichlet prior; a linear scan finds every maximal segment
of a text; the number of equally good segments expected by chance in a clean text of that length
(Karlin and Altschul) says which segments are significant and adds them up to one score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.llm import jaccard
from tabflow.llm.common import chunks, fold, named, raw_texts
from tabflow.sources.shared import new_path, persist_state, workspace

# Fixed value: ASCII punctuation separates tokens here.
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
TO_BLANK = bytes.maketrans(PUNCTUATION, b" " * len(PUNCTUATION))
STEMS = (5, 4)  # lengths in bytes of the word beginnings that count as features, longest first

MAX_LABELLED = 100_000  # labelled texts that the model is fitted on
MAX_FEATURES = 50_000  # features of a model; the most significant stay
MIN_Z = 3.2  # standard errors by which the log-odds of a feature exceed zero
PRIOR_SHARE = 0.1  # weight of the Dirichlet prior, as a share of all counts
MAX_WEIGHT = 8.0
SCALE = 4  # evidence is counted in steps of 1 / SCALE to fit the final curve
RANGE = 60.0


def tokens(raw: bytes) -> list[bytes]:
    return raw.lower().translate(TO_BLANK).split()


def features(token: bytes) -> list[bytes]:
    """The token and its beginnings, the most specific first."""
    return [token, *[token[:n] + b"*" for n in STEMS if len(token) >= n]]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per feature the toxic and clean texts that hold it; the empty feature counts tokens."""
    names = ["feature", "toxic", "clean"]
    counted: tuple[Counter, Counter] = (Counter(), Counter())

    def rows() -> pa.RecordBatch:
        held = list(counted[0].keys() | counted[1].keys())
        columns = [pa.array([c[x] for x in held], pa.int64()) for c in (counted[1], counted[0])]
        for c in counted:
            c.clear()
        return pa.RecordBatch.from_arrays([pa.array(held, pa.binary()), *columns], names)

    for batch in (c for b in batches for c in chunks(b)):
        for raw, label in zip(raw_texts(batch.column(0)), batch.column(1).to_pylist()):
            words = tokens(raw)
            distinct = set(words)
            held = counted[label]
            held.update(distinct)
            for n in STEMS:
                held.update({w[:n] + b"*" for w in distinct if len(w) >= n})
            held[b""] += len(words)
        if len(counted[0]) + len(counted[1]) > 200_000:
            yield rows()
    yield rows()


@dataclass(frozen=True)
class Segments:
    """Scores of features, of any other token, and the extreme-value law of a clean text's best segment."""

    weights: dict[bytes, float]
    other: float
    decay: float  # lambda: a clean text's best score exceeds s with odds falling as exp(-decay * s)
    log_rate: float  # log of K: segments expected per token at score 0
    slope: float = 1.0
    offset: float = 0.0

    def scores(self, words: list[bytes], heads: set[bytes]) -> tuple[list[int], list[float]]:
        """Places and scores of the tokens that score above `other`."""
        places, found = [], []
        for i in [i for i, w in enumerate(words) if w[:4] in heads]:
            for feature in features(words[i]):
                if (weight := self.weights.get(feature)) is not None:
                    places.append(i)
                    found.append(weight)
                    break
        return places, found

    def heads(self) -> set[bytes]:
        return {f[:4] if len(f) > 4 or not f.endswith(b"*") else f[:-1] for f in self.weights}

    def evidence(self, segments: list[tuple[int, int, float]], n: int) -> tuple[float, list[float]]:
        """Minus log of the segments as good expected by chance: per segment, and summed over a text."""
        chance = self.log_rate + math.log(max(n, 1))
        each = [self.decay * s - chance for _, _, s in segments]
        good = [e for e in each if e > 0]
        return (sum(good) if good else max([-chance, *each])), each

    def probability(self, evidence: float) -> float:
        x = self.slope * min(max(evidence, -RANGE), RANGE) + self.offset
        return 1 / (1 + math.exp(-min(max(x, -30.0), 30.0)))


def maximal_segments(places: list[int], scores: list[float], other: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, token after the last, score), in linear time.

    `places` hold the tokens with a positive score; every other token scores `other` < 0. A segment is
    maximal if none that contains it scores as much and none inside it scores more (Ruzzo and Tompa).
    Candidates keep the running totals before and after them, and the nearest earlier candidate that
    starts lower; hops along these passes over each candidate a bounded number of times.
    """
    first, after, low, high, lower = [], [], [], [], []  # of the candidates
    total, end = 0.0, 0
    for place, score in zip(places, scores):
        start, before = place, total + other * (place - end)
        total, end = before + score, place + 1
        while True:
            j = len(low) - 1
            while j >= 0 and low[j] >= before:
                j = lower[j]
            if j < 0 or high[j] >= total:
                break
            start, before = first[j], low[j]
            for column in (first, after, low, high, lower):
                del column[j:]
        for column, value in zip((first, after, low, high, lower), (start, end, before, total, j)):
            column.append(value)
    return [(a, b, h - x) for a, b, h, x in zip(first, after, high, low)]


def labelled_sample(labels: DataFrame, label: str, key: str = "doc_id", bound: int = MAX_LABELLED) -> DataFrame:
    """At most `bound` rows (key, label) outside fold 0, one per key, by the order of the key's hash.

    Rows with a null key or label are left out; where a key has two labels, 1 wins.
    """
    rows = labels.select(named(key).alias("key"), named(label).cast("int").alias("label"))
    rows = rows.filter((fold(F.col("key")) != 0) & F.col("label").isNotNull() & F.col("key").isNotNull())
    rows = rows.groupBy("key").agg(F.max("label").alias("label"))
    return rows.orderBy(F.xxhash64("key"), "key").limit(bound)


def with_label(docs: DataFrame, sample: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (key, text, label) of the sampled keys; the sample is broadcast, its size is bounded."""
    rows = docs.select(named(key).alias("key"), named(text).alias("text"))
    return rows.join(F.broadcast(sample), "key").select("key", "text", "label")


def spaced(text: Column) -> Column:
    """The text with blanks for punctuation, so that its words are its `tokens` but for their case."""
    return F.translate(text, PUNCTUATION.decode(), " " * len(PUNCTUATION))


def without_copies(labelled: DataFrame, sample: DataFrame) -> DataFrame:
    """The sample with `text_hash` of the texts that count: one of each group of near copies of a label.

    Texts of the same label link at a Jaccard of 0.75 between their sets of 5-word shingles, by the exact
    join of operator 5; what they share with texts of the other label is never looked at. Of a group that
    links connect the text of the smallest key stays. Texts without words are copies of each other.
    """
    spark, held = labelled.sparkSession, []
    for label in (0, 1):
        path = new_path(spark, "alone")
        with workspace(spark):  # what the join writes is not needed after it
            rows = persist_state(jaccard.groups(labelled.filter(F.col("label") == label), "key", "text"), "groups")
            alone = rows.filter("representative and n_shingles > 0").select("key", "text_hash")
            first = rows.filter("n_shingles = 0").agg(F.min(F.struct("key", "text_hash")).alias("row"))
            alone = alone.union(first.filter("row is not null").select("row.*"))
            held.append(persist_state(alone.distinct(), path=path))
    return sample.join(held[0].union(held[1]), "key")


def log_odds(counts: DataFrame, min_z: float, bound: int) -> tuple[list[tuple[bytes, float, float, float]], float]:
    """Rows (feature, log-odds, toxic rate, clean rate) of the significant features; the prior's weight.

    Monroe, Colaresi and Quinn: the prior of a feature is proportional to its count in both classes.
    """
    summed = persist_state(
        counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "counts"
    )
    total = summed.filter(F.col("feature") == F.lit(b"")).first()
    n_toxic, n_clean = (total["toxic"], total["clean"]) if total else (0, 0)
    prior = PRIOR_SHARE * (n_toxic + n_clean)
    if not n_toxic or not n_clean:
        return [], n_clean
    own = (F.col("toxic") + F.col("clean")) * PRIOR_SHARE
    toxic, clean = F.col("toxic") + own, F.col("clean") + own
    odds = F.log(toxic / (n_toxic + prior - toxic)) - F.log(clean / (n_clean + prior - clean))
    rated = summed.filter(F.col("feature") != F.lit(b"")).select(
        "feature", odds.alias("odds"), (odds / F.sqrt(1 / toxic + 1 / clean)).alias("z"),
        (toxic / (n_toxic + prior)).alias("toxic_rate"), (clean / (n_clean + prior)).alias("clean_rate"),
    )
    best = rated.filter(F.col("z") >= min_z).orderBy(F.col("z").desc(), "feature").limit(bound).collect()
    return [(bytes(r["feature"]), r["odds"], r["toxic_rate"], r["clean_rate"]) for r in best], n_clean


def decay_rate(rates: np.ndarray, scores: np.ndarray, rest: float, other: float) -> float:
    """The positive root of: expected exp(decay * score) of a clean token = 1."""

    def excess(x: float) -> float:
        return float(rates @ np.exp(x * scores) + rest * math.exp(x * other) - 1)

    high = 0.01
    while excess(high) < 0 and high < 64:
        high *= 2
    low = high / 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high


def _scanner(model: Segments):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads = model.heads()
        for batch in (c for b in batches for c in chunks(b)):
            lengths, found = [], []
            for raw in raw_texts(batch.column(0)):
                words = tokens(raw)
                places, scores = model.scores(words, heads)
                lengths.append(len(words))
                found.append([s for _, _, s in maximal_segments(places, scores, model.other)])
            columns = [batch.column(1), pa.array(lengths, pa.int64()), pa.array(found, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["label", "n", "scores"])

    return scan


def _calibrated(model: Segments, labelled: DataFrame) -> Segments:
    """The model with K from the clean texts' best segments, and the curve from evidence to probability.

    K is the maximum-likelihood rate given which clean texts have a segment of the least possible score.
    """
    scans = labelled.select("text", "label").mapInArrow(_scanner(model), "label int, n long, scores array<double>")
    scans = persist_state(scans, "scans")
    hits, n = scans.filter("label = 0").agg(F.sum((F.size("scores") > 0).cast("long")), F.sum("n")).first()
    least = min(model.weights.values(), default=0.0)
    log_rate = math.log(((hits or 0) + 0.5) / (((n or 0) + 1.0) * math.exp(-model.decay * least)))
    chance = F.lit(log_rate) + F.log(F.greatest("n", F.lit(1)))
    each = F.transform("scores", lambda s: s * model.decay - chance)
    good = F.aggregate(F.filter(each, lambda e: e > 0), F.lit(0.0), lambda a, e: a + e)
    evidence = F.when(good > 0, good).otherwise(F.greatest(-chance, F.array_max(each)))
    step = F.round(F.greatest(F.lit(-RANGE), F.least(F.lit(RANGE), evidence)) * SCALE).cast("int")
    bins = scans.groupBy(step.alias("step"), "label").count().collect()
    slope, offset = fit_curve([(r["step"] / SCALE, r["label"], r["count"]) for r in bins])
    return Segments(model.weights, model.other, model.decay, log_rate, slope, offset)


def fit_curve(points: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Slope and offset of the logistic curve through counted (x, label) points, by Newton steps."""
    if len({label for _, label, _ in points}) < 2:
        return 1.0, 0.0
    x, y, w = (np.array(c, float) for c in zip(*points))
    design, beta, ridge = np.stack([x, np.ones_like(x)], 1), np.zeros(2), np.diag([1e-2, 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (w * (y - p)) - ridge @ beta
        hessian = design.T @ (design * (w * p * (1 - p))[:, None]) + ridge
        step = np.linalg.solve(hessian, gradient)
        beta = beta + step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return max(float(beta[0]), 1e-6), float(beta[1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    key: str = "doc_id",
    text: str = "text",
    max_labelled: int = MAX_LABELLED,
    max_features: int = MAX_FEATURES,
    min_z: float = MIN_Z,
) -> Segments:
    """The segment model of the labelled texts outside fold 0.

    At most `max_labelled` labelled rows are used and at most `max_features` features kept; these bounds
    make the sample and the model small enough to broadcast. Near copies of a label count once, and so do
    repeated rows. Without both classes, or on empty tables, the model has no features and every text is
    clean.
    """
    sample = persist_state(labelled_sample(labels, label, key, max_labelled), "labelled")
    rows = with_label(docs, sample, key, text).withColumn("text", spaced(F.col("text")))
    rows = persist_state(rows.dropDuplicates(["key", "text"]), "texts")
    alone = persist_state(without_copies(rows, sample), "labelled").select("key", "text_hash")
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    labelled = rows.join(F.broadcast(alone), ["key", "text_hash"]).select("key", "text", "label")
    counts = labelled.select("text", "label").mapInArrow(_counts, "feature binary, toxic long, clean long")
    rated, _ = log_odds(counts, min_z, max_features)
    weights = {f: min(odds, MAX_WEIGHT) for f, odds, _, _ in rated}
    scores = np.array([weights[f] for f, *_ in rated])
    toxic, clean = (np.array([r[i] for r in rated]) for i in (2, 3))
    rest = max(1 - float(clean.sum()), 0.01)
    drift = math.log(max(1 - float(toxic.sum()), 0.01) / rest)
    other = min(-0.01, drift, -2 * float(clean @ scores) / rest)
    decay = decay_rate(clean, scores, rest, other) if rated else 1.0
    return _calibrated(Segments(weights, other, decay, 0.0), labelled)


PASSAGE = "struct<first_word:long,end_word:long,score:double,expected:double,passage:string>"
RESULT = f"struct<score:double,evidence:double,n_tokens:long,passages:array<{PASSAGE}>>"
NAMES, FIELDS = ["score", "evidence", "n_tokens", "passages"], ["first_word", "end_word", "score", "expected", "passage"]
_SPAN = pa.struct(list(zip(FIELDS, [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string()])))
JUDGED = pa.struct(list(zip(NAMES, [pa.float64(), pa.float64(), pa.int64(), pa.list_(_SPAN)])))


def judge(model: Segments, raw: bytes, heads: set[bytes]) -> tuple[float, float, int, list[tuple]]:
    words = tokens(raw)
    places, scores = model.scores(words, heads)
    segments = maximal_segments(places, scores, model.other)
    evidence, each = model.evidence(segments, len(words))
    passages = [
        (a, b, s, math.exp(-e), b" ".join(words[a:b]).decode(errors="replace"))
        for (a, b, s), e in zip(segments, each)
        if e > 0
    ]
    return model.probability(evidence), evidence, len(words), passages


def toxicity(model: Segments, docs: DataFrame) -> Column:
    """A function of a text column: score, evidence, tokens, and every significant toxic passage.

    A passage has its first word, the word after its last, its score and the number of passages as good
    expected in a clean text of that length. A null text counts as empty; an empty text has the evidence
    of no segment in one token and so a score of its own.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(RESULT)
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held, heads = shared.value, shared.value.heads()
        for texts in batches:
            parts = [pa.array([], JUDGED)]
            for part in chunks(texts):
                rows = [judge(held, raw, heads) for raw in raw_texts(part)]
                found = [(*row, [dict(zip(FIELDS, p)) for p in passages]) for *row, passages in rows]
                parts.append(pa.array([dict(zip(NAMES, row)) for row in found], JUDGED))
            yield pa.concat_arrays(parts)

    return judged


def clean_documents(docs: DataFrame, labels: DataFrame, limit: float = 0.5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, with all their columns, whose toxicity score is below the limit."""
    judged = toxicity(fit(docs, labels, key=key, text=text), docs)
    return docs.filter(judged(named(text))["score"] < limit)
