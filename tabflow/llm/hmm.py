"""Hidden Markov language model: Baum-Welch over partitions, exact likelihoods by scaled forward recursion.

A latent state emits a word class, and the class emits the word by its count in the training texts:
P(word | state) = P(class | state) * P(word | class). Classes are a function of the spelling, so the
states have tables of a fixed size, while the word counts cover the whole vocabulary of the corpus. The
texts are read once into blocks of word numbers; a block joins with the counts by its distinct words.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tabflow.llm.common import chunks, lower_words, named, raw_texts
from tabflow.sources.shared import new_path, persist_state

STATES = 8
CLASSES = 4096
SUFFIX = 3  # bytes of a word's end that decide its class
BLOCK_BYTES = 4 << 20  # text of a block; a longer text is a block of its own
SIDE_BY_SIDE = 2048  # training sequences that are gone through together
WINDOW = 512  # tokens of a training sequence: longer texts are learnt in consecutive windows
SEGMENT = 1024  # tokens after which a long text is scored in parallel segments
CENTRES = 512  # distinct training windows, the first by hash of all texts, that the start states are chosen from
CENTRE_TOKENS = 32  # windows of fewer tokens are centres only where there are too few others
SETTLED = 1e-5  # rounds end when what they raise, the log likelihood with the prior, grows by a smaller share
END = b"\n"  # the end token's place in vocabularies; no word holds white space
SMOOTHING = 0.5
FLOOR = 1e-18  # least probability in a training round
LEANING = 50.0  # counts added to each state's emissions, in the shares of the classes


def word_class(word: bytes) -> int:
    return 0 if word == END else 1 + zlib.crc32(word[-SUFFIX:]) % (CLASSES - 1)


@dataclass(frozen=True)
class Model:
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # classes x states: P(class | state)


class _Block:
    """Texts as numbers of the block's distinct words."""

    NAMES = ["block", "keys", "held", "lengths", "ids", "classes", "vocabulary", "learnt"]

    def __init__(self, number: int) -> None:
        self.number, self.bytes = number, 0
        self.keys: list = []
        self.held: list[bool] = []
        self.coded: list[np.ndarray] = []
        self.numbers: dict[bytes, int] = {END: 0}

    def add(self, key, held: bool, raw: bytes) -> None:
        numbers, words = self.numbers, lower_words(raw)
        for word in words:
            if word not in numbers:
                numbers[word] = len(numbers)
        self.coded.append(np.array([*[numbers[w] for w in words], 0], np.uint32))
        self.keys.append(key)
        self.held.append(held)
        self.bytes += len(raw)

    def row(self, kind: pa.DataType) -> pa.RecordBatch:
        vocabulary = list(self.numbers)
        learnt = np.zeros(len(vocabulary), np.int64)
        for held, ids in zip(self.held, self.coded):
            if not held:
                learnt += np.bincount(ids, minlength=len(vocabulary))
        classes = np.fromiter(map(word_class, vocabulary), np.uint16, len(vocabulary))
        pack = zstandard.ZstdCompressor(level=1).compress
        ids = pack(np.concatenate(self.coded).astype("<u4").tobytes())
        cells = [
            self.number, self.keys, self.held, list(map(len, self.coded)), ids, pack(classes.tobytes()), vocabulary, learnt
        ]
        types = [pa.int64(), pa.list_(kind), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
        types += [pa.list_(pa.binary()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, types)], self.NAMES)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = _Block(TaskContext.get().partitionId() << 32)
    kind = pa.int64()
    for batch in (c for b in batches for c in chunks(b)):
        kind = batch.schema.field(0).type
        for key, held, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), raw_texts(batch.column(2))):
            block.add(key, held, raw)
            if block.bytes >= BLOCK_BYTES:
                yield block.row(kind)
                block = _Block(block.number + 1)
    if block.keys:
        yield block.row(kind)


def read_blocks(docs: DataFrame, held: Column, key: str, text: str) -> DataFrame:
    """The texts as written blocks of word numbers; `learnt` counts the words of texts not held out."""
    rows = docs.select(named(key).alias("key"), held.alias("held"), named(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    schema = (
        f"block long, keys array<{kind}>, held array<boolean>, lengths array<long>, ids binary, classes binary,"
        " vocabulary array<binary>, learnt array<long>"
    )
    spark, path = docs.sparkSession, new_path(docs.sparkSession, "blocks")
    # The vocabularies of the blocks are most of what this operator keeps on disk.
    rows.mapInArrow(_blocks, schema).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def word_counts(blocks: DataFrame) -> DataFrame:
    """Rows (word, class, n) of all words of training texts, summed on the map side first."""
    each = blocks.select(F.explode(F.arrays_zip("vocabulary", "learnt")).alias("w"))
    words = each.filter(F.col("w.learnt") > 0).groupBy(F.col("w.vocabulary").alias("word")).agg(F.sum("w.learnt").alias("n"))
    suffix = F.substring("word", -SUFFIX, SUFFIX)
    ending = F.when(F.octet_length("word") <= SUFFIX, F.col("word")).otherwise(suffix)
    kind = F.when(F.col("word") == F.lit(END), 0).otherwise(1 + F.crc32(ending) % (CLASSES - 1))
    return persist_state(words.select("word", kind.alias("class"), "n"), "words")


def _sequences(row: pa.RecordBatch | pa.Table, at: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers, their classes, and lengths and held-out marks of a block's texts."""
    unpack = zstandard.ZstdDecompressor().decompress
    ids = np.frombuffer(unpack(row.column("ids")[at].as_py()), "<u4")
    classes = np.frombuffer(unpack(row.column("classes")[at].as_py()), np.uint16)
    lengths = np.array(row.column("lengths")[at].as_py(), np.int64)
    return ids, classes[ids], lengths, np.array(row.column("held")[at].as_py(), bool)


def training_windows(lengths: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First token and length of the windows that cover every training text, the longest first."""
    first, length = np.cumsum(lengths) - lengths, lengths
    first, length = first[~held], length[~held]
    pieces = -(-length // WINDOW)
    step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = np.repeat(first, pieces) + step * WINDOW
    sizes = np.minimum(np.repeat(length, pieces) - step * WINDOW, WINDOW)
    order = np.argsort(-sizes, kind="stable")
    return starts[order], sizes[order]


def _active(sizes: np.ndarray) -> np.ndarray:
    """How many sequences, longest first, have a token at each place."""
    return np.cumsum(np.bincount(sizes)[::-1])[::-1][1:] if len(sizes) else np.zeros(0, np.int64)


def _recursed(model: Model, classes: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, float]:
    """The counts of `expected_counts` and the natural log likelihood of the sequences, in the model's precision.

    Arrays are states x sequences, so every step runs along the sequences.
    """
    states = len(model.start)
    starts, moves = np.zeros(states), np.zeros((states, states))
    emits = np.zeros((states, CLASSES))
    onward = np.ascontiguousarray(model.move.T)
    classes = classes.astype(np.intp)  # converted once, not by every step
    active = _active(sizes).tolist()
    alphas, seen, scaled, log = [], [], [], 0.0
    for t, n in enumerate(active):
        seen.append(classes[first[:n] + t])
        alpha = onward @ alphas[-1][:, :n] if t else np.repeat(model.start[:, None], n, axis=1)
        emitted = np.ascontiguousarray(model.emit.take(seen[t], axis=0).T)
        alpha *= emitted
        scale = alpha.sum(0)
        alpha /= scale
        emitted /= scale
        alphas.append(alpha)
        scaled.append(emitted)
        log += float(np.log(scale).sum())
    beta = np.zeros((states, 0), onward.dtype)
    for t in range(len(active) - 1, -1, -1):
        n, later = active[t], beta.shape[1]
        below = np.ones((states, n), onward.dtype)
        if later:
            ahead = np.multiply(beta, scaled[t + 1], out=scaled[t + 1])
            moves += alphas[t][:, :later] @ ahead.T
            below[:, :later] = model.move @ ahead
        beta = below
        # Alphas become posteriors once the moves from them are counted.
        alphas[t] *= beta
    if active:
        starts += alphas[0].sum(1)
        weights, held = np.concatenate(alphas, axis=1), np.concatenate(seen)
        for k in range(states):
            emits[k] = np.bincount(held, weights=weights[k], minlength=CLASSES)
    return np.concatenate([starts, (moves * model.move).ravel(), emits.ravel()]), log


def expected_counts(model: Model, classes: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Baum-Welch counts of all sequences side by side: starts, moves and emissions in one flat array."""
    return _recursed(model, classes, first, sizes)[0]


def block_counts(model: Model, classes: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The counts of all sequences, some of them at a time, and behind them the log likelihood.

    The recursions run in single precision, the sums over steps and sequences in double. Probabilities
    below FLOOR count as FLOOR, so that weights and their inverses stay within single precision.
    """
    total = np.zeros(len(model.start) * (1 + len(model.start) + CLASSES) + 1)
    model = Model(*(np.maximum(p, FLOOR).astype(np.float32) for p in (model.start, model.move, model.emit)))
    for at in range(0, len(first), SIDE_BY_SIDE):
        part = slice(at, at + SIDE_BY_SIDE)
        found, log = _recursed(model, classes, first[part], sizes[part])
        total[:-1] += found
        total[-1] += log
    return total


def maximised(counts: np.ndarray, classes: np.ndarray, states: int) -> Model:
    """The next model; `classes` is the distribution of classes, towards which rare emissions lean."""
    starts, rest = counts[:states], counts[states:]
    moves, emits = rest[: states * states].reshape(states, states), rest[states * states :].reshape(states, -1)
    move = (moves + 1.0) / (moves.sum(1, keepdims=True) + states)
    emit = (emits + LEANING * classes) / (emits.sum(1, keepdims=True) + LEANING)
    return Model((starts + 1.0) / (starts.sum() + states), move, np.ascontiguousarray(emit.T))


def log_prior(model: Model, classes: np.ndarray) -> float:
    """What the counts that `maximised` adds are worth: with it the likelihood never falls in a round."""
    emits = LEANING * float((classes @ np.log(model.emit)).sum())
    return emits + float(np.log(model.move).sum() + np.log(model.start).sum())


def _first_model(tokens: np.ndarray, first: np.ndarray, sizes: np.ndarray, classes: np.ndarray, states: int) -> Model:
    """States around sequences that differ most in their classes, each added farthest from those before.

    Emissions are varied by a seeded tenth, so states around equal sequences, or around none, still differ.
    """
    long = np.flatnonzero(sizes >= min(CENTRE_TOKENS, sizes.max(initial=0)))[:CENTRES]
    emit = np.tile(classes, (states, 1))
    if len(long):
        shares = np.stack([np.bincount(tokens[first[i] : first[i] + sizes[i]], minlength=CLASSES) / sizes[i] for i in long])
        roots = np.sqrt(shares)
        chosen, near = [0], roots @ roots[0]
        while len(chosen) < states:
            chosen.append(int(near.argmin()))
            near = np.maximum(near, roots @ roots[chosen[-1]])
        emit = 0.5 * classes + 0.5 * shares[chosen]
    emit = emit * np.random.default_rng(1).uniform(0.9, 1.1, emit.shape)
    emit /= emit.sum(1, keepdims=True)
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), move, np.ascontiguousarray(emit.T))


def _centres(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's distinct training windows the first by hash: rows (short, hash, classes)."""
    found: dict[bytes, tuple[bool, int]] = {}

    def firsts() -> list[tuple[bool, int, bytes]]:
        return sorted((short, order, window) for window, (short, order) in found.items())[:CENTRES]

    for row in (c for b in batches for c in chunks(b, 1)):
        _, classes, lengths, held = _sequences(row)
        for a, n in zip(*(x.tolist() for x in training_windows(lengths, held))):
            window = classes[a : a + n].astype("<u2").tobytes()
            if window not in found:
                found[window] = (n < CENTRE_TOKENS, xxhash.xxh3_64_intdigest(window) >> 1)
        found = {window: (short, order) for short, order, window in firsts()}
    columns = zip(*firsts()) if found else ([], [], [])
    types = [pa.bool_(), pa.int64(), pa.binary()]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["short", "hash", "classes"])


def start_model(sequences: DataFrame, classes: np.ndarray, states: int) -> Model:
    """The model that training starts from, around some of the first distinct windows of all blocks."""
    each = sequences.mapInArrow(_centres, "short boolean, hash long, classes binary").distinct()
    held = [np.frombuffer(r["classes"], "<u2") for r in each.orderBy("short", "hash", "classes").limit(CENTRES).collect()]
    sizes = np.array([len(w) for w in held], np.int64)
    tokens = np.concatenate([np.zeros(0, np.uint16), *held]).astype(np.int64)
    return _first_model(tokens, np.cumsum(sizes) - sizes, sizes, classes, states)


def _counter(shared):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, total = shared.value, None
        for row in (c for b in batches for c in chunks(b, 1)):
            _, classes, lengths, held = _sequences(row)
            found = block_counts(model, classes, *training_windows(lengths, held))
            total = found if total is None else total + found
        if total is not None:
            held = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["place", "n"])

    return count


def fit(blocks: DataFrame, classes: np.ndarray, states: int = STATES, settled: float = SETTLED) -> Model:
    """Baum-Welch rounds over every training text, until the likelihood settles.

    Each task adds up the counts of its blocks and Spark sums them per parameter, so the driver receives
    as many numbers as the model has, whatever the corpus.
    """
    spark = blocks.sparkSession
    sequences = blocks.select("block", "held", "lengths", "ids", "classes")
    size = states + states * states + states * CLASSES
    model, last = start_model(sequences, classes, states), -math.inf
    while True:
        shared = spark.sparkContext.broadcast(model)
        counted = sequences.mapInArrow(_counter(shared), "place long, n double")
        total = np.zeros(size + 1)
        # Rounded sums do not depend on the order in which tasks finish.
        places = counted.groupBy("place").agg(F.sum(F.col("n").cast("decimal(30,6)")).cast("double").alias("n"))
        for row in places.collect():
            total[row["place"]] = row["n"]
        shared.destroy()
        log = total[size] + log_prior(model, classes)
        model = maximised(total[:size], classes, states)
        if not log - last > settled * abs(log):
            return model
        last = log


def _forward(model: Model, classes: np.ndarray, first: np.ndarray, sizes: np.ndarray, alpha: np.ndarray | None):
    """Scaled forward recursion of sequences side by side: the last state weights and log likelihoods.

    `alpha` are the state weights before each sequence; without them the sequences start texts.
    """
    order = np.argsort(-sizes, kind="stable")
    first, n_states = first[order], len(model.start)
    fresh = alpha is None
    alpha = np.tile(model.start, (len(order), 1)) if fresh else alpha[order]
    log = np.zeros(len(order))
    for t, n in enumerate(_active(sizes).tolist()):
        weights = alpha[:n] if fresh and t == 0 else alpha[:n] @ model.move
        weights = weights * model.emit[classes[first[:n] + t]]
        scale = weights.sum(1)
        alpha[:n] = weights / scale[:, None]
        log[:n] += np.log(scale)
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return alpha[back].reshape(-1, n_states), log[back]


def log_likelihoods(model: Model, classes: np.ndarray, lengths: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
    """Natural log likelihood of each class sequence, exact for any length.

    The first `segment` tokens of all texts run side by side. Further segments of long texts run side by
    side as well, from every state at once: that gives a segment's matrix, and a text's matrices are then
    applied to its state weights in order.
    """
    states, first = len(model.start), np.cumsum(lengths) - lengths
    alpha, log = _forward(model, classes, first, np.minimum(lengths, segment), None)
    extra = np.maximum(-(-lengths // segment) - 1, 0)
    text = np.repeat(np.arange(len(lengths)), extra)
    if not len(text):
        return log
    step = 1 + np.arange(len(text)) - np.repeat(np.cumsum(extra) - extra, extra)
    starts, sizes = first[text] + step * segment, np.minimum(lengths[text] - step * segment, segment)
    basis = np.tile(np.eye(states), (len(text), 1))
    matrix, scales = _forward(model, classes, np.repeat(starts, states), np.repeat(sizes, states), basis)
    matrix, scales = matrix.reshape(-1, states, states), scales.reshape(-1, states)
    for i, d in enumerate(text):
        largest = scales[i].max()
        weights = (alpha[d] * np.exp(scales[i] - largest)) @ matrix[i]
        total = weights.sum()
        alpha[d] = weights / total
        log[d] += largest + math.log(total)
    return log


def _scorer(shared, kind: pa.DataType):
    def score(block: pa.Table, found: pa.Table) -> pa.Table:
        model, per_class, log_total = shared.value
        parts = []
        for at in range(block.num_rows):
            ids, classes, lengths, _ = _sequences(block, at)
            counts = np.zeros(int(ids.max(initial=0)) + 1)
            places = found.column("place").to_numpy()
            counts[places] = found.column("n").to_numpy()
            first = np.cumsum(lengths) - lengths
            logs = np.log10(counts + SMOOTHING)[ids]
            base = np.add.reduceat(logs, first) - lengths * log_total
            in_class = np.add.reduceat(logs - per_class[classes], first)
            hidden = log_likelihoods(model, classes, lengths) / math.log(10)
            known = np.add.reduceat((counts > 0)[ids].astype(np.int64), first)
            columns = [
                pa.array(block.column("keys")[at].as_py(), kind), pa.array(block.column("held")[at].as_py(), pa.bool_()),
                lengths, known, base, in_class + hidden,
            ]
            parts.append(pa.table(columns, ["key", "held_out", "n_tokens", "n_known", "base_score", "score"]))
        return pa.concat_tables(parts) if parts else _none(kind)

    return score


def _none(kind: pa.DataType) -> pa.Table:
    fields = [("key", kind), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64())]
    return pa.schema([*fields, ("base_score", pa.float64()), ("score", pa.float64())]).empty_table()


def score_documents(docs: DataFrame, held: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, held_out, n_tokens, n_known, train_tokens, base_score, score), one per document.

    Learns from the texts that are not held out and scores all. Tokens are words in lower case (A-Z) and
    one end token per text; a null text is empty and has its end alone. `base_score` is the unigram
    model of the training counts smoothed by a half, `score` the log10 probability under the hidden
    Markov model; both sum to one over all texts, with one place per class for words never seen. Null
    keys are keys like others, repeated rows are scored each, an empty table gives no rows, and without
    training texts every word is unseen.
    """
    spark = docs.sparkSession
    blocks = read_blocks(docs, held, key, text)
    words = word_counts(blocks)
    totals = {r["class"]: (r["n"], r["v"]) for r in words.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    per_class = np.array([totals.get(c, (0, 0)) for c in range(CLASSES)], np.float64)
    n, v = per_class.sum(0)
    shares = (per_class[:, 0] + SMOOTHING) / (n + SMOOTHING * CLASSES)
    model = fit(blocks, shares)
    log_class = np.log10(per_class[:, 0] + SMOOTHING * (per_class[:, 1] + 1))
    shared = spark.sparkContext.broadcast((model, log_class, math.log10(n + SMOOTHING * (v + 1))))
    each = blocks.select(F.col("block").alias("of_block"), F.posexplode("vocabulary").alias("place", "spelled"))
    found = each.join(words, F.col("spelled") == F.col("word")).select("of_block", F.col("place").cast("long").alias("place"), "n")
    texts = blocks.select("block", "keys", "held", "lengths", "ids", "classes")
    kind = blocks.schema["keys"].dataType.elementType
    schema = f"key {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    together = texts.groupBy("block").cogroup(found.groupBy("of_block"))
    scored = together.applyInArrow(_scorer(shared, to_arrow_type(kind)), schema)
    return scored.withColumn("train_tokens", F.lit(int(n)).cast("long"))
