"""BPE encoding and decoding; long unsplit texts by tree concatenation.

A long text is cut in halves until the pieces are short; the pieces are encoded in parallel, and the
encodings are joined pairwise up the tree. At each join a window of text around the cut is encoded
anew and grows until its first tokens are those of the left side and its last tokens those of the
right side, with equal ids and equal places in the text; then the window replaces what lies between.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import named, raw_texts, text_chunks
from tabflow.llm.vocab import Vocabulary, broadcast_spec, vocabulary

LEAF_CHARS = 8_192  # a text of at most twice as many characters is not cut
CHUNK = 512 << 10  # bytes of texts that are encoded together; ids, places and decoded texts are many times as large
FIRST_WINDOW = 96  # characters on each side of a cut; more than any special token has
AGREE = 8  # tokens that must be equal on either side of a window

Encoded = tuple[np.ndarray, np.ndarray]  # ids, and (start, end) characters in the whole text


def _safe(text: str, at: int) -> int:
    """The nearest place at or before `at` whose character never composes with the one before it."""
    while at > 0:
        char = text[at]
        if char < "\u0300" or not (
            unicodedata.category(char).startswith("M") or unicodedata.combining(char) or "\u1160" <= char <= "\u11ff"
        ):
            break
        at -= 1
    return at


def cuts(text: str, leaf: int = LEAF_CHARS) -> list[int]:
    """Places that cut the text in halves, again and again, until no piece has over 2 * leaf characters."""
    edges = [0, len(text)]
    while max(b - a for a, b in zip(edges, edges[1:])) > 2 * leaf:
        halves = {_safe(text, (a + b) // 2) for a, b in zip(edges, edges[1:]) if b - a > 2 * leaf}
        if halves <= set(edges):
            break  # one unbroken run of combining marks
        edges = sorted({*edges, *halves})
    return edges


def _window_start(text: str, left: Encoded, cut: int, reach: int) -> int:
    """The number of left tokens before the window: it starts at a token at least `reach` before the cut."""
    starts = left[1][:, 0]
    at = int(np.searchsorted(starts, cut - reach, side="right")) - 1
    while at > 0 and _safe(text, int(starts[at])) != starts[at]:
        at -= 1
    return max(at, 0)


def _agreed(window: Encoded, left: Encoded, right: Encoded, kept: int, whole_right: bool) -> tuple[int, int] | None:
    """Tokens of the window and of the right side to drop, if the window agrees with both sides."""
    ids, spans = window
    n = min(AGREE, len(ids))
    if kept and not (
        len(left[0]) >= kept + n == kept + AGREE
        and np.array_equal(ids[:n], left[0][kept : kept + n])
        and np.array_equal(spans[:n], left[1][kept : kept + n])
    ):
        return None
    if whole_right:
        return len(ids), len(right[0])
    # The tokens before the window's last AGREE, which the end of the window may have changed.
    stop = len(ids) - AGREE
    if stop < AGREE:
        return None
    at = int(np.searchsorted(right[1][:, 0], spans[stop - AGREE, 0]))
    same = slice(at, at + AGREE)
    ends_alike = np.array_equal(ids[stop - AGREE : stop], right[0][same])
    return (stop, at + AGREE) if ends_alike and np.array_equal(spans[stop - AGREE : stop], right[1][same]) else None


def join(known: Vocabulary, text: str, left: Encoded, right: Encoded, begin: int, cut: int, end: int) -> Encoded:
    """The encoding of text[begin:end] from those of text[begin:cut] and text[cut:end]."""
    reach = FIRST_WINDOW
    while True:
        kept = _window_start(text, left, cut, reach) if cut - reach > begin and len(left[0]) else 0
        start = int(left[1][kept, 0]) if kept else begin
        stop = _safe(text, cut + reach) if cut + reach < end else end
        ids, spans = known.spans([text[start:stop]])[0]
        spans = spans + start
        if agreed := _agreed((ids, spans), left, right, kept, stop == end):
            used, dropped = agreed
            return (
                np.concatenate([left[0][:kept], ids[:used], right[0][dropped:]]),
                np.concatenate([left[1][:kept], spans[:used], right[1][dropped:]]),
            )
        reach *= 4


def encode_long(known: Vocabulary, text: str, leaf: int = LEAF_CHARS) -> np.ndarray:
    """Ids of a text of any length: pieces in parallel, joined pairwise until one is left."""
    edges = cuts(text, leaf)
    pieces = known.spans([text[a:b] for a, b in zip(edges, edges[1:])], parallel=True)
    parts = [(ids, spans + a) for (ids, spans), a in zip(pieces, edges)]
    while len(parts) > 1:
        pairs = range(0, len(parts) - 1, 2)
        joined = [join(known, text, parts[i], parts[i + 1], edges[i], edges[i + 1], edges[i + 2]) for i in pairs]
        rest = parts[len(joined) * 2 :]
        edges = [*edges[: 2 * len(joined) : 2], *edges[2 * len(joined) :]]
        parts = joined + rest
    return parts[0][0]


def encode_texts(known: Vocabulary, texts: list[bytes], leaf: int = LEAF_CHARS) -> list[np.ndarray]:
    """Ids of each text; short ones by their words, as the tokenizer drops white space between them."""
    long = {i: whole for i, t in enumerate(texts) if len(t) > 2 * leaf and len(whole := t.decode()) > 2 * leaf}
    short = iter(known.encode_words([t for i, t in enumerate(texts) if i not in long]))
    return [
        encode_long(known, long[i], leaf).astype(np.int32) if i in long else np.frombuffer(next(short), "<i4")
        for i in range(len(texts))
    ]


def _encoder(spec: Broadcast, leaf: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(spec)
        for batch in (c for b in batches for c in text_chunks(b, CHUNK)):
            *keys, texts = batch.columns
            coded = encode_texts(known, raw_texts(texts), leaf)
            offsets = np.cumsum([0, *map(len, coded)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(offsets, np.concatenate([*coded, np.zeros(0, np.int32)]))
            yield pa.RecordBatch.from_arrays([*keys, ids, known.decode(coded)], [*batch.schema.names[:-1], "ids", "decoded"])

    return encode


def encode_documents(
    docs: DataFrame, spec_path: str, keys: list[str], text: str = "text", leaf: int = LEAF_CHARS
) -> DataFrame:
    """The key columns, `ids` (array of int) and `decoded`, one row per document, without a shuffle.

    The tokenizer must drop white space (its tokens never reach over it). A null or empty text has no
    ids and decodes to the empty text; any other columns of the input are not read. Special tokens
    spelled in a text are found as the tokenizer finds them.
    """
    spec = broadcast_spec(docs.sparkSession, spec_path)
    rows = docs.select(*[named(k).alias(f"key_{i}") for i, k in enumerate(keys)], named(text).alias("text"))
    kinds = [f"key_{i} {f.dataType.simpleString()}" for i, f in enumerate(rows.schema.fields[:-1])]
    coded = rows.mapInArrow(_encoder(spec, leaf), ", ".join([*kinds, "ids array<int>", "decoded string"]))
    return coded.select(*[F.col(f"key_{i}").alias(k) for i, k in enumerate(keys)], "ids", "decoded")
