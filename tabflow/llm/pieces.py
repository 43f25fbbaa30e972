"""SentencePiece encoding and decoding by a table of last tokens.

The encoding of every prefix of a text has one last token, and it is enough to keep that token per
prefix: the tokens of a prefix before its last one are the encoding of the shorter prefix. An automaton
finds the pieces that end at each place; of these the last token is the one that may follow the last
token of the prefix it leaves. Two pieces may follow each other if merging their joined text leaves
both. The ids are then read from the end of the table backwards. The cost is linear in the text,
however long it is without a blank.

The model file is read once on the driver and broadcast: its size is that of the vocabulary.
"""

from __future__ import annotations

import codecs
import math
import re
import struct
from collections.abc import Iterator
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import chunks, named
from tabflow.llm.vocab import Recent

# The model file's sign of a blank and its numbers of fields and kinds of pieces.
BLANK = "▁"
PIECES, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, CONTROL, UNKNOWN, BYTE = 1, 3, 2, 6
MODEL_TYPE, BPE, SUFFIX_BLANK, BYTE_FALLBACK, UNKNOWN_TEXT = 3, 2, 24, 35, 44
CHARS_MAP, DUMMY_PREFIX, DROP_BLANKS, ESCAPE_BLANKS = 2, 3, 4, 5

OPEN, NONE = -1, 0  # in a table: nothing comes before this place; no piece ends here
BREAK = "\x00"  # set between chunks of text; part of no piece
KEPT_CHUNKS = 300_000  # chunks whose ids a worker keeps at least, and at most twice as many
KEPT_CHARS = 64  # longer chunks are not kept
KEPT_PAIRS = 400_000  # answers on pairs that a worker keeps

_loaded: dict[int, "PieceModel"] = {}


def _number(raw: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (raw[at] & 127) << shift
        shift, at = shift + 7, at + 1
        if raw[at - 1] < 128:
            return value, at


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbered fields of one message of the model file."""
    at = 0
    while at < len(raw):
        key, at = _number(raw, at)
        if key & 7 == 0:
            value, at = _number(raw, at)
        else:
            size = {1: 8, 5: 4}.get(key & 7)
            if size is None:
                size, at = _number(raw, at)
            value, at = raw[at : at + size], at + size
        yield key >> 3, value


class PieceModel:
    """Pieces by merge order, the automaton over them, and ids of chunks of text met before.

    Models other than merges with byte fallback, a leading blank and unchanged text are refused: the
    table of last tokens would not give their ids.
    """

    def __init__(self, raw: bytes) -> None:
        pieces, trainer, normalizer = [], {}, {}
        for field, value in _fields(raw):
            if field == PIECES:
                pieces.append(dict(_fields(value)))
            elif field == TRAINER:
                trainer = dict(_fields(value))
            elif field == NORMALIZER:
                normalizer = dict(_fields(value))
        names = [p[1].decode() for p in pieces]
        scores = [struct.unpack("<f", p.get(2, bytes(4)))[0] for p in pieces]
        kinds = [p.get(3, NORMAL) for p in pieces]
        normal = [i for i, k in enumerate(kinds) if k == NORMAL]
        as_expected = (
            trainer.get(MODEL_TYPE) == BPE and trainer.get(BYTE_FALLBACK) and not trainer.get(SUFFIX_BLANK)
            and not normalizer.get(CHARS_MAP) and normalizer.get(DUMMY_PREFIX, 1)
            and not normalizer.get(DROP_BLANKS, 1) and normalizer.get(ESCAPE_BLANKS, 1)
            and set(kinds) <= {NORMAL, CONTROL, UNKNOWN, BYTE}
            and {"<s>", "</s>"} <= {n for n, k in zip(names, kinds) if k == CONTROL}
        )
        self.chars = {names[i] for i in normal if len(names[i]) == 1}
        joined = {names[i][a : a + 2] for i in normal for a in range(len(names[i]) - 1)}
        closed = all(c in self.chars for i in normal for c in names[i])
        blanks_lead = all(pair[1] != BLANK or pair[0] == BLANK for pair in joined)
        if not (as_expected and closed and blanks_lead) or BREAK in self.chars or "\n" in self.chars:
            raise ValueError("not a merge model with byte fallback whose blanks lead their pieces")
        self.joined = joined
        self.names, self.begin, self.end = names, names.index("<s>"), names.index("</s>")
        self.ids = {names[i]: i for i in normal}
        order = {s: r for r, s in enumerate(sorted({scores[i] for i in normal}, reverse=True))}
        self.rank = {names[i]: order[scores[i]] for i in normal}
        self.bytes = {int(n[3:5], 16): i for i, (n, k) in enumerate(zip(names, kinds)) if k == BYTE}
        self._grow()
        self.found = ahocorasick.Automaton()
        for name, i in self.ids.items():
            if i in self.left:
                self.found.add_word(name, (i, len(name)))
        self.found.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.recent: Recent[str] = Recent(KEPT_CHUNKS)
        unknown = trainer.get(UNKNOWN_TEXT, " ⁇ ".encode())
        of_kind = {CONTROL: lambda n: b"", UNKNOWN: lambda n: unknown, BYTE: lambda n: bytes([int(n[3:5], 16)])}
        said = [of_kind.get(k, lambda n: n.replace(BLANK, " ").encode())(n) for n, k in zip(names, kinds)]
        self.said = np.frombuffer(b"".join(said), np.uint8)
        self.size = np.array([len(s) for s in said], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.leads = np.array([n[:1] == BLANK for n in names])
        self.silent = np.array([k == CONTROL for k in kinds])

    def merge(self, text: str) -> tuple[list[str], list[tuple[int, str, str]]]:
        """The plain procedure: the best ranked pair of neighbours merges first, the leftmost of equal
        ones. Returns the symbols left and, per merge, its rank and the first and last symbol after it."""
        symbols, steps = list(text), []
        while True:
            ranks = [self.rank.get(a + b, math.inf) for a, b in zip(symbols, symbols[1:])]
            best = min(ranks, default=math.inf)
            if best == math.inf:
                return symbols, steps
            at = ranks.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            steps.append((int(best), symbols[0], symbols[-1]))

    def _grow(self) -> None:
        """For each piece that its own text gives: what stands at its left and at its right edge while
        it is merged, each with the rank of the merge that ends it. None where ranks do not ascend."""
        self.left: dict[int, list | None] = {}
        self.right: dict[int, list | None] = {}
        for name, i in self.ids.items():
            symbols, steps = self.merge(name)
            if symbols != [name]:
                continue  # other merges come first, so this piece is never a token
            ranks = [s[0] for s in steps]
            plain = name[:1] != name[1:2] or name[0] != BLANK  # runs of blanks have equal ranks
            if not plain or ranks != sorted(ranks):
                self.left[i] = self.right[i] = None
                continue
            for edges, first, side in ((self.left, name[0], 1), (self.right, name[-1], 2)):
                spine, at = [], first
                for step in steps:
                    if step[side] != at:
                        spine.append((at, step[0]))
                        at = step[side]
                edges[i] = [*spine, (name, math.inf)]

    def follows(self, a: int, b: int) -> bool:
        """Whether merging the joined text of two pieces leaves both as they are.

        The edges of both grow in the order of their merges; at each state a merge over the border must
        not come before the next one at either edge. Of equal ranks the leftmost merges first.
        """
        lefts, rights = self.right[a], self.left[b]
        if lefts is None or rights is None:
            return self.merge(self.names[a] + self.names[b])[0] == [self.names[a], self.names[b]]
        i = j = 0
        while True:
            (x, until_x), (y, until_y) = lefts[i], rights[j]
            over = self.rank.get(x + y)
            if over is not None and over < until_x and over <= until_y:
                return False
            if until_x == until_y == math.inf:
                return True
            if until_x <= until_y:
                i += 1
            else:
                j += 1

    def table(self, text: str) -> list[int]:
        """The last token of every prefix of a text in which blanks are already spelled as the model does."""
        last = [NONE] * (len(text) + 1)
        last[0] = OPEN
        known = self.chars
        for at, char in enumerate(text):
            if char not in known:
                last[at + 1] = OPEN
        pairs = self.pairs
        if len(pairs) > KEPT_PAIRS:
            pairs.clear()
        for end, (token, size) in self.found.iter(text):
            end += 1
            if last[end]:
                continue
            before = last[end - size]
            if before == OPEN:
                last[end] = token
            elif before:
                pair = before << 20 | token
                fits = pairs.get(pair)
                if fits is None:
                    fits = pairs[pair] = self.follows(before, token)
                if fits:
                    last[end] = token
        return last

    def back(self, text: str, last: list[int], start: int, end: int) -> bytes:
        """Ids of text[start:end] from the table, read backwards."""
        out, names = [], self.names
        while end > start:
            token = last[end]
            if token > 0:
                out.append(token)
                end -= len(names[token])
            else:
                out += [self.bytes[b] for b in reversed(text[end - 1].encode())]
                end -= 1
        out.reverse()
        return struct.pack(f"<{len(out)}I", *out)

    def _encode_apart(self, texts: list[str]) -> list[bytes]:
        """Ids of chunks that stand alone, all by one table; a chunk with the break sign by its own."""
        out = [b""] * len(texts)
        plain = [i for i, t in enumerate(texts) if BREAK not in t]
        joined = BREAK.join([texts[i] for i in plain])
        last, at = self.table(joined), 0
        for i in plain:
            out[i] = self.back(joined, last, at, at + len(texts[i]))
            at += len(texts[i]) + 1
        for i in set(range(len(texts))).difference(plain):
            out[i] = self.back(texts[i], self.table(texts[i]), 0, len(texts[i]))
        return out

    def _learn(self, missing: list[str]) -> dict[str, bytes]:
        """Ids of chunks. Where no piece holds a chunk's last two characters together, no token does, so
        the word and the mark after it are encoded apart; most words with marks are then met before."""
        parted: dict[str, list[str]] = {}
        for chunk in missing:
            base = len(chunk)
            while base > 1 and chunk[base - 2 : base] not in self.joined:
                base -= 1
            parted[chunk] = [chunk[:base], *chunk[base:]]
        new = self.recent.missing({p for parts in parted.values() for p in parts})
        coded = dict(zip(new, self._encode_apart(new)))
        held = self.recent.new
        whole = {c: b"".join([coded[p] if p in coded else held[p] for p in parts]) for c, parts in parted.items()}
        return coded | whole

    def split(self, text: str) -> list[str]:
        """Chunks that no token reaches over: cut before each blank that follows another character, and
        around line ends. Blanks are spelled as the model does, with the one it puts first."""
        if not text:
            return []
        text = BLANK + text.replace(" ", BLANK)
        if BLANK * 2 in text or BREAK in text or text[-1] == BLANK:
            return CHUNK.findall(text)
        return text.replace(BLANK, BREAK + BLANK).replace("\n", "\x00\n\x00").split(BREAK)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers, without begin and end."""
        recent = self.recent
        recent.turn()
        split = [self.split(t) for t in texts]
        distinct = set().union(*split)
        long = {c for c in distinct if len(c) > KEPT_CHARS}
        missing = recent.missing(distinct.difference(recent.new, long))
        if missing:
            recent.new.update(self._learn(missing))
        if not long:
            return [b"".join(map(recent.new.__getitem__, c)) for c in split]
        apart = {c: self.back(c, self.table(c), 0, len(c)) for c in long}
        return [b"".join([apart[c] if c in apart else recent.new[c] for c in parts]) for parts in split]

    def decode(self, ids: list[np.ndarray]) -> pa.Array:
        """The text of each list of ids: pieces and bytes joined, blanks spelled as blanks without the
        one put first; begin and end, at the ends of a list, are silent, and each byte of no character is U+FFFD."""
        lengths = np.array([len(x) for x in ids], np.int64)
        flat = np.concatenate([*ids, np.zeros(0, np.int64)]).astype(np.int64)
        start, size = self.start[flat], self.size[flat]
        heard = np.flatnonzero(~self.silent[flat])
        edges = np.concatenate([[0], np.cumsum(lengths)])
        first = np.searchsorted(heard, edges[:-1])
        has = first < len(heard)
        first = heard[first[has]]
        first = first[(first < edges[1:][has]) & self.leads[flat[first]]]
        start[first] += 1
        size[first] -= 1
        ends = np.concatenate([[0], np.cumsum(size)])
        raw = self.said[np.repeat(start - ends[:-1], size) + np.arange(ends[-1])].tobytes()
        bounds = ends[edges]
        return pa.array([raw[a:b].decode(errors="each_byte") for a, b in zip(bounds, bounds[1:])], pa.string())


# Runs of blanks with what follows them, line ends, and what follows a line end without a blank.
CHUNK = re.compile(f"{BLANK}+[^{BLANK}\n]*|\n|[^{BLANK}\n]+")


def _each_byte(problem: UnicodeError) -> tuple[str, int]:
    return "�" * (problem.end - problem.start), problem.end


codecs.register_error("each_byte", _each_byte)


def model(raw: bytes) -> PieceModel:
    """The worker's own model of these bytes; later batches and tasks find it loaded."""
    if (key := hash(raw)) not in _loaded:
        _loaded[key] = PieceModel(raw)
    return _loaded[key]


def _encoder(spec: Broadcast):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model(spec.value)
        begin, end = (struct.pack("<I", i) for i in (known.begin, known.end))
        for batch in (c for b in batches for c in chunks(b)):
            *keys, texts = batch.columns
            coded = [begin + c + end for c in known.encode([t or "" for t in texts.to_pylist()])]
            decoded = known.decode([np.frombuffer(c, "<u4") for c in coded])
            cells = [*keys, pa.array(coded, pa.binary()), decoded]
            yield pa.RecordBatch.from_arrays(cells, [*batch.schema.names[:-1], "ids", "decoded"])

    return encode


def encode_documents(docs: DataFrame, model_path: str, keys: list[str], text: str = "text") -> DataFrame:
    """The key columns, `ids` (little-endian 32-bit integers with begin and end) and `decoded`, one row
    per document, without a shuffle.

    A null or empty text has the begin and end ids alone and decodes to the empty text; repeated rows
    stay; any other columns are not read, whatever their names; an empty table gives no rows. Names of
    special pieces that are spelled in a text are plain text.
    """
    raw = Path(model_path).read_bytes()
    PieceModel(raw)  # refuses on the driver what it cannot encode
    spec = docs.sparkSession.sparkContext.broadcast(raw)
    rows = docs.select(*[named(k).alias(f"key_{i}") for i, k in enumerate(keys)], named(text).alias("text"))
    kinds = [f"key_{i} {f.dataType.simpleString()}" for i, f in enumerate(rows.schema.fields[:-1])]
    coded = rows.mapInArrow(_encoder(spec), ", ".join([*kinds, "ids binary", "decoded string"]))
    return coded.select(*[F.col(f"key_{i}").alias(k) for i, k in enumerate(keys)], "ids", "decoded")
