"""Encoding by a public tokenizer inside tasks, with the ids of words met before kept per worker.

The tokenizer's JSON is read once on the driver, by the path that the caller gives, and broadcast: its
size is that of the vocabulary file, whatever the corpus.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterable
from itertools import chain, pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import SparkSession
from tokenizers import Tokenizer

# Words whose ids a worker keeps, beside those of the chunk at hand: of either kind of tokenizer.
KEPT_WORDS, KEPT_SPACED = 600_000, 1_000_000
MARKS = ",.;:!?&%$#*"  # what may follow a word directly and is no letter, digit, apostrophe or space
THREADS = "TOKENIZERS_PARALLELISM"
GROUP = 200  # words that go to the tokenizer as one text
AT_ONCE = 1 << 20  # pieces that are looked up together
SPACES = np.isin(np.arange(256), [*b" \t\n\v\f\r"])
MARKED = np.isin(np.arange(256), [*MARKS.encode()])
PLAIN = np.array([bytes([i]).isalnum() for i in range(256)])
LOWERED = np.frombuffer(bytes(range(256)).lower(), np.uint8)

_loaded: dict[int, "Vocabulary"] = {}


def broadcast_spec(spark: SparkSession, path: str) -> Broadcast:
    return spark.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))


def vocabulary(spec: Broadcast) -> "Vocabulary":
    """The worker's own tokenizer of this broadcast; later batches and tasks find it loaded."""
    text = spec.value
    if (key := hash(text)) not in _loaded:
        _loaded[key] = Vocabulary(text)
    return _loaded[key]


def _kinds(spec: dict) -> tuple[bool, bool]:
    """Whether a tokenizer cuts texts as `encode_words` relies on, and as `encode_spaced` does."""
    steps = (spec.get("normalizer") or {}).get("normalizers") or []
    first, *_ = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [spec.get("pre_tokenizer") or {}]
    # No added token may reach over a place where texts are cut.
    added = [pair for t in spec.get("added_tokens") or [] for pair in pairwise(t["content"].encode())]
    whole = not any(b in b" \n" or (PLAIN[a] and MARKED[b]) for a, b in added)
    merges = spec["model"].get("type", "BPE") == "BPE" and not spec["model"].get("dropout") and whole
    by_words = (
        [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
        and steps[1]["pattern"] == {"Regex": r"\s+"}
        and (first.get("type"), first.get("behavior"), first.get("invert")) == ("Split", "Removed", True)
        and r"[^\s\p{L}\p{N}]+" in first["pattern"].get("Regex", "")
    )
    by_bytes = (
        spec.get("normalizer") is None
        and (first.get("type"), first.get("use_regex"), first.get("add_prefix_space")) == ("ByteLevel", True, False)
    )
    return merges and by_words, merges and by_bytes


class Recent[K]:
    """Ids of the words met lately: full, the newer half becomes the older and the older one goes."""

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.new: dict[K, bytes] = {}
        self.old: dict[K, bytes] = {}

    def turn(self) -> None:
        if len(self.new) > self.limit:
            self.new, self.old = {}, self.new

    def missing(self, words: Iterable[K]) -> list[K]:
        """Those of the distinct words that have no ids; those of the older half move to the newer."""
        found = []
        for word in words:
            if (ids := self.old.get(word)) is not None:
                self.new[word] = ids
            elif word not in self.new:
                found.append(word)
        return found


class Kept:
    """Ids of the pieces met lately, in arrays: all pieces of a chunk are looked up at once."""

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.names = pa.array([], pa.string())
        self.ids = np.zeros(0, np.uint32)
        self.edges = np.zeros(1, np.int64)
        self.met = np.zeros(0, np.int64)  # the last turn that had the piece
        self.turns = 0

    def turn(self) -> None:
        """A new chunk begins. Beyond the limit only pieces met later than half of all stay."""
        self.turns += 1
        if len(self.names) > self.limit:
            stay = np.flatnonzero(self.met > np.partition(self.met, len(self.met) // 2)[len(self.met) // 2])
            self.names = self.names.take(pa.array(stay))
            self.ids, self.edges = self.of(stay)
            self.met = self.met[stay]

    def places(self, pieces: pa.Array, after: int = 0) -> np.ndarray:
        """The place of each piece among those kept since `after`; -1 for those that are not."""
        at = pc.index_in(pieces, self.names.slice(after)).fill_null(-1).to_numpy().astype(np.int64)
        at[at >= 0] += after
        return at

    def add(self, new: dict[str, bytes]) -> None:
        counts = np.fromiter((len(x) // 4 for x in new.values()), np.int64, len(new))
        self.names = pa.concat_arrays([self.names, pa.array(new, pa.string())])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(new.values()), "<u4")])
        self.edges = np.concatenate([self.edges, self.edges[-1] + np.cumsum(counts)])
        self.met = np.concatenate([self.met, np.full(len(new), self.turns)])

    def of(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces at these places, one after the other, and where each starts and ends."""
        counts = self.edges[at + 1] - self.edges[at]
        edges = np.concatenate([[0], np.cumsum(counts)])
        return self.ids[np.repeat(self.edges[at] - edges[:-1], counts) + np.arange(edges[-1])], edges

    def encode(self, pieces: pa.Array, learn: Callable[[list[str]], dict[str, bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """As `of` for any pieces; `learn` gives the ids of those that are not kept."""
        ids, edges = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)]
        for start in range(0, len(pieces), AT_ONCE):
            part = pieces.slice(start, AT_ONCE)
            at = self.places(part)
            if (absent := at < 0).any():
                rest, kept = part.filter(pa.array(absent)), len(self.names)
                self.add(learn(rest.unique().to_pylist()))
                at[absent] = self.places(rest, kept)
            self.met[at] = self.turns
            found, ends = self.of(at)
            ids.append(found)
            edges.append(edges[-1][-1] + ends[1:])
        return np.concatenate(ids), np.concatenate(edges)


class Vocabulary:
    """A tokenizer, and the ids (little-endian 32 bits) of text pieces that stand alone."""

    def __init__(self, spec: str) -> None:
        os.environ[THREADS] = "false"  # a task has one core; idle threads of the library would take others
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        names = sorted(self.tokenizer.get_vocab(with_added_tokens=True).items(), key=lambda x: x[1])
        dense = [i for _, i in names] == list(range(len(names)))
        plain = self.tokenizer.decoder is None and dense
        self.names = pa.array([n for n, _ in names], pa.string()) if plain else None
        self.blank_first = np.zeros(names[-1][1] + 1, bool)
        self.blank_first[[i for n, i in names if n.startswith("\u0120")]] = True  # the byte-level sign of a blank
        self.by_words, self.by_bytes = _kinds(json.loads(spec))
        self.spaced, self.words = Kept(KEPT_SPACED), Kept(KEPT_WORDS)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def decode(self, coded: list[np.ndarray]) -> pa.Array:
        """The library's decode of each list with special tokens; without a decoder that is the tokens and blanks."""
        if self.names is None:
            return pa.array([self.tokenizer.decode(c.tolist(), skip_special_tokens=False) for c in coded], pa.string())
        edges = np.cumsum([0, *map(len, coded)]).astype(np.int32)
        tokens = self.names.take(pa.array(np.concatenate([*coded, np.zeros(0, np.int32)])))
        return pc.binary_join(pa.ListArray.from_arrays(edges, tokens), " ")

    def spans(self, texts: list[str], parallel: bool = False) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and (start, end) characters of each text; in parallel by the library's threads if asked."""
        os.environ[THREADS] = "true" if parallel else "false"
        done = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        os.environ[THREADS] = "false"
        return [
            (np.array(e.ids, np.int64), np.fromiter(chain.from_iterable(e.offsets), np.int64, 2 * len(e)).reshape(-1, 2))
            for e in done
        ]

    def _ids_of_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, many of them encoded as one text; no token reaches over a blank."""
        groups = [words[i : i + GROUP] for i in range(0, len(words), GROUP)]
        out = []
        for group, (ids, spans) in zip(groups, self.spans([" ".join(g) for g in groups])):
            lengths = np.fromiter((len(p) + 1 for p in group), np.int64, len(group))
            out += _parts(ids, np.searchsorted(spans[:, 0], np.cumsum(lengths) - lengths))
        return out

    def _ids_of_spaced(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece. Those that start with a blank are encoded as one text: just their first
        token starts with a blank."""
        spaced = [p for p in pieces if p[0] == " "]
        out = {}
        for at in range(0, len(spaced), GROUP):
            group = spaced[at : at + GROUP]
            ids = np.array(self.tokenizer.encode("".join(group), add_special_tokens=False).ids, np.int64)
            out.update(zip(group, _parts(ids, np.flatnonzero(self.blank_first[ids]))))
        others = [p for p in pieces if p[0] != " "]
        for piece, done in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False)):
            out[piece] = np.array(done.ids, "<u4").tobytes()
        return [out[p] for p in pieces]

    def encode_words(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts under a tokenizer that composes and lowers characters, drops white space and never
        reaches over it. Other tokenizers are refused."""
        if not self.by_words:
            raise ValueError("not a tokenizer that composes, lowers, drops white space and cuts words at marks")
        self.words.turn()
        data, starts, ends = _joined(texts)
        lowered = LOWERED[data]
        # Special tokens are found, and combining marks are composed with the letters before them, ahead of
        # lowering; texts with either keep their capitals.
        for i, t in enumerate(texts):
            if b"<|" in t or b"\xcc" in t or b"\xcd" in t:
                lowered[starts[i] : ends[i]] = data[starts[i] : ends[i]]
        visible = ~SPACES[data]
        first = visible.copy()
        first[1:] &= ~visible[:-1] | _marks_after(data)
        begins = starts[starts < ends]
        first[begins] = visible[begins]
        at = np.flatnonzero(first)
        words = _strings(lowered[visible], np.cumsum(visible)[at] - 1)
        ids, edges = self.words.encode(words, lambda new: dict(zip(new, self._ids_of_words(new))))
        return _parts(ids, edges[np.searchsorted(at, starts)])

    def encode_spaced(self, texts: list[str]) -> list[bytes]:
        """Ids of texts under a byte-level tokenizer, whose tokens hold their leading blank. Other
        tokenizers are refused.

        A text is cut before each blank and around each line end that stand between two visible
        characters, and between a letter or digit and a mark: there the tokenizer's own pattern always
        starts a new piece. A text with other blanks is cut at safe ones only.
        """
        if not self.by_bytes:
            raise ValueError("not a byte-level tokenizer that cuts by its own pattern")
        self.spaced.turn()
        data, starts, ends = _joined([t.encode() for t in texts])
        begins = starts[starts < ends]
        line = data == ord("\n")
        gap = line | (data == ord(" "))
        first = gap.copy()
        first[1:] |= line[:-1] | _marks_after(data)
        first[begins] = True
        # Line ends that touch other blanks or an end of their text.
        touch = np.zeros(len(data), bool)
        touch[1:] = gap[:-1]
        touch[:-1] |= gap[1:]
        touch[begins] = True
        touch[ends[starts < ends] - 1] = True
        at = np.flatnonzero(first)
        pieces = _strings(data, at)
        ids, edges = self.spaced.encode(pieces, self._learn_spaced)
        blank = np.flatnonzero(edges[1:] == edges[:-1])  # odd pieces are kept without ids
        spoilt = np.concatenate([np.flatnonzero(line & touch), at[blank]])
        odd = set(np.searchsorted(ends, spoilt, side="right").tolist())
        coded = _parts(ids, edges[np.searchsorted(at, starts)])
        return [self._encode_grouped(texts[i].split(" ")) if i in odd else c for i, c in enumerate(coded)]

    def _learn_spaced(self, absent: list[str]) -> dict[str, bytes]:
        """Ids of new pieces; none for those with white space other than a leading blank at an end."""
        odd = [p for p in absent if p != "\n" and (not (p[0] == " " and p[1:] or p)[0].strip() or not p[-1].strip())]
        done = dict.fromkeys(odd, b"")
        plain = [p for p in absent if p not in done]
        return done | dict(zip(plain, self._ids_of_spaced(plain)))

    def _encode_grouped(self, parts: list[str]) -> bytes:
        """As `encode_spaced` for a text with blanks beside other white space: pieces by safe blanks."""
        groups = []
        for part in parts:
            joins = groups and groups[-1] and not groups[-1][-1].isspace() and part and not part[0].isspace()
            if joins or not groups:
                groups.append(part)
            else:
                groups[-1] += " " + part
        texts = [groups[0], *[" " + g for g in groups[1:]]]
        done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return b"".join(np.array(e.ids, "<u4").tobytes() for e in done)


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts one after the other, and where each starts and ends."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    return np.frombuffer(b"".join(texts), np.uint8), ends - sizes, ends


def _marks_after(data: np.ndarray) -> np.ndarray:
    """Where a mark follows an ASCII letter or digit, from the second byte on: the patterns of both kinds
    of tokenizer part them there."""
    return PLAIN[data[:-1]] & MARKED[data[1:]]


def _strings(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The bytes as strings, each from its start to the next one's; nothing is copied."""
    edges = np.append(starts, len(data)).astype(np.int32)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data)))


def _parts(ids: np.ndarray, starts: np.ndarray) -> list[bytes]:
    raw, edges = ids.astype("<u4").tobytes(), [*(4 * starts).tolist(), 4 * len(ids)]
    return [raw[a:b] for a, b in zip(edges, edges[1:])]
