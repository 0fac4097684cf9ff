"""Byte-level BPE with a segment tree over byte positions.

A piece of text starts as one token per byte. Leaf i of the tree holds the rank of the pair that
starts at byte i and the root the smallest rank with its leftmost place. A merge keeps the left
token, retires the right one and changes three leaves: its own, its live left neighbour's and the
retired one's; each update walks one path to the root. Pieces of like length are merged in step,
as rows of one array, so that every walk serves all of them at once.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from touchline.llm.common import id_and_text, small_batches

#: Above every id (they have 20 bits), and small enough for NONE * width in 64 bits at any length of a text.
NONE = np.int64(1) << 21
#: Cells of one tree array: it stays in the processor's cache.
CELLS = 1 << 17
#: Distinct pieces that a task remembers before it starts anew.
REMEMBERED = 300_000


def read_ranks(lines: bytes) -> list[bytes]:
    """The token bytes of a rank file, by rank."""
    pairs = [line.split() for line in lines.splitlines() if line.strip()]
    tokens = [b""] * (1 + max(int(rank) for _, rank in pairs))
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def pair_table(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of tokens whose concatenation is a token: sorted keys and the ranks they merge to."""
    rank = {t: i for i, t in enumerate(tokens) if t}
    keys, to = [], []
    for i, token in enumerate(tokens):
        for cut in range(1, len(token)):
            a = rank.get(token[:cut])
            b = rank.get(token[cut:]) if a is not None else None
            if b is not None:
                keys.append(a << 20 | b)
                to.append(i)
    order = np.argsort(np.array(keys, np.int64))
    return np.array(keys, np.int64)[order], np.array(to, np.int64)[order]


class Merger:
    """Encodes pieces of bytes by a rank table."""

    def __init__(self, tokens: list[bytes], keys: np.ndarray, to: np.ndarray):
        self.rank = {t: i for i, t in enumerate(tokens) if t}
        self.keys, self.to = keys, to
        self.byte = np.array([self.rank.get(bytes([i]), -1) for i in range(256)], np.int64)

    def _pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair; NONE where either is missing or they don't merge."""
        key = (a << 20) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((a >= 0) & (b >= 0) & (self.keys[at] == key), self.to[at], NONE)

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, one piece after the other, and how many each has."""
        whole = np.array([self.rank.get(p, -1) for p in pieces], np.int64)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        sizes = (whole >= 0).astype(np.int64)
        widths = np.where((whole >= 0) | (lengths == 0), 0, np.maximum(2, 1 << np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64)))
        found = []
        for width in np.unique(widths[widths > 0]).tolist():
            rows, step = np.flatnonzero(widths == width), max(1, CELLS // (2 * width))
            for at in range(0, len(rows), step):
                part = rows[at: at + step]
                ids, sizes[part] = self._in_step([pieces[i] for i in part], lengths[part], width)
                found.append((part, ids))
        starts = np.cumsum(sizes) - sizes
        flat = np.empty(int(sizes.sum()), np.int64)
        flat[starts[whole >= 0]] = whole[whole >= 0]
        for part, ids in found:
            flat[_spread(starts[part], sizes[part])] = ids
        return flat, sizes

    def _in_step(self, pieces: list[bytes], lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(pieces)
        ids = np.full((n, width + 1), -1, np.int64)  # the last column is what lies beyond the end
        ids[:, :-1][np.arange(width) < lengths[:, None]] = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        place = np.arange(width)
        after = np.tile(np.append(place + 1, width), (n, 1))
        before = np.tile(np.append(np.append(width, place[:-1]), width), (n, 1))
        tree = np.full((n, 2 * width), NONE * width, np.int64)
        # A leaf is rank * width + place, so the smallest is the leftmost of the smallest rank.
        tree[:, width:] = self._pair(ids[:, :-1], ids[:, 1:]) * width + place
        level = width
        while level > 1:
            tree[:, level // 2: level] = np.minimum(tree[:, level: 2 * level: 2], tree[:, level + 1: 2 * level: 2])
            level //= 2
        live = np.flatnonzero(tree[:, 1] < NONE * width)
        while len(live):
            best = tree[live, 1]
            left = best % width
            right = after[live, left]
            beyond = after[live, right]
            previous = before[live, left]
            ids[live, left] = best // width
            ids[live, right] = -1
            after[live, left] = beyond
            inside = beyond < width
            before[live[inside], beyond[inside]] = left[inside]
            self._update(tree, live, right, np.full(len(live), NONE), width)
            self._update(tree, live, left, self._pair(ids[live, left], ids[live, beyond]), width)
            some = previous < width
            rows, at = live[some], previous[some]
            self._update(tree, rows, at, self._pair(ids[rows, at], ids[rows, left[some]]), width)
            live = live[tree[live, 1] < NONE * width]
        live_ids = ids[:, :-1] >= 0
        return ids[:, :-1][live_ids], live_ids.sum(axis=1)

    @staticmethod
    def _update(tree: np.ndarray, rows: np.ndarray, place: np.ndarray, rank: np.ndarray, width: int) -> None:
        """Sets one leaf of each row and walks its path to the root."""
        node = place + width
        tree[rows, node] = rank * width + place
        while width > 1:
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
            width >>= 1


class Codec:
    """Encodes and decodes whole texts; remembers the ids of pieces it has met."""

    def __init__(self, tokens: list[bytes], keys: np.ndarray, to: np.ndarray, pattern: str):
        self.merger, self.pieces = Merger(tokens, keys, to), regex.compile(pattern)
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_sizes = np.array([len(t) for t in tokens], np.int64)
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.sizes, self.starts = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def _learn(self, pieces: list[str]) -> None:
        ids, sizes = self.merger.encode([p.encode("utf-8", "surrogatepass") for p in pieces])
        self.number.update(zip(pieces, range(len(self.number), len(self.number) + len(pieces))))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        found = [self.pieces.findall(t) for t in texts]
        if len(self.number) > REMEMBERED:
            self._forget()
        new = set().union(*found).difference(self.number) if found else set()
        if new:
            self._learn(list(new))
        lookup = self.number.__getitem__
        out = []
        for pieces in found:
            at = np.fromiter(map(lookup, pieces), np.int64, len(pieces))
            out.append(self.ids[_spread(self.starts[at], self.sizes[at])])
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        return self.token_bytes[_spread(self.token_starts[ids], self.token_sizes[ids])].tobytes()


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each run, one run after the other."""
    total = int(sizes.sum())
    ends = np.cumsum(sizes)
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


def _codec(kept: dict) -> Codec:
    """One codec per Python worker: it lives in the worker's copy of the broadcast."""
    if "codec" not in kept:
        kept["codec"] = Codec(kept["tokens"], kept["keys"], kept["to"], kept["pattern"])
    return kept["codec"]


def _mapped(docs: DataFrame, ranks: bytes, pattern: str, make: Callable, schema: str) -> DataFrame:
    """``make(codec, texts)`` gives the columns that replace ``text``.

    The broadcast is the rank table and its pairs: a few MB for a vocabulary, whatever the input.
    """
    small_batches(docs.sparkSession)
    tokens = read_ranks(ranks)
    keys, to = pair_table(tokens)
    kept = docs.sparkSession.sparkContext.broadcast({"tokens": tokens, "keys": keys, "to": to, "pattern": pattern})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(kept.value)
        for batch in batches:
            made = make(codec, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made.values()], names=["doc_id", *made])

    return id_and_text(docs).mapInArrow(run, f"doc_id bigint, {schema}")


def _ids(codec: Codec, texts: list[str]) -> dict[str, pa.Array]:
    return {"ids": pa.array([i.astype(np.int32) for i in codec.encode(texts)], pa.list_(pa.int32()))}


def _digests(codec: Codec, texts: list[str]) -> dict[str, pa.Array]:
    found = codec.encode(texts)
    return {
        "n_tokens": pa.array([len(i) for i in found], pa.int64()),
        "ids_sha256": pa.array([hashlib.sha256(i.astype("<u4").tobytes()).hexdigest() for i in found], pa.string()),
        "decoded_sha256": pa.array([hashlib.sha256(codec.decode(i)).hexdigest() for i in found], pa.string()),
    }


def encode(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every row of ``docs``, whole texts.

    A null or empty text has no ids. Repeated rows and null ids give a row each; an empty table
    gives an empty one; other columns are ignored. Each match of ``pattern`` is encoded alone.
    """
    return _mapped(docs, ranks, pattern, _ids, "ids array<int>")


def digests(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """As ``encode``, but the number of ids, their SHA-256 and that of the bytes decoded from them."""
    return _mapped(docs, ranks, pattern, _digests, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def decode(encoded: DataFrame, ranks: bytes) -> DataFrame:
    """``doc_id`` and ``text`` of rows of ``doc_id`` and ``ids``; bytes that are no UTF-8 become U+FFFD.

    Null ids give a null text, no ids an empty one.
    """
    small_batches(encoded.sparkSession)
    tokens = read_ranks(ranks)
    kept = encoded.sparkSession.sparkContext.broadcast(tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = kept.value
        for batch in batches:
            texts = [
                None if ids is None else b"".join([of[i] for i in ids]).decode("utf-8", "replace")
                for ids in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")
