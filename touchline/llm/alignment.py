"""Cross-tokenizer alignment by pointer jumping.

Two tokenizers cut the same bytes. Every token points to the token that reaches farthest right of
those it overlaps, itself included; doubling these pointers takes each token to the last token of its
component, which labels its group. A group ends where tokens of both sides end.

The byte-level side is encoded by merge ranks (tiktoken), twice as fast as its definition, where that is proven
to give the same ids: see ``ranks_of``. Documents travel in blocks of a megabyte of text. A block holds the distinct id pairs of its
documents and, packed, which documents hold which; so of the corpus-wide counts only as many rows
are shuffled as blocks have distinct pairs, never a row per link, and no vocabulary of pairs is broadcast.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from touchline.llm.common import id_and_text, small_batches
from touchline.session import stage

#: Bytes of text in a block; a longer text is a block of its own.
BLOCK = 1 << 20
#: Bytes of text given to a tokenizer at once.
BITE = 1 << 16
#: Links of ids that are spelled out at once.
SLICE = 1 << 18
BLOCK_SCHEMA = (
    "block bigint, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, "
    "groups_sha256 array<string>, code array<bigint>, holders array<bigint>, size array<bigint>, held binary, times binary"
)
DIGESTS = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
TOKENS = "doc_id bigint, a array<int>, b array<int>, a_group array<int>, b_group array<int>"


def read_definitions(a: str, b: str, pattern: str | None = None) -> tuple[str, bytes, str | None]:
    """The byte-level definition at path ``a`` and the piece model at path ``b``, as tasks get them.

    ``pattern`` is the byte-level split as a regular expression; without it, or if ranks don't do, the definition itself encodes.
    """
    with open(a, encoding="utf-8") as first, open(b, "rb") as second:
        definition, model = first.read(), second.read()
    return definition, model, pattern if pattern and ranks_of(definition) else None


def ranks_of(definition: str) -> dict[bytes, int] | None:
    """Ids by bytes, if merging the pair whose joined bytes have the smallest id is the same as following the definition's merges.

    It is if ids ascend with merges and every entry, encoded alone, is one token. For a pair that is no merge
    could only be joined where both halves stand inside the bytes of an entry, and these, whatever surrounds
    them, have been merged as in the entry alone, which ends in the entry's own merge.
    """
    parsed = json.loads(definition)["model"]
    vocabulary, merges = parsed["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in parsed["merges"]]
    joined = [vocabulary.get(a + b) for a, b in merges]
    model = Tokenizer.from_str(definition).model
    added = {token["content"] for token in json.loads(definition)["added_tokens"]}
    plain = {entry: i for entry, i in vocabulary.items() if entry not in added}
    if None in joined or joined != sorted(set(joined)) or any([t.id for t in model.tokenize(e)] != [i] for e, i in plain.items()):
        return None
    letters = _byte_of_letter()
    return {bytes(map(letters.__getitem__, entry)): i for entry, i in plain.items()}


def _byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {chr(b if b in prints else next(spare)): b for b in range(256)}


class Pair:
    """Both tokenizers, and the bytes that each of their ids stands for."""

    def __init__(self, definitions: tuple[str, bytes, str | None]):
        self.a = Tokenizer.from_str(definitions[0])
        self.a.encode_special_tokens = True
        self.ranked = None
        if definitions[2]:
            ranks = ranks_of(definitions[0])
            self.ranked = tiktoken.Encoding("ranks", pat_str=definitions[2], mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=definitions[1])
        letters = _byte_of_letter()
        entries = sorted((i, entry) for entry, i in json.loads(definitions[0])["model"]["vocab"].items())
        self.a_bytes = [b""] * (entries[-1][0] + 1)
        for i, entry in entries:  # an added token's text has letters that stand for no byte; no text gives its id
            self.a_bytes[i] = bytes(letters.get(c, 63) for c in entry)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.a_sizes, self.b_sizes = (np.fromiter(map(len, t), np.int64, len(t)) for t in (self.a_bytes, self.b_bytes))
        # An id's digits, followed by what stands behind it: the next of its side, the other side, or the next group.
        self.a_names = np.array([f"{i}{end}" for i in range(len(self.a_bytes)) for end in ",|"], object)
        self.b_names = np.array([f"{i}{end}" for i in range(len(self.b_bytes)) for end in ",;"], object)

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides of each text; none on both where the joined bytes of a side are not a space and the text."""
        spaced = [f" {text}" if text else "" for text in texts]
        if self.ranked:
            a = [self.ranked.encode_ordinary(text) for text in spaced]
        else:
            a = [found.ids for found in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        b = self.b.encode(texts, num_threads=1)
        for i, text in enumerate(spaced):
            whole = text.encode()
            for ids, entries in ((a[i], self.a_bytes), (b[i], self.b_bytes)):
                if b"".join(map(entries.__getitem__, ids)) != whole:
                    a[i], b[i] = [], []
                    break
        return a, b


def labels(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers, from 0, of the tokens of both sides, which end at these bytes of the same sequence."""
    n = len(a_ends)
    over = np.searchsorted(b_ends, a_ends)  # of the other side: the token that holds the last byte
    under = np.searchsorted(a_ends, b_ends)
    last = b_ends[over] == a_ends if n else np.zeros(0, bool)
    point = np.concatenate([np.where(last, np.arange(n), over + n), under])
    while True:
        jump = point[point]
        if np.array_equal(jump, point):
            break
        point = jump
    number = np.cumsum(last) - 1
    found = number[point] if n else point
    return found[:n], found[n:]


def pair_codes(a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, groups: int, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (mark of the group, id pair) of all links, as mark << 32 | a << 16 | b, ascending, and how many links have it.

    Links are spelled out SLICE at a time; of a larger group the distinct ids are paired with their numbers of occurrences.
    """
    n_a, n_b = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
    a_at, b_at = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    links = n_a * n_b
    upto = np.cumsum(links)
    keys, times = [], []

    low = 0
    while low < groups:
        base = upto[low] - links[low]
        high = max(int(np.searchsorted(upto, base + SLICE, "right")), low + 1)
        if links[low] > SLICE:
            left, n_left = np.unique(a[a_at[low]: a_at[low] + n_a[low]], return_counts=True)
            right, n_right = np.unique(b[b_at[low]: b_at[low] + n_b[low]], return_counts=True)
            for one, n in zip(left, n_left):
                keys.append(mark[low] << 32 | int(one) << 16 | right)
                times.append(n * n_right)
        else:
            here = links[low:high]
            group = np.repeat(np.arange(low, high), here)
            step = np.arange(len(group)) - np.repeat(np.cumsum(here) - here, here)
            first = a[a_at[group] + step // n_b[group]]
            key, n = np.unique(mark[group] << 32 | first << 16 | b[b_at[group] + step % n_b[group]], return_counts=True)
            keys.append(key)
            times.append(n)
        low = high
    if len(keys) < 2:
        return (keys[0], times[0]) if keys else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    whole, each = np.concatenate(keys), np.concatenate(times)
    key, at = np.unique(whole, return_inverse=True)
    return key, np.bincount(at, weights=each).astype(np.int64)


def _planes(values: np.ndarray) -> bytes:
    """Small numbers packed: their bytes by significance, compressed."""
    flat = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
    return len(flat).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(flat, asbytes=True)


def _numbers(packed: bytes) -> np.ndarray:
    size = int.from_bytes(packed[:8], "little")
    flat = pa.Codec("zstd", 1).decompress(packed[8:], size, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(flat, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _gather(pair: Pair, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts, one text behind the other, and how many each text has, of both sides."""
    parts, low = [], 0
    while low < len(texts):
        high, size = low, 0
        while high < len(texts) and (high == low or size + len(texts[high]) <= BITE):
            size += len(texts[high])
            high += 1
        for a, b in zip(*pair.encode(texts[low:high])):
            parts.append((np.array(a, np.int64), np.array(b, np.int64)))
        low = high
    n_a, n_b = (np.fromiter((len(p[k]) for p in parts), np.int64, len(parts)) for k in (0, 1))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), n_a, n_b


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums over consecutive runs of ``counts`` values."""
    upto = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return upto[ends] - upto[ends - counts]


def block_of(pair: Pair, doc_ids: list[int], texts: list[str], number: int) -> dict:
    """One row of BLOCK_SCHEMA. Texts tile their bytes on both sides, so the whole block is one sequence to align."""
    a, b, n_a, n_b = _gather(pair, texts)
    a_ends, b_ends = np.cumsum(pair.a_sizes[a]), np.cumsum(pair.b_sizes[b])
    a_group, b_group = labels(a_ends, b_ends)
    groups = int(a_group[-1]) + 1 if len(a) else 0
    size_a, size_b = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
    doc_of_group = np.repeat(np.arange(len(texts)), n_a)[np.cumsum(size_a) - size_a] if groups else np.zeros(0, np.int64)
    n_groups = np.bincount(doc_of_group, minlength=len(texts))
    key, times = pair_codes(a, b, a_group, b_group, groups, doc_of_group)
    code, at = np.unique(key & 0xFFFFFFFF, return_inverse=True)
    size = np.bincount(key >> 32, minlength=len(texts))
    first = np.zeros(len(at), bool)
    first[(np.cumsum(size) - size)[size > 0]] = True
    return {
        "block": number, "doc_id": doc_ids, "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": _sums(size_a * size_b, n_groups),
        "groups_sha256": _written(pair, a, b, a_group, b_group, size_a, size_b, n_groups), "code": code,
        "holders": np.bincount(at, minlength=len(code)), "size": size,
        # Within a document numbers ascend, so steps are small.
        "held": _planes(np.where(first, at, np.diff(at, prepend=0))), "times": _planes(times),
    }


def _written(pair: Pair, a, b, a_group, b_group, size_a, size_b, n_groups) -> list[str]:
    """Digests of the groups of each document, written a1,a2|b1;a3|b2,b3; empty without groups."""
    a_last, b_last = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    a_last[np.cumsum(size_a) - 1] = 1
    b_last[np.cumsum(size_b) - 1] = 1
    names = np.empty(len(a) + len(b), object)
    # A group's tokens of the first side stand behind those of both sides in earlier groups.
    names[np.arange(len(a)) + (np.cumsum(size_b) - size_b)[a_group]] = pair.a_names[a * 2 + a_last]
    names[np.arange(len(b)) + np.cumsum(size_a)[b_group]] = pair.b_names[b * 2 + b_last]
    ends = np.cumsum(_sums(size_a + size_b, n_groups))
    found, low = [], 0
    for high in ends.tolist():
        found.append(hashlib.sha256("".join(names[low:high])[:-1].encode()).hexdigest() if high > low else "")
        low = high
    return found


def _blocks(docs: DataFrame, definitions: tuple[str, bytes, str | None]) -> DataFrame:
    """All documents in blocks of BLOCK bytes of text. Stored, so numbers of blocks are fixed."""
    small_batches(docs.sparkSession)
    given = docs.sparkSession.sparkContext.broadcast(definitions)  # two vocabularies

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, number = Pair(given.value), TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(doc_id)
                texts.append(text)
                size += len(text)
                if size >= BLOCK:
                    yield _row(block_of(pair, ids, texts, number))
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield _row(block_of(pair, ids, texts, number))

    return stage(id_and_text(docs).mapInArrow(run, BLOCK_SCHEMA), "alignment-blocks")


def _row(block: dict) -> pa.RecordBatch:
    kinds = {"block": pa.int64(), "groups_sha256": pa.list_(pa.string()), "held": pa.binary(), "times": pa.binary()}
    return pa.RecordBatch.from_arrays(
        [pa.array([v], kinds.get(k, pa.list_(pa.int64()))) for k, v in block.items()], names=list(block)
    )


def _counts(blocks: DataFrame) -> DataFrame:
    """``code``, ``count`` (documents that hold the id pair linked) and ``best`` (no pair of its first id has more). Stored."""
    held = blocks.select(F.explode(F.arrays_zip("code", "holders")).alias("x")).select("x.code", "x.holders")
    counts = stage(held.groupBy("code").agg(F.sum("holders").alias("count")), "alignment-counts")
    first = F.shiftright("code", 16).alias("a")
    most = counts.groupBy(first).agg(F.max("count").alias("most"))
    return stage(
        counts.select("code", "count", first).join(most, "a").select("code", "count", (F.col("count") == F.col("most")).alias("best")),
        "alignment-best",
    )


def pair_counts(docs: DataFrame, definitions: tuple[str, bytes, str | None]) -> DataFrame:
    """``a``, ``b``, ``count``, ``best``: how many documents hold this pair of ids linked, and whether no pair of ``a`` has more."""
    return _counts(_blocks(docs, definitions)).select(
        F.shiftright("code", 16).cast("int").alias("a"), F.col("code").bitwiseAND(0xFFFF).cast("int").alias("b"), "count", "best"
    )


def digests(docs: DataFrame, definitions: tuple[str, bytes, str | None]) -> DataFrame:
    """``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256`` of every row of ``docs``.

    A text that is null, empty, or not rebuilt by the bytes of both sides' tokens has zeros and an
    empty digest. Repeated rows and null ids give a row each and count as documents of their own; an
    empty table gives an empty one; other columns are ignored.
    """
    blocks = _blocks(docs, definitions)
    codes = blocks.select("block", F.posexplode("code").alias("at", "code"))
    told = codes.join(_counts(blocks), "code").groupBy("block").agg(F.collect_list(F.struct("at", "count", "best")).alias("told"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                size = _ints(row["size"])
                place, times = _numbers(row["held"].as_py()), _numbers(row["times"].as_py())
                count, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
                if row["told"].is_valid:
                    told = row["told"].values
                    at = told.field("at").to_numpy()
                    count, best = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
                    count[at] = told.field("count").to_numpy()
                    best[at] = told.field("best").to_numpy(zero_copy_only=False)
                # Numbers within a document are steps from its first.
                whole = np.cumsum(place)
                start = np.cumsum(size) - size
                before = np.concatenate([[0], whole])[start]
                at = whole - np.repeat(before, size)
                done = {
                    **{n: row[n].values for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links")},
                    "n_best": pa.array(_sums(best[at] * times, size)), "count_sum": pa.array(_sums(count[at] * times, size)),
                    "groups_sha256": row["groups_sha256"].values,
                }
                yield pa.RecordBatch.from_arrays(list(done.values()), names=list(done))

    kept = blocks.drop("code", "holders").join(told, "block", "left")
    return kept.mapInArrow(run, DIGESTS)


def _ints(value: pa.Scalar) -> np.ndarray:
    return value.values.to_numpy(zero_copy_only=False).astype(np.int64)


def aligned(docs: DataFrame, definitions: tuple[str, bytes, str | None]) -> DataFrame:
    """``doc_id``, ids of both sides in order (``a``, ``b``), and the group of each id, from 0 (``a_group``, ``b_group``).

    Odd rows are treated as in ``digests``: a text without tokens has empty lists. No shuffle.
    """
    small_batches(docs.sparkSession)
    given = docs.sparkSession.sparkContext.broadcast(definitions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(given.value)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b, _, _ = _gather(pair, [text])
                each = [a, b, *labels(np.cumsum(pair.a_sizes[a]), np.cumsum(pair.b_sizes[b]))]
                lists = [pa.array([x.astype(np.int32)], pa.list_(pa.int32())) for x in each]
                yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), *lists], names=["doc_id", "a", "b", "a_group", "b_group"])

    return id_and_text(docs).mapInArrow(run, TOKENS)
