"""Sequence packing as a cutting-stock problem, solved by column generation on a length histogram.

A document's ids fill whole sequences first; what is left, its remainder, is an item. Items are
counted by length in steps of WIDTH: that histogram, of a fixed size, is all the solver sees. The
linear program's columns are patterns, how many items of each step share a sequence; an unbounded
knapsack over the steps, by dynamic programming, finds the pattern with the best price until none
pays. Patterns are used a whole number of times, and the items of each step, ranked, go to the
patterns' slots by arithmetic on their rank. Rounding leaves a number of items that depends on
the histogram's size alone; those are laid end to end and cut at sequence borders, the last
stretch at powers of two, so they need no padding.
"""

from __future__ import annotations

import itertools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from touchline.llm.common import id_and_text, numbered_by_part, small_batches
from touchline.session import stage

LENGTH = 4096
WIDTH = 8
END = 2
#: The program stops within this share of the optimum: a price of 1 + GAP proves it.
GAP = 1e-2
#: Distinct words that a task remembers before it starts anew.
REMEMBERED = 100_000
#: Characters that Arrow or Python count as white space and the tokenizer does not.
ODD_SPACE = re.compile("[\x1c-\x1f\u180e\u200b\u2060\ufeff]")
#: Words of these characters alone need no normalisation but lower case of single letters.
LETTERS = "a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
PLAIN = re.compile(f"[!-~{LETTERS}]+")
#: The tokenizer's own split, for such words in lower case.
SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^{LETTERS}0-9\n]+")
#: Stands behind each piece of a plain word where its merges are looked up as ranks; no plain word has it.
MARK = "\u07ff"
#: What the vocabulary writes behind the last letter of a piece.
SUFFIX = "</w>"


# --- tokens


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else the next unused one."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {b: chr(b if b in prints else next(spare)) for b in range(256)}


def ranks_of(definition: str) -> tuple[dict[bytes, int], list[int]] | None:
    """Ranks of entries by their bytes, MARK for a piece's end, and the id of each rank; None for another kind of vocabulary.

    Its merges, in order, make an entry each. The mark's own two bytes and a last letter with its mark come together before any merge.
    """
    model, letters = json.loads(definition)["model"], _byte_letters()
    vocabulary, byte = model["vocab"], {letter: b for b, letter in letters.items()}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    singles = [letters[b] for b in range(256)]
    needed = {*singles, *[x + SUFFIX for x in singles], *[a + b for a, b in merges]}
    if model.get("end_of_word_suffix") != SUFFIX or not needed <= set(vocabulary):
        return None
    mark = MARK.encode()

    def raw(entry: str) -> bytes:
        last = entry.endswith(SUFFIX)
        return bytes(byte[c] for c in (entry[: -len(SUFFIX)] if last else entry)) + mark * last

    order = [raw(x) for x in singles] + [mark] + [raw(x + SUFFIX) for x in singles] + [raw(a + b) for a, b in merges]
    ids = [vocabulary[x] for x in singles] + [-1] + [vocabulary[x + SUFFIX] for x in singles] + [vocabulary[a + b] for a, b in merges]
    ranks = {entry: n for n, entry in enumerate(order)}
    return (ranks, ids) if len(ranks) == len(order) else None


class Words:
    """Ids of whole texts. White space separates tokens, so each distinct word is encoded once."""

    def __init__(self, definition: str):
        self.tokenizer = Tokenizer.from_str(definition)
        self.ranked = None
        found = ranks_of(definition)
        if found:
            ranks, ids = found
            self.ranked = tiktoken.Encoding("words", pat_str=f"[^{MARK}]+{MARK}", mergeable_ranks=ranks, special_tokens={})
            self.of_rank = np.array(ids, np.int64)
            self.last = np.zeros(len(ids), bool)
            self.last[[n for entry, n in ranks.items() if entry.endswith(MARK.encode())]] = True
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.starts, self.sizes = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def _learn(self, new: list[str]) -> None:
        plain = [w for w in new if PLAIN.fullmatch(w) and "<|" not in w] if self.ranked else []
        others = list(set(new).difference(plain))
        found = [self.tokenizer.encode(word, add_special_tokens=False).ids for word in others]
        ids, sizes = self._plain(plain) if plain else (np.empty(0, np.int64), np.empty(0, np.int64))
        sizes = np.concatenate([sizes, np.fromiter(map(len, found), np.int64, len(found))])
        self.number.update(zip([*plain, *others], range(len(self.number), len(self.number) + len(new))))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, ids, np.fromiter(itertools.chain.from_iterable(found), np.int64)])

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words, one behind the other, and how many each has: all pieces are encoded by one call."""
        marked = SPLIT.sub(rf"\g<0>{MARK}", "\n".join(words).lower())
        pieces = np.fromiter((line.count(MARK) for line in marked.split("\n")), np.int64, len(words))
        ranks = self.ranked.encode_to_numpy(marked.replace("\n", ""), disallowed_special=())
        ends = np.flatnonzero(self.last[ranks])[np.cumsum(pieces) - 1] + 1
        return self.of_rank[ranks], np.diff(ends, prepend=0)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text and END."""
        split = pc.utf8_split_whitespace(texts)
        distinct = pc.dictionary_encode(split.flatten())
        words = distinct.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.number) > REMEMBERED:
            self._forget()
        new = set(words).difference(self.number)
        if new:
            self._learn(list(new))
        number = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        at = number[distinct.indices.to_numpy()] if len(words) else np.empty(0, np.int64)
        sizes = self.sizes[at]
        ends = np.append(0, np.cumsum(sizes))
        ids = self.ids[np.arange(ends[-1]) + np.repeat(self.starts[at] - ends[:-1], sizes)].astype("<u4")
        cuts = ends[np.cumsum(np.append(0, pc.list_value_length(split).to_numpy()))]
        odd = set(np.flatnonzero(pc.match_substring_regex(texts, ODD_SPACE.pattern).to_numpy(zero_copy_only=False)).tolist())
        end = np.array([END], "<u4")
        return [
            np.concatenate([
                np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, "<u4") if i in odd else ids[cuts[i]: cuts[i + 1]],
                end,
            ]) for i in range(len(texts))
        ]


def _words(kept: dict) -> Words:
    """One tokenizer per Python worker: it lives in the worker's copy of the broadcast."""
    if "words" not in kept:
        kept["words"] = Words(kept["definition"])
    return kept["words"]


def read_definition(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def _counted(docs: DataFrame, definition: str, length: int) -> DataFrame:
    """``doc_id``, ``doc_tokens``, ``doc_crc32`` and ``crcs``, of each stretch of ``length`` ids."""
    small_batches(docs.sparkSession)
    kept = docs.sparkSession.sparkContext.broadcast({"definition": definition})  # a vocabulary: a few MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(kept.value)
        for batch in batches:
            found = words.encode(batch.column("text"))
            crcs = [[zlib.crc32(ids[at: at + length].tobytes()) for at in range(0, len(ids), length)] for ids in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([len(i) for i in found], pa.int64()),
                    pa.array([zlib.crc32(i.tobytes()) for i in found], pa.int64()), pa.array(crcs, pa.list_(pa.int64())),
                ],
                names=["doc_id", "doc_tokens", "doc_crc32", "crcs"],
            )

    return id_and_text(docs).mapInArrow(run, "doc_id bigint, doc_tokens bigint, doc_crc32 bigint, crcs array<bigint>")


# --- the linear program


def _best_pattern(price: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The most valuable multiset of sizes within the capacity, by dynamic programming over it."""
    value, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fit = np.searchsorted(sizes, room, side="right")
        value[room], last[room] = value[room - 1], -1
        if fit:
            with_item = price[:fit] + value[room - sizes[:fit]]
            k = int(with_item.argmax())
            if with_item[k] > value[room]:
                value[room], last[room] = with_item[k], k
    pattern, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            pattern[last[room]] += 1
            room -= sizes[last[room]]
    return pattern


def _greedy(need: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """A basis to start from: patterns that fill up with the largest sizes still needed.

    Each pattern is used until the first of its sizes runs out, which is its column; later patterns are
    without that size, so the columns are triangular in the order in which sizes run out.
    """
    left, open_ = need.copy(), np.ones(len(sizes), bool)
    columns = np.zeros((len(sizes), len(sizes)))
    for _ in range(len(sizes)):
        pattern, room = np.zeros(len(sizes)), capacity
        for i in np.flatnonzero(open_)[::-1]:
            if sizes[i] <= room:
                pattern[i], room = room // sizes[i], room % sizes[i]
        used = np.flatnonzero(pattern)
        times = left[used] / pattern[used]
        out = int(used[times.argmin()])
        left -= times.min() * pattern
        columns[:, out], open_[out] = pattern, False
    return columns


def patterns(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns ({size: items}, times) for ``counts`` items of each size, by column generation.

    A revised simplex method over as many columns as there are sizes, starting from greedy patterns. ``times`` are the solution rounded down, so no item is used twice and fewer
    than one use of each pattern is left over.
    """
    sizes = np.array(sorted(s for s, n in counts.items() if n > 0), np.int64)
    if not len(sizes):
        return []
    need = np.array([counts[int(s)] for s in sizes], float)
    m = len(sizes)
    columns = _greedy(need, sizes, capacity)
    inverse = np.linalg.inv(columns)
    amount = np.maximum(inverse @ need, 0)
    for step in range(60 * m):
        if step % 200 == 199:  # against rounding errors
            inverse = np.linalg.inv(columns)
            amount = np.maximum(inverse @ need, 0)
        entering = _best_pattern(inverse.sum(axis=0), sizes, capacity).astype(float)
        if inverse.sum(axis=0) @ entering <= 1 + GAP:
            break
        change = inverse @ entering
        ratio = np.where(change > 1e-9, amount / np.where(change > 1e-9, change, 1), np.inf)
        out = int(ratio.argmin())
        amount = amount - ratio[out] * change
        amount[out] = ratio[out]
        pivot = inverse[out] / change[out]
        inverse = inverse - np.outer(change, pivot)
        inverse[out] = pivot
        columns[:, out] = entering
    times = np.floor(np.linalg.solve(columns, need) + 1e-7).astype(np.int64)
    left, found = need.astype(np.int64), []
    for k in np.argsort(-columns.sum(axis=0), kind="stable"):
        pattern = columns[:, k].astype(np.int64)
        used = np.flatnonzero(pattern)
        n = int(max(0, min(times[k], *(left[used] // pattern[used]))))
        if n:
            left = left - n * pattern
            found.append(({int(sizes[i]): int(pattern[i]) for i in used}, n))
    return found


# --- the plan


def _numbers(spark: SparkSession, found: list[tuple[dict[int, int], int]]) -> DataFrame:
    """Which ranks of each step go to which pattern: (step, from, upto, each, sequence).

    Items ``from`` to ``upto`` - 1 of the step fill the pattern's sequences, ``each`` to one.
    """
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in found:
        for step, each in pattern.items():
            at = taken.get(step, 0)
            rows.append((step, at, at + each * times, each, sequence))
            taken[step] = at + each * times
        sequence += times
    return spark.createDataFrame(rows, "step bigint, from bigint, upto bigint, each bigint, first bigint")


def _borders(total: int, length: int) -> list[int]:
    """Where sequences end that hold ``total`` ids without padding: full ones, then powers of two."""
    ends = list(range(length, total + 1, length))
    rest = total % length
    at = total - rest
    while rest:
        part = 1 << (rest.bit_length() - 1)
        at, rest = at + part, rest - part
        ends.append(at)
    return ends


def pack(docs: DataFrame, definition: str, length: int = LENGTH, width: int = WIDTH) -> DataFrame:
    """Pieces of all ``docs`` in sequences of at most ``length`` ids.

    Columns: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.
    A null or empty text has one id, the end mark. Repeated rows are packed each on its own, null
    ids like others; no rows give no rows; other columns are ignored. Texts are read once, and
    the at most one document per border that is cut a second time. Ids are never shuffled: the
    plan needs lengths and digests only. The driver holds the histogram (``length / width``
    counts), its patterns and the borders of the items that rounding leaves, at most one sequence
    per pattern.
    """
    spark = docs.sparkSession
    counted = stage(_counted(docs, definition, length).withColumn("uid", F.monotonically_increasing_id()), "tokens")
    pieces = counted.select(
        "doc_id", "doc_tokens", "doc_crc32", "uid", F.shiftright("uid", 33).alias("part"),
        F.posexplode("crcs").alias("pos", "ids_crc32"),
    ).withColumn("start", F.col("pos").cast("bigint") * length).withColumn(
        "length", F.least(F.lit(length).cast("bigint"), F.col("doc_tokens") - F.col("start"))
    ).withColumn("step", F.ceil(F.col("length") / width).cast("bigint"))
    pieces = stage(pieces.drop("pos"), "pieces")
    histogram = {r["step"]: r["n"] for r in pieces.groupBy("step").agg(F.count("*").alias("n")).collect()}
    found = patterns(histogram, length // width)
    ranked = numbered_by_part(pieces, ["step"], "part", ["uid", "start"], "rank")
    plan = _numbers(spark, found).withColumnsRenamed({"step": "_step"})
    in_pattern = (F.col("step") == F.col("_step")) & (F.col("rank") >= F.col("from")) & (F.col("rank") < F.col("upto"))
    placed = ranked.join(F.broadcast(plan), in_pattern, "left")  # at most (length / width)^2 rows, whatever the input
    at = F.col("rank") - F.col("from")
    placed = stage(placed.withColumn("sequence_id", F.col("first") + ((at - at % F.col("each")) / F.col("each")).cast("bigint")), "placed")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    order = Window.partitionBy("sequence_id").orderBy("uid", "start")  # a sequence has `length` pieces at most
    before = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fitted = placed.filter("sequence_id is not null").withColumn("offset", F.coalesce(before, F.lit(0)).cast("bigint"))
    first_free = sum(n for _, n in found)
    left = _cut(docs, definition, placed.filter("sequence_id is null"), first_free, length)
    return fitted.select(names).unionByName(left.select(names))


def _cut(docs: DataFrame, definition: str, left: DataFrame, first_sequence: int, length: int) -> DataFrame:
    """What rounding has left, end to end. It fills fewer sequences than there are patterns."""
    spark = docs.sparkSession
    line = Window.orderBy("uid", "start").rowsBetween(Window.unboundedPreceding, -1)
    laid = stage(left.withColumn("at", F.coalesce(F.sum("length").over(line), F.lit(0)).cast("bigint")), "left")
    total = laid.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    ends = _borders(total, length)
    spans = [(first_sequence + i, start, end) for i, (start, end) in enumerate(zip([0, *ends], ends))]
    borders = spark.createDataFrame(spans, "sequence bigint, low bigint, high bigint")
    meets = (F.col("at") < F.col("high")) & (F.col("at") + F.col("length") > F.col("low"))
    parts = laid.join(F.broadcast(borders), meets)  # a row per sequence: fewer than patterns
    low, high = F.greatest("at", "low"), F.least(F.col("at") + F.col("length"), F.col("high"))
    parts = stage(parts.select(
        "doc_id", "doc_tokens", "doc_crc32", F.col("sequence").alias("sequence_id"), (low - F.col("low")).alias("offset"),
        F.col("ids_crc32"), (F.col("start") + low - F.col("at")).alias("start"), (high - low).alias("length"),
        ((high - low) < F.col("length")).alias("cut"),
    ), "left-parts")
    whole = parts.filter("not cut").drop("cut")
    cut = parts.filter("cut").drop("cut", "ids_crc32")
    crcs = stage(_crcs(docs, definition, cut.select("doc_id", "doc_crc32", "start", "length").distinct()), "cut-crcs")
    renamed = crcs.withColumnsRenamed({c: f"_{c}" for c in ("doc_id", "doc_crc32", "start", "length")})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("doc_id", "doc_crc32", "start", "length")]
    return whole.unionByName(cut.join(renamed, same).drop(*[c for c in renamed.columns if c.startswith("_")]))


def _crcs(docs: DataFrame, definition: str, wanted: DataFrame) -> DataFrame:
    """Digests of single stretches of ids, of the few documents that have them."""
    kept = docs.sparkSession.sparkContext.broadcast({"definition": definition})
    of = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("doc_crc32", "start", "length")).alias("spans"))
    of = of.withColumnsRenamed({"doc_id": "_id"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(kept.value)
        for batch in batches:
            rows = []
            texts = words.encode(batch.column("text"))
            for doc_id, ids, spans in zip(batch.column("doc_id").to_pylist(), texts, batch.column("spans").to_pylist()):
                crc = zlib.crc32(ids.tobytes())
                for s in spans:
                    if s["doc_crc32"] == crc:
                        stretch = ids[s["start"]: s["start"] + s["length"]]
                        rows.append({"doc_id": doc_id, "doc_crc32": crc, "start": s["start"], "length": s["length"],
                                     "ids_crc32": zlib.crc32(stretch.tobytes())})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    kinds = ("doc_id", "doc_crc32", "start", "length", "ids_crc32")
    schema = pa.schema([(k, pa.int64()) for k in kinds])
    found = id_and_text(docs).join(F.broadcast(of), F.col("doc_id").eqNullSafe(F.col("_id"))).drop("_id")
    return found.mapInArrow(run, ", ".join(f"{k} bigint" for k in kinds)).distinct()
