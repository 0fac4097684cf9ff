"""Near-duplicates by the Jaccard similarity of word shingles, exactly.

Two sets of similarity 4/5 or more share a member among the first of each, as many as
size - ceil(4/5 size) + 1, in whatever order all sets are written. So a join on these first
members, the prefixes, meets every such pair, and the pairs met are compared by their whole sets.
The order puts shingles that are frequent in a sample last, then goes by hash: the sample decides
how many pairs are met in vain, not which are found.

Rows of equal sets are one node. Of the nodes that share a member of their prefixes one is elected,
the one that meets most others by its prefix, and those near it link to it first, so a dense group is
one part before any pairs are made; only nodes of different parts meet after that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import row_key, small_batches
from touchline.llm.components import components
from touchline.llm.words import REMEMBERED
from touchline.session import stage

WORDS = 5
#: Share of the texts, and so many at least, whose shingles are counted for the order, and as many shingles at most as go last.
#: A group that is met has a share of the texts, so a sample of fixed size would see fewer of a larger table's groups.
SHARE, SAMPLE, FREQUENT = 0.125, 4_000, 1_000_000
#: Bits of a set's bitmap, a power of two: so many for each member at least, and no more than MOST_BITS.
BITS, MOST_BITS = 4, 1 << 16


class Shingler:
    """Distinct 64-bit hashes of a text's runs of WORDS words, without case; a shorter text is one run, none has none."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_intdigest(word)
        each = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        runs = max(len(each) - WORDS + 1, min(len(each), 1))
        found = np.full(runs, min(len(each), WORDS), np.uint64)
        for k in range(min(len(each), WORDS)):
            found = (found ^ each[k: k + runs]) * np.uint64(0x9E3779B97F4A7C15)
            found ^= found >> np.uint64(29)
        return np.unique(found.view(np.int64))


def parities(members: np.ndarray) -> np.ndarray:
    """The bitmap of a set as 64-bit numbers. Its halves, one against the other, are the bitmap of half the bits."""
    bits = min(max(64, 1 << (BITS * len(members) - 1).bit_length()), MOST_BITS)
    odd = np.bincount(members & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def _can_be_similar() -> Column:
    """Whether sets of sizes ``a_size`` and ``b_size`` with these bitmaps may have a similarity of 4/5 or more.

    They have at most half of what is left of both sizes, without the bits that differ, in common. Sizes of
    pairs that are met differ by a quarter at most, so one bitmap has as many bits as the other or twice as many.
    """
    n = F.least(F.size("a_bits"), F.size("b_bits"))
    either = lambda x, y: x.bitwiseXOR(y)
    a, b = (F.when(F.size(c) > n, F.zip_with(F.slice(c, 1, n), F.slice(c, n + 1, n), either)).otherwise(F.col(c)) for c in ("a_bits", "b_bits"))
    differ = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(either(x, y))), F.lit(0), lambda s, k: s + k)
    return _similar((F.col("a_size") + F.col("b_size") - differ) / 2, F.col("a_size"), F.col("b_size"))


def prefix_length(size: int) -> int:
    """So many of the first members that two sets of similarity 4/5 or more share one of them."""
    return size - (4 * size + 4) // 5 + 1 if size else 0


def _similar(both: Column, a: Column, b: Column) -> Column:
    """Whether sets of sizes ``a`` and ``b`` with ``both`` members in common have a similarity of 4/5 or more."""
    return both * 9 >= (a + b) * 4


def _frequent(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that a sample has twice or more, ascending, and how often."""
    n = texts.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingler(text))], names=["h"])

    some = texts.sample(fraction=min(1.0, max(SHARE, SAMPLE / max(n, 1))), seed=42)
    counts = some.mapInArrow(run, "h bigint").groupBy("h").agg(F.count("*").alias("n")).filter("n > 1")
    found = counts.orderBy(F.desc("n"), "h").limit(FREQUENT).toPandas().sort_values("h")
    return found["h"].to_numpy(np.int64), found["n"].to_numpy(np.int64)


def _hashed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``key``, ``node`` (one for equal sets), ``size``, ``bits`` and ``prefix`` of every row. Stored."""
    text = F.coalesce("text", F.lit("")).alias("text")
    hashes, counts = _frequent(docs.select(text))
    order = docs.sparkSession.sparkContext.broadcast((hashes, counts))  # FREQUENT shingles at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (hashes, counts), shingler = order.value, Shingler()
        for batch in batches:
            nodes, sizes, bits, prefixes = [], [], [], []
            for text in batch.column("text").to_pylist():
                found = shingler(text)
                nodes.append(xxhash.xxh64_intdigest(found.tobytes()))
                sizes.append(len(found))
                bits.append(parities(found))
                if len(hashes):
                    at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
                    found = found[np.argsort(np.where(hashes[at] == found, counts[at], 0), kind="stable")]
                prefixes.append(found[: prefix_length(len(found))])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("key"), pa.array(np.array(nodes, np.uint64).view(np.int64)),
                pa.array(sizes, pa.int32()), pa.array(bits, pa.list_(pa.int64())), pa.array(prefixes, pa.list_(pa.int64())),
            ], names=["doc_id", "key", "node", "size", "bits", "prefix"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_key(docs).alias("key"), text)
    return stage(rows.mapInArrow(run, "doc_id bigint, key string, node bigint, size int, bits array<bigint>, prefix array<bigint>"), "shingled")


def _near(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The stored ``pairs`` (a, b) whose whole sets are similar. Stored. ``nodes``: ``node``, the ``key`` of a row that has it, ``size``, ``bits``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            for node, text in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist()):
                found = pa.array([shingler(text)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), found], names=["node", "members"])

    plain = lambda c: nodes.select(F.col("node").alias(c), F.col("size").alias(f"{c}_size"), F.col("bits").alias(f"{c}_bits"))
    pairs = stage(pairs.join(plain("a"), "a").join(plain("b"), "b").filter(_can_be_similar()).select("a", "b"), "shingle-close")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = stage(nodes.join(wanted, "node", "left_semi").select("node", "key"), "shingle-wanted")
    texts = docs.select(row_key(docs).alias("key"), F.coalesce("text", F.lit("")).alias("text")).join(wanted, "key")
    sets = texts.dropDuplicates(["node"]).select("node", "text").mapInArrow(run, "node bigint, members array<bigint>")
    sets = stage(sets, "shingle-sets")
    of = lambda c: sets.select(F.col("node").alias(c), F.col("members").alias(f"in_{c}"))
    both = F.size(F.array_intersect("in_a", "in_b"))
    near = pairs.join(of("a"), "a").join(of("b"), "b").filter(_similar(both, F.size("in_a"), F.size("in_b")))
    return stage(near.select("a", "b"), "shingle-near")


def _may(a: str, b: str) -> Column:
    """Whether two sets can be similar whose first common member, in the order, is at ``at``."""
    left, right = F.col(f"{a}size"), F.col(f"{b}size")
    most = F.least(left - F.col(f"{a}at"), right - F.col(f"{b}at"))
    return _similar(most, left, right)


def linked(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) that connect whatever sets are similar. ``nodes``: stored ``node``, ``key``, ``size``, ``prefix``."""
    cells = nodes.select("node", "size", F.posexplode("prefix").alias("at", "h"))
    shared = cells.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1")
    cells = stage(cells.join(shared, "h"), "shingle-shared")
    # The text that the others were made from shares its rarest members too, a changed one has new words there.
    met_by = cells.groupBy("node").agg(F.sum("n").alias("met_by"))
    cells = cells.drop("n").join(met_by, "node")
    best = F.struct("met_by", F.bitwise_not("node").alias("order"), "node", "size", "at")
    leads = cells.groupBy("h").agg(F.max(best).alias("lead"))
    leads = leads.select("h", *[F.col(f"lead.{c}").alias(f"l_{c}") for c in ("node", "size", "at")])
    cells = stage(cells.drop("met_by").join(leads, "h"), "shingle-cells")
    star = cells.filter((F.col("node") != F.col("l_node")) & _may("", "l_"))
    stars = _near(stage(star.select(F.col("node").alias("a"), F.col("l_node").alias("b")).distinct(), "shingle-pairs"), nodes, docs)
    parts = components(stars).withColumnsRenamed({"component": "part"})
    placed = cells.select("h", "node", "size", "at").join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))
    placed = stage(placed, "shingle-placed")
    # Each pair of different parts has a node that is not of the cell's largest part.
    sizes = placed.groupBy("h", "part").agg(F.count("*").alias("n"))
    main = sizes.groupBy("h").agg(F.max(F.struct("n", "part"))["part"].alias("main"), F.count("*").alias("parts")).filter("parts > 1")
    live = stage(placed.join(main.select("h", "main"), "h"), "shingle-live")
    other = live.filter("part != main").select("h", *[F.col(c).alias(f"r_{c}") for c in ("node", "size", "at", "part")])
    met = live.join(other, "h").filter((F.col("part") != F.col("r_part")) & _may("", "r_"))
    met = met.select(F.least("node", "r_node").alias("a"), F.greatest("node", "r_node").alias("b")).distinct()
    return stars.union(_near(stage(met, "shingle-pairs"), nodes, docs))


def _joined(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Links (a, b) that connect the nodes of each group: all to the least of them. Stored. ``groups``: ``key``, ``group``, a key once."""
    placed = rows.select("key", "node").distinct().join(groups, "key").select("group", "node").distinct()
    placed = stage(placed, "shingle-groups")
    least = placed.groupBy("group").agg(F.min("node").alias("b"), F.count("*").alias("n")).filter("n > 1").select("group", "b")
    return stage(placed.join(least, "group").filter("node != b").select(F.col("node").alias("a"), "b"), "shingle-joined")


def grouped(docs: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """``doc_id``, ``key`` and ``group`` of every row: equal for rows that links of similarity 4/5 or more connect.

    ``groups``: ``key`` (`row_key`, each once) and ``group`` of rows that another method has linked; its links count like these.
    """
    small_batches(docs.sparkSession)
    rows = _hashed(docs)
    # Of the rows of a node the least key stands for it.
    first = stage(rows.groupBy("node").agg(F.min("key").alias("key")), "shingle-first")
    nodes = rows.drop("doc_id").join(first, ["node", "key"], "left_semi").dropDuplicates(["node"])
    links = linked(stage(nodes, "shingle-nodes"), docs)
    found = components(links if groups is None else links.union(_joined(rows, groups)))
    joined = rows.select("doc_id", "key", "node").join(found, "node", "left")
    return joined.select("doc_id", "key", F.coalesce("component", "node").alias("group"))


def without_copies(docs: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: of the smallest id, and of its texts the least by digest.

    Columns and other rows stay as they are. Rows repeated in every column count as one. Texts
    without a word are copies of each other. ``groups`` as in ``grouped``.
    """
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    kept = grouped(docs, groups).groupBy("group").agg(F.min(rank).alias("best"))
    kept = stage(kept.select(F.col("best.key").alias("_key")).distinct(), "kept")
    one = docs.withColumn("_key", row_key(docs)).join(kept, "_key", "left_semi")
    return one.dropDuplicates(["_key"]).select(*[F.col(f"`{n}`") for n in docs.columns])
