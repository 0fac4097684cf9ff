"""Near-duplicates by SimHash, joined on a segment-popcount embedding.

The 64 bits of a fingerprint are 32 segments of two. Mapping each segment to its number of set
bits embeds fingerprints in a space where the Manhattan distance never exceeds the Hamming
distance. Written in unary (0: 00, 1: 01, 2: 11) an embedded point is again one long, and the
Manhattan distance is the number of differing bits.

The grid: segments are dealt to three groups. Points within Manhattan distance 4 differ by at
most 1 in one of the groups at least, so a range join over that group's cells, the own cell and
those one step up, meets every link. Points that meet are compared by Manhattan distance over
all segments, then exactly.
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
from touchline.session import stage

WORDS = 4
MAX_BITS = 4
SEED = 42
GROUPS = (range(0, 11), range(11, 22), range(22, 32))
LOW = 0x5555555555555555


def fingerprint(text: str, words: int = WORDS) -> int:
    """The SimHash of a text as an unsigned 64-bit number; no words: zero."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) < words:
        grams = [joined]
    else:
        ends = np.cumsum([len(p) + 1 for p in parts])
        starts = (ends - [len(p) + 1 for p in parts])[: len(parts) - words + 1].tolist()
        grams = [joined[s:e] for s, e in zip(starts, (ends[words - 1:] - 1).tolist())]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, SEED) for g in grams], dtype="<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at: at + (1 << 16)].view(np.uint8), bitorder="little")
        counts += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
        keep = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "text"]
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(found)], names=[*names, "f"])


def _unary(f: Column) -> Column:
    """The embedded point: of each pair of bits, the lower says 1 or more, the upper says 2."""
    either = f.bitwiseOR(F.shiftrightunsigned(f, 1)).bitwiseAND(F.lit(LOW))
    each = f.bitwiseAND(F.shiftrightunsigned(f, 1)).bitwiseAND(F.lit(LOW))
    return either.bitwiseOR(F.shiftleft(each, 1))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _cells(points: DataFrame) -> DataFrame:
    """The cell of every point in each group's subspace."""
    masks = [_signed(sum(3 << (2 * i) for i in group)) for group in GROUPS]
    cells = F.array(*[F.struct(F.lit(g).alias("g"), F.col("t").bitwiseAND(F.lit(m)).alias("cell")) for g, m in enumerate(masks)])
    return points.select("*", F.inline(cells))


def _one_up(cells: DataFrame) -> DataFrame:
    """Each cell (``own``) and those that have one more in one segment of the group."""
    steps = [F.array(*[F.lit(_signed(m)) for m in (0, *(1 << (2 * i) for i in group))]) for group in GROUPS]
    step = F.when(F.col("g") == 0, steps[0]).when(F.col("g") == 1, steps[1]).otherwise(steps[2])
    lower, upper = F.col("step"), F.shiftleft("step", 1)
    up = F.when(F.col("cell").bitwiseAND(lower) == 0, F.col("cell").bitwiseOR(lower)).when(
        F.col("cell").bitwiseAND(upper) == 0, F.col("cell").bitwiseOR(upper)
    )
    return (
        cells.select("f", "t", "part", "g", "cell", F.explode(step).alias("step"))
        .select("f", "t", "part", "g", up.alias("cell"), (F.col("step") == 0).alias("own")).filter("cell is not null")
    )


def _differ(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def linked(points: DataFrame) -> DataFrame:
    """Links (a, b) that connect whatever fingerprints differ in MAX_BITS bits or less.

    ``points``: stored rows of distinct ``f``. First each cell elects points, those of smallest
    hash, and near members of the cell link to them: a dense group shrinks to a few parts by an
    aggregate, not by its pairs. The range join then links only points of different parts.
    """
    points = stage(points.withColumn("t", _unary(F.col("f"))), "simhash-embedded")
    cells = stage(_cells(points), "simhash-cells")
    stars = None
    for seed in range(2):
        elected = cells.groupBy("g", "cell").agg(F.min(F.struct(F.xxhash64("f", F.lit(seed)), "f")).alias("e"))
        star = (
            cells.join(elected.select("g", "cell", F.col("e.f").alias("ef")), ["g", "cell"])
            .filter((_differ("f", "ef") <= MAX_BITS) & (F.col("f") != F.col("ef")))
            .select(F.col("f").alias("a"), F.col("ef").alias("b"))
        )
        stars = star if stars is None else stars.union(star)
    stars = stage(stars.distinct(), "stars")
    parts = components(stars).withColumnsRenamed({"node": "f", "component": "part"})
    parted = stage(
        points.join(parts, "f", "left").withColumn("part", F.coalesce("part", "f")), "simhash-points"
    )
    placed = stage(_cells(parted), "simhash-placed")
    build = placed.select("g", "cell", *[F.col(c).alias(f"r_{c}") for c in ("f", "t", "part")])
    met = (
        _one_up(placed).join(build, ["g", "cell"])
        .filter(F.col("part") != F.col("r_part"))
        .filter(~F.col("own") | (F.col("f") < F.col("r_f")))
        .filter(_differ("t", "r_t") <= MAX_BITS)
        .filter(_differ("f", "r_f") <= MAX_BITS)
    )
    return stars.union(met.select(F.col("f").alias("a"), F.col("r_f").alias("b")))


def near_duplicates(docs: DataFrame, keys: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id``, ``fingerprint`` (long) and ``component_id`` of every row of ``docs``, and ``keys``.

    A null or blank text has fingerprint zero and links like any other. Repeated rows share a
    fingerprint, so a component. Null ids count for no minimum: a component that has no other
    ids has a null component_id. An empty table gives an empty one; other columns are ignored.
    Texts are read once and never shuffled; groups form among distinct fingerprints.
    """
    keys = keys or {}
    return _components(docs, keys).select("doc_id", F.col("f").alias("fingerprint"), "component_id", *keys)


def _components(docs: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """``doc_id``, ``f``, ``component`` (one of its fingerprints), ``component_id`` and ``keys`` of every row."""
    small_batches(docs.sparkSession)
    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        *[c.alias(name) for name, c in keys.items()],
    )
    kinds = [f"{n} {t}" for n, t in narrow.dtypes if n != "text"]
    hashed = stage(narrow.mapInArrow(_fingerprints, ", ".join([*kinds, "f bigint"])), "simhash")
    points = stage(hashed.groupBy("f").agg(F.min("doc_id").alias("least")), "fingerprints")
    found = components(linked(points.select("f"))).withColumnsRenamed({"node": "f"})
    of = stage(points.join(found, "f", "left").withColumn("component", F.coalesce("component", "f")), "of")
    least = of.groupBy("component").agg(F.min("least").alias("component_id"))
    named = of.join(least, "component").select("f", "component", "component_id")
    return hashed.join(named, "f").select("doc_id", "f", "component", "component_id", *keys)


def grouped(docs: DataFrame) -> DataFrame:
    """``key`` (`row_key`) and ``group`` of every distinct row: equal for rows whose fingerprints links connect, null ids too."""
    narrow = docs.select("doc_id", "text")
    return _components(narrow, {"key": row_key(narrow)}).select("key", F.col("component").alias("group")).distinct()


def without_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: of the smallest id, and of its texts the least by digest.

    Columns and other rows stay as they are. Rows repeated in every column count as one.
    """
    key = row_key(docs)
    rows = near_duplicates(docs, {"row_key": key})
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    group = F.coalesce("component_id", F.col("fingerprint"))
    alone = F.col("component_id").isNull()
    kept = rows.groupBy(alone.alias("alone"), group.alias("group")).agg(F.min(rank).alias("best"))
    kept = stage(kept.select(F.col("best.row_key").alias("_key")).distinct(), "kept")
    names = docs.columns
    one = docs.withColumn("_key", key).join(kept, "_key", "left_semi")
    return one.dropDuplicates(["_key"]).select(*[F.col(f"`{n}`") for n in names])
