"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

Unit vectors are rounded to int8, each by its own scale. With x = s q + e the cosine of two
vectors differs from s s' (q . q') by at most |e| |s'q'| + |e'| |x|, so a pair whose product plus
that bound stays below the threshold is settled; only the others are computed in double precision.

Distinct vectors are dealt to blocks, and a task multiplies one block by another. It returns, for
each vector, how many links it has found, weighted by copies, and as few pairs as connect the
linked vectors: never the pairs themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import numbered_by_part
from touchline.llm.components import components, forest
from touchline.session import stage

THRESHOLD = 0.9
#: Components in a block, so 8192 vectors of 64: a tile's arrays stay at some tens of MB.
BLOCK = 1 << 19
#: Columns of a tile that are multiplied at once.
STRIP = 256
#: Covers rounding in the bound's own arithmetic, many times over.
SLACK = 1e-9


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors as int8, their scales, and the length of what rounding takes away, rounded up."""
    scale = np.abs(vectors).max(axis=1) / 127
    q = np.rint(vectors / scale[:, None]).astype(np.int8)
    error = np.sqrt(((vectors - q * scale[:, None]) ** 2).sum(axis=1)) * (1 + 1e-12) + 1e-15
    return q, scale, error


def tile_links(x: np.ndarray, y: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows of ``x`` and ``y`` with a cosine of at least ``threshold``, strip by strip."""
    nx, ny = np.sqrt((x * x).sum(axis=1)), np.sqrt((y * y).sum(axis=1))
    ux, uy = x / nx[:, None], y / ny[:, None]
    (qx, sx, ex), (qy, sy, ey) = quantise(ux), quantise(uy)
    # Sums of int8 products are whole numbers below 2^24 in pieces of 1024 terms: float32 holds them exactly.
    pieces = range(0, x.shape[1], 1024)
    long = [np.ascontiguousarray(qx[:, at: at + 1024], np.float32) for at in pieces]
    for low in range(0, len(y), STRIP):
        part = slice(low, low + STRIP)
        product = sum(a @ qy[part, at: at + 1024].astype(np.float32).T for a, at in zip(long, pieces))
        # Necessary whichever row it is: the largest error of the left side stands for all.
        reach = sy[part] * np.sqrt((qy[part].astype(np.float64) ** 2).sum(axis=1))
        coarse = (threshold - SLACK - ex.max() * reach - ey[part]) / sy[part]
        coarse = (coarse - 1e-6 * (1 + np.abs(coarse))).astype(np.float32)  # for float32's own rounding
        maybe_i, maybe_j = np.nonzero(product * sx[:, None].astype(np.float32) >= coarse)
        if not len(maybe_i):
            continue
        bound = ex[maybe_i] * reach[maybe_j] + ey[low + maybe_j]
        close = product[maybe_i, maybe_j].astype(np.float64) * sx[maybe_i] * sy[low + maybe_j] + bound >= threshold - SLACK
        i, j = maybe_i[close], low + maybe_j[close]
        for at in range(0, len(i), 1 << 16):  # exact, in bounded pieces
            a, b = i[at: at + (1 << 16)], j[at: at + (1 << 16)]
            cosine = (x[a] * y[b]).sum(axis=1) / (nx[a] * ny[b])
            hit = cosine >= threshold
            yield a[hit], b[hit]


def _tile(left: pa.Table, right: pa.Table, same: bool, threshold: float) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Counts (id, links) and connecting pairs of one tile."""
    def read(t):
        flat = t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return t.column("id").to_numpy(), t.column("copies").to_numpy(), flat.reshape(t.num_rows, -1).astype(np.float64)

    (ids, copies, x), (other, weights, y) = read(left), read(right)
    links_x, links_y = np.zeros(len(ids), np.int64), np.zeros(len(other), np.int64)
    pairs: tuple = (np.empty(0, np.int64), np.empty(0, np.int64))
    for i, j in tile_links(x, y, threshold):
        if same:
            i, j = i[i != j], j[i != j]
        np.add.at(links_x, i, weights[j])
        if not same:
            np.add.at(links_y, j, copies[i])
        pairs = forest(np.concatenate([pairs[0], ids[i]]), np.concatenate([pairs[1], other[j]]))
    who = np.concatenate([ids[links_x > 0], other[links_y > 0]])
    return [who, np.concatenate([links_x[links_x > 0], links_y[links_y > 0]])], [pairs[0], pairs[1]]


def links(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``id``, ``links`` and ``other`` of stored, distinct, usable vectors (id, copies, v, number).

    A row either counts (``other`` is null) or connects ``id`` with ``other``. ``number`` is a
    gapless number within vectors of one length; it deals them to blocks.
    """
    size = F.greatest(F.lit(256), (F.lit(BLOCK) / F.col("dim")).cast("int"))
    blocks = vectors.withColumn("dim", F.size("v")).withColumn("block", (F.col("number") / size).cast("int"))
    last = stage(blocks.groupBy("dim").agg(F.max("block").alias("last")), "blocks")
    # Every block meets every block once; a block's rows go to as many tiles as there are blocks.
    dealt = blocks.join(last, "dim").select(
        "id", "copies", "v", "dim", "block", F.explode(F.sequence(F.lit(0), "last")).alias("with")
    ).select(
        "id", "copies", "v", "dim", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"),
        (F.col("block") <= F.col("with")).alias("first"),
    )

    def run(rows: pa.Table) -> pa.Table:
        low, high = rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
        of = rows.column("first").to_numpy(zero_copy_only=False).astype(bool)
        left = rows.filter(pa.array(of))
        right = left if low == high else rows.filter(pa.array(~of))
        if left.num_rows and right.num_rows:
            (who, n), (a, b) = _tile(left, right, low == high, threshold)
        else:
            who = n = a = b = np.empty(0, np.int64)
        return pa.table({
            "id": pa.array(np.concatenate([who, a]).astype(np.int64)),
            "links": pa.array(np.concatenate([n, np.zeros(len(a))]).astype(np.int64)),
            "other": pa.array(np.concatenate([np.zeros(len(who)), b]).astype(np.int64),
                              mask=np.concatenate([np.ones(len(who), bool), np.zeros(len(b), bool)])),
        })

    return dealt.groupBy("dim", "low", "high").applyInArrow(run, "id bigint, links bigint, other bigint")


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row of ``rows`` (vec_id, embedding).

    Vectors that are null, empty or zero, or hold null or non-finite components link with nothing;
    vectors of different dimensions don't link. Lengths of any size are fine. Equal vectors are one point with a number of copies, so a group of copies costs
    no more than one vector. Repeated rows count as other vectors. Null ids count as links but
    name no component: a component of null ids only has a null component_id. An empty table
    gives an empty one; other columns, labels included, are ignored.
    """
    kind = "float" if rows.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    read = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("v"))
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    whole = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    largest = F.array_max(F.transform("v", lambda x: F.abs(x)))
    fit = F.coalesce(whole & (largest > 0), F.lit(False))
    if kind == "double":
        # Squares that double precision can't hold: such a vector is multiplied by a power of two, in two
        # steps as it may be too large for one. That is exact and leaves every cosine as it is.
        power = -F.floor(F.log2(largest))
        half = F.floor(power / 2)
        scaled = F.transform("v", lambda x: x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half))
        extreme = fit & ~norm.between(1e-280, 1e280)
        read = read.withColumn("v", F.when(extreme, scaled).otherwise(F.col("v"))).withColumn("fit", fit)
        fit = F.col("fit")
    # -0.0 and 0.0 are equal numbers, so they must make equal keys.
    plain = F.when(fit, F.transform("v", lambda x: x + F.lit(0.0).cast(kind)))
    digest = F.struct(F.xxhash64("v").alias("x"), F.xxhash64(F.lit(1), "v").alias("y"))
    keyed = stage(
        read.withColumn("v", plain).select("vec_id", "v").withColumn("key", F.when(F.col("v").isNotNull(), digest)), "vectors"
    )
    good = keyed.filter("key is not null")
    points = good.groupBy("key").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.first("v").alias("v"))
    points = stage(points.withColumn("id", F.monotonically_increasing_id()), "points")
    parted = points.withColumn("part", F.shiftright("id", 33)).withColumn("dim", F.size("v"))
    numbered = numbered_by_part(parted, ["dim"], "part", ["id"], "number").drop("part", "dim")
    found = stage(links(numbered, threshold), "tiles")
    counts = found.filter("other is null").groupBy("id").agg(F.sum("links").alias("links"))
    joined = components(found.filter("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
    of = points.select("id", "key", "copies", "least").join(joined.withColumnsRenamed({"node": "id"}), "id", "left")
    of = stage(of.withColumn("component", F.coalesce("component", "id")).join(counts, "id", "left"), "linked")
    least = of.groupBy("component").agg(F.min("least").alias("component_id"))
    named = of.join(least, "component").select(
        "key", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    alone = keyed.filter("key is null").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    linked = good.select("vec_id", "key").join(named, "key").select("vec_id", F.col("n_links").cast("bigint").alias("n_links"), "component_id")
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
