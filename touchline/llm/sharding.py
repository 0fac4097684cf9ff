"""Reproducible shuffle and sharding by a Feistel permutation of global row numbers.

Rows are numbered 0 to N-1 in the order of their keys. A keyed permutation of these numbers is
the shuffled position; shard and slot are its remainder and quotient by the number of shards.
So shards differ by one row at most, slots have no gaps, and where row number r goes can be
computed from r, N and the seed alone, without looking at any other row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import in_ranges, numbered_by_part

ROUNDS = 6
SEED = 20240229


def _halves(n: int) -> tuple[int, int]:
    """a * b >= n with as few numbers left over as possible: cycles are then short."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def _feistel(x: Column, a: int, b: int, seed: int) -> Column:
    """One pass over the numbers below a * b: halves are added to in turn, each modulo its own size."""
    left = x % F.lit(a)
    right = ((x - left) / F.lit(a)).cast("bigint")
    for i in range(ROUNDS):
        if i % 2 == 0:
            left = (left + F.pmod(F.xxhash64(right, F.lit(seed + i).cast("bigint")), F.lit(a))) % F.lit(a)
        else:
            right = (right + F.pmod(F.xxhash64(left, F.lit(seed + i).cast("bigint")), F.lit(b))) % F.lit(b)
    return right * F.lit(a) + left


def position(row: Column, n: int, seed: int = SEED) -> Column:
    """Where the permutation of 0..n-1 puts row number ``row``.

    Numbers that leave the range walk on along their cycle until they are back in it. At most
    ``a * b - n`` numbers lie outside, so that many steps are always enough; for a large n a
    step misses with odds of about 1 in sqrt(n), so 64 steps are, and a miss would be an error.
    """
    a, b = _halves(n)
    first = _feistel(row, a, b, seed)
    steps = min(a * b - n, 64)
    if not steps:
        return first
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)), first,
        lambda at, _: F.when(at < n, at).otherwise(_feistel(at, a, b, seed)),
    )
    walked = F.when(walked < n, walked).otherwise(F.raise_error(F.lit("cycle did not return")).cast("bigint"))
    return F.when(first < n, first).otherwise(walked)


def shard(docs: DataFrame, n_shards: int, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``row``, ``position``, ``shard`` and ``slot`` of every row of ``docs``.

    Rows are ordered by (doc_id, text_crc32, size), null ids first; rows equal in all three are
    interchangeable, so every run gives the same table. A null text counts as empty. No rows
    give no rows; other columns are ignored. Only narrow rows are shuffled, once by range (a hot
    id is split: the last sort column is different in all rows), and no group sorts in one task.
    """
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("_tie"),
    )
    order = ["doc_id", "text_crc32", "size", "_tie"]
    ranged = in_ranges(narrow, order, "shard-rows")
    n = ranged.count()
    rows = numbered_by_part(ranged, [], "part", order, "row")
    return rows.withColumn("position", position(F.col("row"), max(n, 1), seed)).select(
        "doc_id", "size", "text_crc32", "row", "position",
        (F.col("position") % n_shards).cast("int").alias("shard"),
        ((F.col("position") - F.col("position") % n_shards) / n_shards).cast("bigint").alias("slot"),
    )
