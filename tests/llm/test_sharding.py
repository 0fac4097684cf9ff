import struct
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash

from odd_rows import nothing, odd  # noqa: F401

from touchline.llm import sharding


def spark_hash(x, key):
    h = xxhash.xxh64_intdigest(struct.pack("<q", x), 42)
    h = xxhash.xxh64_intdigest(struct.pack("<q", key), h)
    return h - (1 << 64) if h >= 1 << 63 else h


def brute_position(row, n, seed):
    a, b = sharding._halves(n)
    while True:
        left, right = row % a, row // a
        for i in range(sharding.ROUNDS):
            if i % 2 == 0:
                left = (left + spark_hash(right, seed + i) % a) % a
            else:
                right = (right + spark_hash(left, seed + i) % b) % b
        row = right * a + left
        if row < n:
            return row


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_permutation(spark, n):
    from pyspark.sql import functions as F

    got = [r.p for r in spark.range(n).select("id", sharding.position(F.col("id"), n, 5).alias("p")).orderBy("id").collect()]
    assert got == [brute_position(i, n, 5) for i in range(n)]
    assert sorted(got) == list(range(n))


def test_shards(spark, odd):
    rows = sharding.shard(odd, 3).collect()
    assert len(rows) == odd.count()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].size == 8 and by_id[1].text_crc32 == zlib.crc32(b"")
    text = "écrit à jane.doe+x@mail.example.com ou +1 (555) 010-9999 🎉 fin".encode()
    assert by_id[5].size == len(text) + 8 and by_id[5].text_crc32 == zlib.crc32(text)


def test_reproducible(spark, odd):
    key = lambda df: Counter(tuple(r) for r in df.collect())
    assert key(sharding.shard(odd, 4)) == key(sharding.shard(odd.repartition(7), 4))
    assert key(sharding.shard(odd, 4, 1)) != key(sharding.shard(odd, 4, 2))


def test_empty(nothing):
    assert sharding.shard(nothing, 4).count() == 0
