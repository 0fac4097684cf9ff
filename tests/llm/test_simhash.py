import random

import numpy as np
import pandas as pd
import pytest

from odd_rows import nothing, odd  # noqa: F401

from touchline.llm import simhash
from touchline.llm.components import components


def brute_components(pairs, nodes):
    of = {n: n for n in nodes}

    def find(n):
        while of[n] != n:
            n = of[n]
        return n

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        of[y] = x
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("kind", ["chain", "star", "random", "pairs"])
def test_components(spark, kind):
    draw = random.Random(2)
    pairs = {
        "chain": [(k, k + 1) for k in range(60)], "star": [(7, k) for k in range(50)], "pairs": [(3, 3), (5, 4), (4, 5), (9, 8), (-2, 9)],
        "random": [(draw.randrange(80), draw.randrange(80)) for _ in range(60)],
    }[kind]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == brute_components(pairs, {n for p in pairs for n in p})


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def near(draw, base, bits):
    for k in draw.sample(range(64), bits):
        base ^= 1 << k
    return base


def test_links_against_brute_force(spark):
    """Random points, dense balls and chains of small steps: the same components as all pairs give."""
    draw = random.Random(5)
    points = {draw.getrandbits(64) for _ in range(400)}
    for _ in range(6):
        centre = draw.getrandbits(64)
        points |= {near(draw, centre, draw.randint(0, 6)) for _ in range(60)}
    at = draw.getrandbits(64)
    for _ in range(40):
        at = near(draw, at, 4)
        points.add(at)
    points |= {0, (1 << 64) - 1, 15}
    f = np.array(sorted(points), np.uint64)
    i, j = np.nonzero(np.bitwise_count(f[:, None] ^ f[None, :]) <= 4)
    signed = f.view(np.int64).tolist()
    want = brute_components([(signed[a], signed[b]) for a, b in zip(i, j)], signed)
    stored = spark.createDataFrame(pd.DataFrame({"f": signed}))
    got = {r.node: r.component for r in components(simhash.linked(stored)).collect()}
    assert {n: got.get(n, n) for n in signed} == want


def test_manhattan_is_a_lower_bound():
    draw = random.Random(1)
    unary = lambda x: ((x | x >> 1) & simhash.LOW) | ((x & x >> 1) & simhash.LOW) << 1
    for _ in range(500):
        a = draw.getrandbits(64)
        b = near(draw, a, draw.randint(0, 20))
        counts = lambda x: [bin(x >> 2 * k & 3).count("1") for k in range(32)]
        manhattan = sum(abs(p - q) for p, q in zip(counts(a), counts(b)))
        assert bin(unary(a) ^ unary(b)).count("1") == manhattan <= bin(a ^ b).count("1")


def test_documents(odd, nothing):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].component_id == by_id[4].component_id == 0
    assert {by_id[k].fingerprint for k in (1, 2, 3)} == {0} and {by_id[k].component_id for k in (1, 2, 3)} == {1}
    assert by_id[None].component_id is None
    assert simhash.near_duplicates(nothing).count() == 0
    kept = simhash.without_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 1, 5, 6, 7]
    assert simhash.without_copies(nothing).count() == 0


def test_definition():
    import xxhash

    text = "A b\tC  d e\x0bf"
    words = ["a", "b", "c", "d", "e", "f"]
    grams = [" ".join(words[k: k + 4]) for k in range(3)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    want = sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > 3)
    assert simhash.fingerprint(text) == want
    assert simhash.fingerprint("One two") == xxhash.xxh64_intdigest(b"one two", 42)
