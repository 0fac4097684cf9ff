import math
from collections import defaultdict

import numpy as np
import pytest

from touchline.llm import embeddings
from touchline.llm.components import forest


def data():
    draw = np.random.default_rng(3)
    rows = [draw.normal(size=16) for _ in range(150)]
    for _ in range(5):
        centre = draw.normal(size=16)
        rows += [centre + draw.normal(size=16) * 0.12 for _ in range(30)]
    rows += [rows[0]] * 20 + [rows[1] * 3.5] * 2
    at = draw.normal(size=16)
    for _ in range(20):  # a chain: neighbours link, ends don't
        at = at / np.linalg.norm(at)
        side = draw.normal(size=16)
        side -= side @ at * at
        at = at * 0.92 + side / np.linalg.norm(side) * math.sqrt(1 - 0.92 ** 2)
        rows.append(at)
    return [(k, r.tolist()) for k, r in enumerate(rows)]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_against_all_pairs(spark, kind, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 1)  # 256 vectors in a block, so several tiles
    rows = data()
    docs = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>")
    x = np.array([r.embedding for r in docs.collect()])
    cosine = (x @ x.T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(x, axis=1))
    near = cosine >= 0.9
    np.fill_diagonal(near, False)
    a, b = forest(*[k.astype(np.int64) for k in np.nonzero(near)])
    low = dict(zip(a.tolist(), b.tolist()))
    for r in embeddings.near_duplicates(docs).collect():
        assert r.n_links == near[r.vec_id].sum()
        assert r.component_id == low.get(r.vec_id, r.vec_id)
        assert r.kept == (r.vec_id == r.component_id)


def test_bound_is_rigorous():
    draw = np.random.default_rng(4)
    x = draw.normal(size=(200, 33))
    x /= np.linalg.norm(x, axis=1)[:, None]
    q, s, e = embeddings.quantise(x)
    exact = x @ x.T
    coarse = (q.astype(float) @ q.T.astype(float)) * np.outer(s, s)
    reach = s * np.sqrt((q.astype(float) ** 2).sum(axis=1))
    assert (np.abs(exact - coarse) <= e[:, None] * reach[None, :] + e[None, :] + 1e-12).all()


def test_lengths_that_have_no_square(spark):
    """Cosines of vectors whose squares double precision can't hold, down to the least number and up to the largest."""
    rows = [(0, [1e-150, 0.0]), (1, [2e-150, 0.0]), (2, [1e150, 1e150]), (3, [2e150, 2e150]), (4, [5e-324, 0.0]), (5, [1.7e308, 1.7e308]),
            (6, [0.0, -3e-200]), (7, [1e-310, 1e-310])]
    found = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(
        spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()}
    assert found == {0: (2, 0), 1: (2, 0), 4: (2, 0), 2: (3, 2), 3: (3, 2), 5: (3, 2), 7: (3, 2), 6: (0, 6)}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (1, [1.0, -0.0], None), (2, [2.0, 0.0], 1), (3, None, 1), (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1),
        (6, [inf, 1.0], 1), (7, [1.0, None], 1), (8, [], 1), (9, [1.0], 1), (None, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (10, [5e-200, 0.0], 1),
    ]
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, id int")
    found = defaultdict(set)
    for r in embeddings.near_duplicates(docs).collect():
        found[r.vec_id].add((r.n_links, r.component_id, r.kept))
    assert found[0] == {(5, 0, True)} and all(found[k] == {(5, 0, False)} for k in (1, 2, None, 10))
    assert all(found[k] == {(0, k, True)} for k in (3, 4, 5, 6, 7, 8, 9))
    assert embeddings.near_duplicates(docs.filter("vec_id > 99")).count() == 0
