"""The fitted queries train with the operators' own settings, once per model."""

import os

import pytest

from touchline.operators import learn
from touchline.plans import binding, model_queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_defaults_and_sharing(spark, monkeypatch):
    """The defaults are made small here, so what a query sets itself shows."""
    seen, fit = [], learn.GBTRegressor
    monkeypatch.setattr(learn, "TREES", {"maxIter": 1, "maxDepth": 2, "seed": 42})
    monkeypatch.setattr(learn, "GBTRegressor", lambda **p: (seen.append((p["maxIter"], p["maxDepth"])), fit(**p))[1])
    binding.forget()
    try:
        for query in (model_queries.train_one, model_queries.importance, model_queries.train_all):
            assert query(spark, SF).count() > 0
    finally:
        binding.forget()
    assert seen == [(1, 2)] * 2
