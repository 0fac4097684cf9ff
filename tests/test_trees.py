"""The trees of one job are Spark's trees, whatever the tasks; features dealt together cost what copies cost."""

from __future__ import annotations

import re

import pytest
from pyspark.ml import regression
from pyspark.sql import functions as F

from touchline import config
from touchline.operators import learn, trees

FEATURES = ("rank_before", "opponent_club_id", "month", "is_derby")


@pytest.fixture(scope="module")
def rows(spark):
    made = spark.range(3000).select(
        F.concat(F.lit("m"), "id").alias("match_id"), F.when(F.col("id") % 9 > 0, F.rand(1) * 1000).alias("rank_before"),
        F.floor(F.rand(2) * 12).alias("month"), F.lit(5).alias("is_derby"),
        F.concat(F.lit("c"), F.floor(F.rand(3) * 9).cast("string")).alias("opponent_club_id"), F.rand(5).alias("_noise"),
    )
    by_club, by_rank = F.pmod(F.xxhash64("opponent_club_id"), F.lit(700)), F.coalesce("rank_before", F.lit(400.0))
    gate = 2000 + by_rank * 2 + by_club + F.when(F.col("month") > 6, by_rank).otherwise(50) + F.col("_noise") * 300
    return made.withColumn("attendance", gate.cast("int")).drop("_noise").cache()


def text_of(model) -> str:
    return model.stages[-1].toDebugString.split("\n", 1)[1]


def rounded(text: str) -> str:
    return re.sub(r"-?\d+\.\d+(E-?\d+)?", lambda m: f"{float(m.group()):.6g}", text)


def test_trees_are_those_of_spark(rows, monkeypatch):
    own = learn.train_one(rows, FEATURES, maxIter=6, maxDepth=6)
    monkeypatch.setattr(learn, "GBTRegressor", regression.GBTRegressor)
    spark_s = learn.train_one(rows, FEATURES, maxIter=6, maxDepth=6)
    assert rounded(text_of(own)) == rounded(text_of(spark_s)) and text_of(own).count("in {") > 0
    a, b = (m.stages[-1].featureImportances.toArray() for m in (own, spark_s))
    assert a == pytest.approx(b) and a[3] == 0.0


def test_one_job_boosts_all_trees(spark, rows):
    """Spark starts a job and more per level; here the number does not depend on the trees."""
    def jobs(n: int) -> int:
        group = f"trees-{n}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            learn.train_one(rows, FEATURES, maxIter=n, maxDepth=4)
            return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    assert jobs(9) == jobs(2) < 40


@pytest.mark.parametrize("rate", [1.0, 0.5])
def test_tasks_do_not_matter(rows, monkeypatch, rate):
    """Sums are exact and draws are by key, so neither the tasks nor the order of rows changes a tree."""
    alone = learn.train_one(rows, FEATURES, maxIter=4, maxDepth=5, subsamplingRate=rate)
    monkeypatch.setattr(trees, "ROWS", 1000)
    together = learn.train_one(rows.repartition(5, "month"), FEATURES, maxIter=4, maxDepth=5, subsamplingRate=rate)
    assert text_of(alone) == text_of(together)


def test_repeated_rows_are_drawn_apart(spark):
    import numpy as np

    keys = trees.numbered_keys(np.array([7, 8, 7, 7, 8]))
    assert len(set(keys.tolist())) == 5
    many = trees.numbered_keys(np.arange(20_000))
    assert trees.drawn(many, 42, 0, 0.3).mean() == pytest.approx(0.3, abs=0.02)
    assert (trees.drawn(many, 42, 0, 0.3) != trees.drawn(many, 42, 1, 0.3)).any()


def test_without_a_mounted_folder_spark_trains(rows, monkeypatch):
    monkeypatch.setattr(trees, "ROWS", 1000)
    monkeypatch.setattr(trees, "mounted", lambda spark: None)
    assert len(learn.train_one(rows, FEATURES, maxIter=2, maxDepth=2).stages[-1].trees) == 2


def test_tasks_that_share_no_folder_leave_it_to_spark(rows, monkeypatch):
    monkeypatch.setattr(trees, "ROWS", 1000)
    monkeypatch.setattr(trees, "mounted", lambda spark: "/proc/no_such_folder")
    assert len(learn.train_one(rows, FEATURES, maxIter=2, maxDepth=2).stages[-1].trees) == 2


def test_a_null_label_is_refused(rows):
    unknown = rows.withColumn("attendance", F.when(F.col("month") > 1, F.col("attendance")))
    with pytest.raises(Exception):
        learn.train_one(unknown, FEATURES, maxIter=1, maxDepth=2)


def test_features_dealt_together_cost_what_copies_cost(rows):
    model = learn.train_one(rows, FEATURES, maxIter=8, maxDepth=6)
    test = rows.withColumn("opponent_club_id", F.when(F.col("month") == 3, "new").otherwise(F.col("opponent_club_id")))
    together = {r.feature: r.delta_mae for r in learn.permutation_importance(model, test, FEATURES, buckets=3).collect()}
    copies = learn._errors_of_copies(model, learn.permuted(test, FEATURES, 42, 3), FEATURES).collect()
    whole = next(r.mae for r in copies if r.feature == "")
    assert together == pytest.approx({r.feature: r.mae - whole for r in copies if r.feature})
    assert together["is_derby"] == 0.0 and together["rank_before"] > 0
    assert learn.permutation_importance(model, test.filter("month > 50"), FEATURES).count() == 0


def test_deep_trees_score_copies(rows):
    model = learn.train_one(rows, FEATURES, maxIter=2, maxDepth=8)
    assert trees.scorer_of(model.stages[-1]) is None
    found = {r.feature: r.delta_mae for r in learn.permutation_importance(model, rows, FEATURES).collect()}
    assert set(found) == set(FEATURES) and found["rank_before"] > 0


def test_many_opponents_keep_their_bins(rows):
    """More than 256 bins take two bytes."""
    many = rows.withColumn("opponent_club_id", F.concat(F.lit("c"), (F.xxhash64("match_id") % 200).cast("string")))
    model = learn.train_one(many, FEATURES, maxIter=2, maxDepth=3)
    assert model.stages[-1].getMaxBins() > 256 and "in {" in text_of(model)
    assert config.TREES["maxIter"] == 400
