"""Logs, monitors, reports and models."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import day, one
from pyspark.sql import functions as F

from touchline import config
from touchline.operators import learn, reports, runlog

T0 = dt.datetime(2024, 6, 4, 6)


def test_run_log_opens_and_closes_one_row(spark, tmp_path):
    path = str(tmp_path / "log")
    runlog.start_stage(spark, path, "r1", "ingest", T0)
    runlog.start_stage(spark, path, "r1", "train", T0)
    runlog.start_stage(spark, path, "r2", "ingest", T0 + dt.timedelta(days=7))
    runlog.finish_stage(spark, path, "r1", "ingest", T0 + dt.timedelta(seconds=90), "success", rows_inserted=0, rows_updated=0, rows_read=5)
    runlog.finish_stage(spark, path, "r2", "ingest", T0 + dt.timedelta(days=7, seconds=5), "failed", error=ValueError("x" * 900))
    log = runlog.run_log(spark.read.parquet(path))
    rows = {(r.run_id, r.stage): r for r in log.collect()}
    assert rows["r1", "ingest"].status == "success" and rows["r1", "ingest"].duration_seconds == 90
    assert rows["r1", "train"].status == "running" and rows["r1", "train"].finished_at is None
    assert rows["r2", "ingest"].error_type == "ValueError" and len(rows["r2", "ingest"].error_message) == 900
    assert [(r.run_id, r.stage) for r in runlog.crashed_stages(log).collect()] == [("r1", "train")]
    assert [r.run_id for r in runlog.failed_stages(log).collect()] == ["r2"]
    assert [r.run_id for r in runlog.stale_green_runs(log).collect()] == ["r1"]
    assert [r.rows_read for r in runlog.freshness_history(log).collect()] == [5]


def test_check_flips(spark):
    rows = [("r1", "a", True, 1), ("r2", "a", False, 8), ("r3", "a", False, 15), ("r1", "b", False, 1), ("r2", "b", True, 8), ("r3", "b", False, 15)]
    df = spark.createDataFrame([(*r[:3], T0 + dt.timedelta(days=r[3])) for r in rows], "run_id string, check_name string, passed boolean, checked_at timestamp")
    assert {(r.check_name, r.run_id) for r in runlog.check_flips(df).collect()} == {("a", "r2"), ("b", "r3")}


def test_stage_metadata(spark, tiny_season):
    got = one(runlog.stage_metadata(tiny_season.withColumn("attendance", F.when(F.col("match_id") != "m1", 1))))
    assert (got.rows_read, got.seasons, got.max_match_date) == (6, "[2024]", day("2024-03-16"))
    assert got.null_attendance_pct == pytest.approx(100 / 6)


def test_coverage(spark):
    values = ["10", "30", "20", "40", "0", "-1", "", None, "N/A", "50"]
    df = spark.createDataFrame([(v, v) for v in values], "attendance string, Crowd_size string")
    assert reports.find_fields(df) == ["attendance", "Crowd_size"]
    got = {r.field: r for r in reports.coverage_gate(df, threshold=0.5).collect()}
    r = got["attendance"]
    assert (r.populated, r.total, r.share, r.min, r.median, r.max, r.usable) == (5, 10, 0.5, 10.0, 30.0, 50.0, True)
    assert not one(reports.coverage_gate(df, ["attendance"])).usable
    even = spark.createDataFrame([("1",), ("2",), ("3",), ("4",)], "attendance string")
    assert one(reports.coverage_gate(even)).median == 3.0  # the upper of the two middle values
    present = {r.field: (r.present, r.total) for r in reports.null_coverage(df, ["attendance"]).collect()}
    assert present == {"attendance": (7, 10)}
    empty = spark.createDataFrame([(None,)], "attendance string")
    assert one(reports.coverage_gate(empty)).populated == 0


def test_decay(spark):
    rows = [("a", 2024, -1, 100, False), ("a", 2024, -1, 300, False), ("a", 2024, 0, 100, False), ("a", 2024, 1, 50, False),
            ("b", 2024, -1, 10, False), ("b", 2024, 0, 10, False), ("b", 2024, 0, 999, True)]
    df = spark.createDataFrame(rows, "home_club_id string, season int, matches_since_elimination int, attendance int, is_covid_affected boolean")
    got = {r.matches_since_elimination: (r.n, r.index_vs_own_baseline) for r in reports.decay_curve(df).collect()}
    assert got == {0: (2, 0.75), 1: (1, 0.25)}
    week = df.withColumn("date", F.lit(day("2024-09-04")))
    r = one(reports.decay_vs_live(week))
    assert (r.week, r.n_eliminated, r.n_live, r.difference) == (day("2024-09-02"), 3, 3, pytest.approx(160 / 3 - 410 / 3))


def test_bands_and_comparison(spark):
    rows = [(f"m{k}", "baseline", 100.0, 100.0 + k) for k in range(11)] + [("f", "baseline", 200.0, None)]
    preds = spark.createDataFrame(rows, "match_id string, model_name string, predicted double, actual double")
    band = reports.residual_band(preds)
    r = one(band)
    assert (r.n, r.mae, r.low, r.high) == (11, 5.0, 1.0, 9.0)
    f = one(reports.forecast_band(preds.filter("actual is null"), band))
    assert (f.predicted_low, f.predicted_high) == (201.0, 209.0)
    metrics = spark.createDataFrame(
        [(m, day(f"2024-01-{d:02d}"), e) for d, b, p in ((1, 10.0, 8.0), (8, 10.0, 11.0), (15, 10.0, 7.0)) for m, e in (("baseline", b), ("prorel", p))],
        "model_name string, run_date date, mae double",
    )
    c = one(reports.compare_models(metrics))
    assert (c.runs, c.prorel_wins, c.median_gap) == (3, 2, 2.0)
    history = {(r.model_name, r.run_date.day): (r.mae_change, r.gap_sign) for r in reports.metric_history(metrics).collect()}
    assert history["prorel", 8] == (3.0, -1) and history["prorel", 1] == (None, 1)


def test_projection(spark):
    fixtures = spark.createDataFrame([("a", 2024, "x", 100), ("b", 2024, "x", None), ("c", 2024, "x", None)], "match_id string, season int, home_club_id string, attendance int")
    preds = spark.createDataFrame([("a", 90.0), ("b", 50.0)], "match_id string, predicted double")
    r = one(reports.gate_projection(fixtures, preds))
    assert (r.home_matches, r.recorded, r.to_date, r.projected) == (3, 1, 100.0, 150.0)


@pytest.fixture(scope="module")
def mart(spark):
    """Gates that depend on the club and its rank; one feature is constant."""
    rng, rows = random.Random(3), []
    for k in range(400):
        date = dt.date(2024, 3, 1) + dt.timedelta(k // 2)
        club, rank = f"c{k % 5}", rng.randint(1, 10)
        row = dict.fromkeys(config.MODELS["prorel"], 0) | {
            "rank_before": rank, "opponent_club_id": f"c{(k + 1) % 5}", "last_home_gate": None if k < 5 else 1000 * (k % 5),
            "match_id": f"m{k:03d}", "season": 2024, "date": date, "home_club_id": club,
            "attendance": 2000 + 1000 * (k % 5) - 100 * rank + rng.randint(-9, 9), "is_covid_affected": k < 40,
        }
        rows.append(row)
    schema = "match_id string, season int, date date, home_club_id string, attendance int, is_covid_affected boolean, " + ", ".join(
        f"{c} {'string' if c == 'opponent_club_id' else 'int'}" for c in config.MODELS["prorel"]
    )
    return spark.createDataFrame([tuple(r[f.split()[0]] for f in schema.split(", ")) for r in rows], schema).cache()


def test_training(spark, mart):
    frame = learn.training_frame(mart)
    assert frame.count() == 360 and learn.training_frame(mart, drop_covid=False).count() == 400
    result = learn.train_all(mart, day("2024-12-01"), maxIter=5, maxDepth=3)
    metrics = {r.model_name: r for r in result["model_metrics"].collect()}
    assert set(metrics) == {"naive_club_mean", "baseline", "prorel"}
    assert all((m.n_train, m.n_test) == (288, 72) for m in metrics.values())
    assert metrics["prorel"].mae < metrics["baseline"].mae
    gains = {(r.model_name, r.feature): r for r in result["feature_importance"].collect()}
    assert len(gains) == 13 + 20 and gains["prorel", "points_from_relegation_line"].importance == 0.0
    assert gains["prorel", "rank_before"].importance > 0 and gains["prorel", "rank_before"].is_prorel
    assert result["predictions"].count() == 3 * 72
    top = reports.top_features(result["feature_importance"], 3)
    assert top.count() == 6


def test_permutation_importance_finds_the_used_feature(mart):
    train, test = learn.chronological_split(learn.training_frame(mart))
    features = ("rank_before", "month", "last_home_gate")
    model = learn.train_one(train, features, maxIter=5, maxDepth=3)
    got = {r.feature: r.delta_mae for r in learn.permutation_importance(model, test, features).collect()}
    assert set(got) == set(features) and got["month"] == 0.0 and got["rank_before"] > 0


def test_permutation_takes_one_exchange(mart):
    """Every feature's copy has its values from the deal of that column alone, and all come from one window."""
    features = ["rank_before", "month", "last_home_gate"]
    together = learn.permuted(mart, features, 7, 4)
    plan = together._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    columns = ["match_id", *features]
    for f in features:
        alone = {tuple(r) for r in learn.shuffled(mart, f, 7, 4).select(columns).collect()}
        assert {tuple(r) for r in together.filter(F.col("feature") == f).select(columns).collect()} == alone
    assert {tuple(r) for r in together.filter("feature = ''").select(columns).collect()} == {tuple(r) for r in mart.select(columns).collect()}


def test_stored_models_score_alike(spark, mart, tmp_path):
    marked = learn.split_rows(mart)
    models = learn.fit_models(marked, maxIter=2, maxDepth=2)
    _, test = learn.parts_of(marked)
    for name, model in models.items():
        path = learn.stored(model, spark, str(tmp_path / name))
        scored = [
            sorted(tuple(r) for r in learn.score(m, test, config.MODELS[name], name, day("2024-12-01")).collect())
            for m in (model, learn.read_model(path))
        ]
        assert scored[0] == scored[1]


def test_fits_of_one_pool_equal_single_fits(mart):
    """Jobs in threads share nothing: each fit is what it would be alone, with its own settings."""
    features = ("rank_before", "last_home_gate")
    jobs = {seed: (mart, features, {"seed": seed, "subsamplingRate": 0.5}) for seed in (1, 2, 3)}
    together = learn.fit_all(jobs, 3, maxIter=2, maxDepth=2)
    for seed, model in together.items():
        alone = learn.train_one(mart, features, maxIter=2, maxDepth=2, seed=seed, subsamplingRate=0.5)
        assert model.stages[-1].toDebugString.split("\n", 1)[1] == alone.stages[-1].toDebugString.split("\n", 1)[1]
    with pytest.raises(Exception):
        learn.fit_all({"bad": (mart, ("no_such_column",))}, 2, maxIter=1, maxDepth=1)


def test_sweeps(mart):
    swept = learn.seed_sweep(mart, (1, 2), day("2024-12-01"), maxIter=2, maxDepth=2, subsamplingRate=0.7).collect()
    assert {(r.seed, r.model_name, r.run_date) for r in swept} == {
        (s, m, day(f"2024-12-0{s}")) for s in (1, 2) for m in ("naive_club_mean", "baseline", "prorel")
    }
    assert len({r.mae for r in swept if r.model_name == "naive_club_mean"}) == 1
    alone = {r.model_name: r.mae for r in learn.train_all(
        mart, day("2024-12-02"), seed=2, maxIter=2, maxDepth=2, subsamplingRate=0.7)["model_metrics"].collect()}
    assert {r.model_name: r.mae for r in swept if r.seed == 2} == pytest.approx(alone)
    both = learn.covid_sensitivity(mart, day("2024-12-01"), maxIter=1, maxDepth=1).collect()
    assert {(r.drop_covid, r.n_train + r.n_test) for r in both} == {(True, 360), (False, 400)} and len(both) == 6


def test_folds_of_the_naive_model(mart):
    """One pass gives what filtering each fold gives; a club new to a season has the overall mean."""
    season = F.col("season") - F.substring("match_id", 4, 1).cast("int") % 3
    club = F.when(season == 2024, F.coalesce(F.nullif("home_club_id", F.lit("c0")), F.lit("new"))).otherwise(F.col("home_club_id"))
    seasons = mart.withColumns({"season": season, "home_club_id": club}).cache()
    found = {r.season: r for r in learn.fold_metrics(seasons).collect()}
    for fold, train, test in learn.season_folds(seasons):
        alone = one(learn.error_metrics(learn.naive_club_mean(train, test, day("2024-01-01")), train.count()))
        r = found.pop(fold)
        assert (r.mae, r.mape, r.rmse) == pytest.approx((alone.mae, alone.mape, alone.rmse))
        assert (r.n_train, r.n_test) == (alone.n_train, alone.n_test)
    assert not found
    models = {(r.season, r.model_name): r for r in learn.fold_models(seasons, maxIter=3, maxDepth=3).collect()}
    assert len(models) == 6 and all(models[s, "naive_club_mean"].n_train == models[s, "prorel"].n_train for s in (2023, 2024))
    for s in (2023, 2024):
        assert models[s, "naive_club_mean"].gain == pytest.approx(models[s, "baseline"].mae - models[s, "prorel"].mae)


def test_too_many_opponents_are_refused(mart, monkeypatch):
    monkeypatch.setattr(learn, "MOST_CLUBS", 4)
    with pytest.raises(ValueError, match="more than 4"):
        learn.train_one(mart, config.MODELS["baseline"], maxIter=1, maxDepth=1)


def test_dealing_keeps_the_values(mart):
    dealt = learn.shuffled(mart, "attendance", 1, 4)
    a, b = ([r[0] for r in df.select("attendance").orderBy("attendance").collect()] for df in (mart, dealt))
    assert a == b
    moved = mart.select("match_id", "attendance").exceptAll(dealt.select("match_id", "attendance")).count()
    assert moved > 350


def test_unseen_club_gets_the_overall_mean(spark):
    schema = "match_id string, home_club_id string, attendance int"
    train = spark.createDataFrame([("a", "x", 100), ("b", "x", 200), ("c", "y", 600)], schema)
    test = spark.createDataFrame([("d", "x", 1), ("e", "new", None)], schema)
    got = {r.match_id: (r.predicted, r.actual) for r in learn.naive_club_mean(train, test, day("2024-01-01")).collect()}
    assert got == {"d": (150.0, 1.0), "e": (300.0, None)}


def test_error_metrics(spark):
    rows = [("m", day("2024-01-01"), 110.0, 100.0), ("m", day("2024-01-01"), 80.0, 100.0), ("m", day("2024-01-01"), 5.0, 0.0), ("m", day("2024-01-01"), 5.0, None)]
    r = one(learn.error_metrics(spark.createDataFrame(rows, "model_name string, run_date date, predicted double, actual double"), 7))
    assert (r.mae, r.mape, r.n_train, r.n_test) == (pytest.approx(35 / 3), pytest.approx(0.15), 7, 3)
    assert r.rmse == pytest.approx(((100 + 400 + 25) / 3) ** 0.5)


def test_folds_expand(spark, mart):
    seasons = mart.select("match_id", (F.col("season") - F.substring("match_id", 4, 1).cast("int") % 3).alias("season"))
    folds = [(s, train.count(), test.count()) for s, train, test in learn.season_folds(seasons)]
    assert folds == [tuple(r) for r in learn.fold_sizes(seasons).select("season", "n_train", "n_test").orderBy("season").collect()]
    assert [f[0] for f in folds] == [2023, 2024] and folds[1][1] == folds[0][1] + folds[0][2]


def test_unseen_opponent_and_missing_lag_are_scored(spark, mart):
    features = config.MODELS["baseline"]
    model = learn.train_one(mart, features, maxIter=2, maxDepth=2)
    fixtures = mart.limit(2).withColumns({"opponent_club_id": F.lit("brand_new"), "attendance": F.lit(None).cast("int")})
    scored = learn.score(model, fixtures, features, "baseline", day("2024-12-01")).collect()
    assert len(scored) == 2 and all(r.actual is None and r.predicted is not None for r in scored)
    filled = learn.fill_actuals(learn.score(model, fixtures, features, "baseline", day("2024-12-01")), mart)
    assert filled.filter("actual is null").count() == 0
