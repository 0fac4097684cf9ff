"""Training, scoring and comparing the attendance models."""

from __future__ import annotations

import datetime as dt
from collections.abc import Hashable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.config import EVIDENCE, MODELS, PROREL, TARGET, TEST_FRACTION, TREES
from touchline.operators.ordered import UNBOUNDED, numbered
from touchline.operators.trees import GBTRegressor, Scorer, errors_with_others, scorer_of
from touchline.session import scratch_path, stage

CLUB = "opponent_club_id"
#: Fits submitted at once. A tree is a chain of small jobs, so one fit leaves most of a cluster idle.
PARALLEL = 8
#: Clubs that trees can tell apart: their labels are on the driver, and a histogram has as many bins.
MOST_CLUBS = 10_000


def feature_catalog(spark: SparkSession) -> DataFrame:
    """Each feature's evidence class and whether only the larger model has it."""
    rows = [(f, EVIDENCE[f], f in PROREL) for f in MODELS["prorel"]]
    return spark.createDataFrame(rows, "feature string, evidence string, is_prorel boolean")


def select_features(mart: DataFrame, model: str) -> DataFrame:
    """Keys, target and the model's columns; nothing else differs between the models."""
    return mart.select("match_id", "date", "home_club_id", TARGET, *MODELS[model])


def training_frame(mart: DataFrame, drop_covid: bool = True) -> DataFrame:
    """Rows with a known target; the switch decides about the affected period only."""
    rows = mart.filter(F.col(TARGET).isNotNull())
    return rows.filter(~F.col("is_covid_affected")) if drop_covid else rows


def with_split(df: DataFrame, fraction: float = TEST_FRACTION) -> DataFrame:
    """Add ``part``: the latest ``fraction`` of rows by (date, match_id) is "test".

    The cut is found on one count per date; only the rows of the date it falls on are numbered.
    """
    by_date = df.groupBy("date").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.orderBy("date").rowsBetween(UNBOUNDED, 0))
    total = F.sum("n").over(Window.partitionBy())
    train_rows = F.floor(total * F.lit(1 - fraction)).cast("bigint")
    cut = (
        by_date.select("date", "n", upto.alias("upto"), train_rows.alias("wanted"))
        .filter("upto >= wanted").orderBy("date").limit(1)
        .select("date", (F.col("wanted") - (F.col("upto") - F.col("n"))).alias("room")).first()
    )
    if cut is None:
        return df.withColumn("part", F.lit("train"))
    day = F.lit(cut.date)
    others = df.filter(F.col("date") != day).withColumn(
        "part", F.when(F.col("date") < day, "train").otherwise("test")
    )
    border = numbered(df.filter(F.col("date") == day), ["date"], "match_id", name="_at").withColumn(
        "part", F.when(F.col("_at") <= cut.room, "train").otherwise("test")
    )
    return others.unionByName(border.select(others.columns))


def chronological_split(df: DataFrame, fraction: float = TEST_FRACTION) -> tuple[DataFrame, DataFrame]:
    marked = with_split(df, fraction)
    return tuple(marked.filter(F.col("part") == p).drop("part") for p in ("train", "test"))


def season_folds(df: DataFrame) -> Iterable[tuple[int, DataFrame, DataFrame]]:
    """Expanding window: train on the seasons before each one, test on it."""
    seasons = sorted(r.season for r in df.select("season").distinct().collect())
    for season in seasons[1:]:
        yield season, df.filter(F.col("season") < season), df.filter(F.col("season") == season)


def fold_sizes(df: DataFrame) -> DataFrame:
    """Training and test rows of every fold."""
    before = F.sum("n_test").over(Window.orderBy("season").rowsBetween(UNBOUNDED, -1))
    return (
        df.groupBy("season").agg(F.count("*").alias("n_test"))
        .withColumn("n_train", before).filter("n_train is not null")
        .select("season", "n_train", "n_test")
    )


def naive_folds(rows: DataFrame) -> DataFrame:
    """``season``, ``match_id``, ``predicted``, ``actual``, ``n_train``: the naive model on every expanding-window fold, in one pass.

    A club's mean over all earlier seasons is a running sum over its seasons, so no fold is filtered
    out of the table again; without an earlier season the mean of all clubs' earlier gates stands in. The
    first season has nothing to learn from and is no fold.
    """
    known = rows.filter(F.col(TARGET).isNotNull()).select("season", "match_id", "home_club_id", F.col(TARGET).cast("double").alias("actual"))
    by_club = stage(known.groupBy("season", "home_club_id").agg(F.sum("actual").alias("s"), F.count("*").alias("n")), "club-seasons")
    earlier = Window.partitionBy("home_club_id").orderBy("season").rowsBetween(UNBOUNDED, -1)
    own = by_club.select("season", "home_club_id", (F.sum("s").over(earlier) / F.sum("n").over(earlier)).alias("own"))
    # One row per season.
    upto = Window.orderBy("season").rowsBetween(UNBOUNDED, -1)
    every = by_club.groupBy("season").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).select(
        "season", (F.sum("s").over(upto) / F.sum("n").over(upto)).alias("all"), F.sum("n").over(upto).alias("n_train")
    )
    means = stage(own.join(every.filter("n_train is not null"), "season"), "fold-means")
    return known.join(means, ["season", "home_club_id"]).select(
        "season", "match_id", F.coalesce("own", "all").alias("predicted"), "actual", "n_train"
    )


def fold_metrics(rows: DataFrame) -> DataFrame:
    """The naive model's errors on every fold: ``season``, ``mae``, ``mape``, ``rmse``, ``n_train``, ``n_test``."""
    return _fold_errors(naive_folds(rows), "season")


def _fold_errors(predictions: DataFrame, *by: str) -> DataFrame:
    error = F.col("predicted") - F.col("actual")
    return predictions.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("mae"), F.avg(F.abs(error / F.nullif("actual", F.lit(0.0)))).alias("mape"),
        F.sqrt(F.avg(error * error)).alias("rmse"), F.max("n_train").alias("n_train"), F.count("*").alias("n_test"),
    )


def fold_models(rows: DataFrame, parallel: int = PARALLEL, **trees: object) -> DataFrame:
    """Errors of the naive model and of both tree models on every fold, and how much smaller the larger model's MAE is.

    ``season``, ``model_name``, ``mae``, ``mape``, ``rmse``, ``n_train``, ``n_test``, ``gain`` (baseline's MAE less
    prorel's, the same in a fold's rows). All fits of all folds are submitted together.
    """
    known = stage(rows.filter(F.col(TARGET).isNotNull()), "fold-rows")
    folds = list(season_folds(known))
    models = fit_all({(season, m): (train, MODELS[m]) for season, train, _ in folds for m in MODELS}, parallel, **trees)
    scored = naive_folds(known).withColumn("model_name", F.lit("naive_club_mean"))
    sizes = stage(fold_sizes(known), "fold-sizes")
    for season, _, test in folds:
        for m, features in MODELS.items():
            found = score(models[season, m], test, features, m, dt.date(1970, 1, 1)).withColumn("season", F.lit(season))
            found = found.join(sizes.select("season", "n_train"), "season")
            scored = scored.unionByName(found.select("season", "match_id", "predicted", "actual", "n_train", "model_name"))
    errors = stage(_fold_errors(scored, "season", "model_name"), "fold-errors")
    gain = errors.groupBy("season").agg(
        (F.max(F.when(F.col("model_name") == "baseline", F.col("mae"))) - F.max(F.when(F.col("model_name") == "prorel", F.col("mae")))).alias("gain")
    )
    return errors.join(gain, "season")


def model_input(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """Numbers for the trees: flags as 0/1, missing lags as -1, the opponent stays text."""
    numeric = [F.coalesce(F.col(c).cast("double"), F.lit(-1.0)).alias(c) for c in features if c != CLUB]
    club = [F.col(CLUB)] if CLUB in features else []
    others = [F.col(c) for c in rows.columns if c not in features]
    return rows.select(*others, *club, *numeric)


def train_one(train: DataFrame, features: Sequence[str], **trees: object) -> PipelineModel:
    """Fit boosted trees on a column list. More than MOST_CLUBS opponents are an error: group the rare ones first."""
    params = {**TREES, **trees}
    stages, columns = [], list(features)
    if CLUB in features:
        indexer = StringIndexer(inputCol=CLUB, outputCol="_club", handleInvalid="keep")
        columns[columns.index(CLUB)] = "_club"
        if train.select(CLUB).distinct().limit(MOST_CLUBS + 1).count() > MOST_CLUBS:
            raise ValueError(f"more than {MOST_CLUBS} values of {CLUB}")
        indexed = indexer.fit(train)
        stages.append(indexed)
        params.setdefault("maxBins", max(32, len(indexed.labels) + 1))
    stages.append(VectorAssembler(inputCols=columns, outputCol="_features"))
    stages.append(GBTRegressor(featuresCol="_features", labelCol=TARGET, predictionCol="predicted", **params))
    return Pipeline(stages=stages).fit(model_input(train, features))


def fit_all(
    jobs: Mapping[Hashable, tuple[DataFrame, Sequence[str]] | tuple[DataFrame, Sequence[str], dict]], parallel: int = PARALLEL, **trees: object
) -> dict[Hashable, PipelineModel]:
    """Independent fits, each of (rows, features) or (rows, features, its own tree settings), ``parallel`` at a time.

    Rows should be staged: every fit reads them. Fits run in threads of the driver, which only submit jobs; each
    has the session's properties and a scheduler pool of its own, so under a fair scheduler none waits for another.
    """
    def fit(key: Hashable, train: DataFrame, features: Sequence[str], own: dict | None = None) -> PipelineModel:
        context = train.sparkSession.sparkContext
        context.setLocalProperty("spark.scheduler.pool", f"fit-{key}")
        try:
            return train_one(train, features, **{**trees, **(own or {})})
        finally:
            context.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max(1, min(parallel, len(jobs) or 1))) as pool:
        running = {}
        for key, job in jobs.items():
            running[key] = pool.submit(inheritable_thread_target(job[0].sparkSession)(fit), key, *job)
        return {key: each.result() for key, each in running.items()}


def stored(model: PipelineModel, spark: SparkSession, path: str | None = None) -> str:
    """Write a fitted model to shared storage (new scratch by default) and return where; ``read_model`` gives it back."""
    path = path or scratch_path(spark, "model")
    model.write().overwrite().save(path)
    return path


def read_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, rows: DataFrame, features: Sequence[str], name: str, run_date: dt.date) -> DataFrame:
    """Predictions in the history layout; ``actual`` is null until the match is played."""
    return model.transform(model_input(rows, features)).select(
        "match_id", F.lit(name).alias("model_name"), F.lit(run_date).alias("run_date"),
        "predicted", F.col(TARGET).cast("double").alias("actual"),
    )


def fill_actuals(predictions: DataFrame, matches: DataFrame) -> DataFrame:
    """Fill in the gates of predicted matches played since."""
    known = matches.select("match_id", F.col(TARGET).cast("double").alias("_known"))
    return (
        predictions.join(known, "match_id", "left")
        .withColumn("actual", F.coalesce("actual", "_known")).drop("_known")
    )


def naive_club_mean(train: DataFrame, test: DataFrame, run_date: dt.date) -> DataFrame:
    """A club's mean training gate; the overall mean for a club not seen in training."""
    means = stage(train.groupBy("home_club_id").agg(
        F.avg(TARGET).alias("_mean"), F.sum(TARGET).alias("_sum"), F.count(TARGET).alias("_n")
    ), "club-means")
    overall = means.agg((F.sum("_sum") / F.sum("_n")).alias("m")).first().m
    return test.join(means.select("home_club_id", "_mean"), "home_club_id", "left").select(
        "match_id", F.lit("naive_club_mean").alias("model_name"), F.lit(run_date).alias("run_date"),
        F.coalesce("_mean", F.lit(overall)).alias("predicted"), F.col(TARGET).cast("double").alias("actual"),
    )


def error_metrics(predictions: DataFrame, n_train: Column | int | None = None) -> DataFrame:
    """MAE, MAPE and RMSE per model and run; a zero actual has no percentage error."""
    error = F.col("predicted") - F.col("actual")
    share = F.abs(error / F.nullif("actual", F.lit(0.0)))
    return predictions.filter("actual is not null").groupBy("model_name", "run_date").agg(
        F.avg(F.abs(error)).alias("mae"), F.avg(share).alias("mape"), F.sqrt(F.avg(error * error)).alias("rmse"),
        F.lit(n_train).cast("int").alias("n_train"), F.count("*").cast("int").alias("n_test"),
    )


def importance(model: PipelineModel, features: Sequence[str], name: str, run_date: dt.date, spark: SparkSession) -> DataFrame:
    """Gain importance of every feature, zeros included."""
    gains = model.stages[-1].featureImportances.toArray()
    rows = [(name, run_date, f, float(g), f in PROREL) for f, g in zip(features, gains)]
    return spark.createDataFrame(
        rows, "model_name string, run_date date, feature string, importance double, is_prorel boolean"
    )


def shuffled(rows: DataFrame, column: str, seed: int, buckets: int) -> DataFrame:
    """Deal one column's values to other rows at random.

    Rows fall into random buckets; within one, in another random order, every row takes the
    value of the next. No row order of the whole table is needed.
    """
    order = Window.partitionBy("_bucket").orderBy("_draw", "match_id")
    wrapped = F.first(F.struct(column)).over(order.rowsBetween(UNBOUNDED, Window.unboundedFollowing))
    following = F.coalesce(F.lead(F.struct(column)).over(order), wrapped)
    return (
        rows.withColumns({
            "_bucket": F.pmod(F.xxhash64("match_id", F.lit(seed)), F.lit(buckets)),
            "_draw": F.xxhash64(F.lit(seed), "match_id"),
        })
        .withColumn("_dealt", following)
        .withColumn(column, F.col(f"_dealt.{column}"))
        .drop("_bucket", "_draw", "_dealt")
    )


def permuted(rows: DataFrame, features: Sequence[str], seed: int, buckets: int) -> DataFrame:
    """Every row once as it is (``feature`` is empty) and once per feature with that feature's value dealt from another row.

    The copies are made behind the window of ``dealt``, so there is one exchange whatever the number of features.
    """
    others = [c for c in rows.columns if c not in features]
    copies = dealt(rows, features, seed, buckets).withColumn("feature", F.explode(F.array(F.lit(""), *[F.lit(f) for f in features])))
    return copies.select(
        "feature", *others, *[F.when(F.col("feature") == f, F.col(f"_dealt.{f}")).otherwise(F.col(f)).alias(f) for f in features]
    )


def dealt(rows: DataFrame, features: Sequence[str], seed: int, buckets: int) -> DataFrame:
    """Rows with ``_dealt``: all features of the next row in the bucket, as ``shuffled`` deals one column."""
    order = Window.partitionBy("_bucket").orderBy("_draw", "match_id")
    values = F.struct(*features)
    wrapped = F.first(values).over(order.rowsBetween(UNBOUNDED, Window.unboundedFollowing))
    return rows.withColumns({
        "_bucket": F.pmod(F.xxhash64("match_id", F.lit(seed)), F.lit(buckets)), "_draw": F.xxhash64(F.lit(seed), "match_id"),
    }).withColumn("_dealt", F.coalesce(F.lead(values).over(order), wrapped)).drop("_bucket", "_draw")


def permutation_importance(
    model: PipelineModel, test: DataFrame, features: Sequence[str], seed: int = 42, buckets: int = 8
) -> DataFrame:
    """Rise of the holdout's MAE when one feature is dealt out at random.

    Values are dealt within ``buckets`` parts of the holdout: as many as it takes for a part to fit a task.
    All features are dealt by one exchange and scored together; trees of more than 64 leaves score a copy per feature.
    """
    test, scorer = test.filter(F.col(TARGET).isNotNull()), scorer_of(model.stages[-1])
    if scorer:
        errors = _errors_together(model, scorer, dealt(test, features, seed, buckets), features)
    else:
        errors = _errors_of_copies(model, permuted(test, features, seed, buckets), features)
    base = errors.filter("feature = ''").first()
    return errors.filter("feature <> ''").select("feature", (F.col("mae") - F.lit(base.mae if base else None)).alias("delta_mae"))


# Decimals add up to the same sum in any order, so a feature the model does not use costs exactly nothing.
ERROR = "decimal(28,12)"


def _errors_of_copies(model: PipelineModel, copies: DataFrame, features: Sequence[str]) -> DataFrame:
    scored = model.transform(model_input(copies, features))
    error = F.abs(F.col("predicted") - F.col(TARGET).cast("double")).cast(ERROR)
    return stage(scored.groupBy("feature").agg(F.avg(error).cast("double").alias("mae")), "permuted")


def _errors_together(model: PipelineModel, scorer: Scorer, rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """The same from one row of each match, with its own and its dealt features as the model's vectors."""
    vectors, column = PipelineModel(model.stages[:-1]), model.stages[-1].getFeaturesCol()

    def with_vector(given: DataFrame, name: str) -> DataFrame:
        seen = vectors.transform(model_input(given, features))
        return seen.select("label", "_dealt", *[c for c in ("own",) if c in given.columns], *features, vector_to_array(F.col(column)).alias(name))

    own = with_vector(rows.select(F.col(TARGET).cast("double").alias("label"), "_dealt", *features), "own")
    other = with_vector(own.select("label", "own", "_dealt", "_dealt.*"), "other")
    found = errors_with_others(other.select("label", "own", "other"), scorer, len(features))
    means = found.agg(*[F.avg(F.col(f"e{k}").cast(ERROR)).cast("double").alias(f"e{k}") for k in range(len(features) + 1)])
    told = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"e{k}").alias("mae")) for k, f in enumerate(("", *features))])
    return stage(means.select(F.inline(told)).filter("mae is not null"), "permuted")


def split_rows(mart: DataFrame, drop_covid: bool = True) -> DataFrame:
    """Training rows with their ``part``. Stored: every fit and score reads them."""
    return stage(with_split(training_frame(mart, drop_covid)), "split")


def parts_of(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    return tuple(marked.filter(F.col("part") == p) for p in ("train", "test"))


def gains_of(models: Mapping[str, PipelineModel], run_date: dt.date, spark: SparkSession) -> DataFrame:
    """Importances of all models, by name."""
    tables = [importance(model, MODELS[name], name, run_date, spark) for name, model in models.items()]
    found = tables[0]
    for table in tables[1:]:
        found = found.unionByName(table)
    return found


def results(marked: DataFrame, models: Mapping[str, PipelineModel], run_date: dt.date) -> dict[str, DataFrame]:
    """Predictions, metrics and importances of fitted ``models`` and the naive one on the split rows ``marked``."""
    train, test = parts_of(marked)
    predictions = naive_club_mean(train, test, run_date)
    for name, model in models.items():
        predictions = predictions.unionByName(score(model, test, MODELS[name], name, run_date))
    predictions = stage(predictions, "predictions")
    return {
        "predictions": predictions, "model_metrics": error_metrics(predictions, train.count()),
        "feature_importance": gains_of(models, run_date, marked.sparkSession),
    }


def fit_models(marked: DataFrame, names: Iterable[str] = tuple(MODELS), **trees: object) -> dict[str, PipelineModel]:
    """The named models, fitted at once on the training part of split rows."""
    train, _ = parts_of(marked)
    return fit_all({name: (train, MODELS[name]) for name in names}, **trees)


def train_all(mart: DataFrame, run_date: dt.date, drop_covid: bool = True, **trees: object) -> dict[str, DataFrame]:
    """Naive, baseline and larger model on one split: predictions, metrics, importance."""
    marked = split_rows(mart, drop_covid)
    return results(marked, fit_models(marked, **trees), run_date)


def seed_sweep(mart: DataFrame, seeds: Sequence[int], first_date: dt.date, parallel: int = PARALLEL, **trees: object) -> DataFrame:
    """Metrics of repeated trainings, one run date per seed.

    The split and the naive model are the same for all seeds and are made once; all fits are submitted together.
    """
    marked = split_rows(mart)
    train, test = parts_of(marked)
    models = fit_all({(seed, m): (train, MODELS[m], {"seed": seed}) for seed in seeds for m in MODELS}, parallel, **trees)
    days = {seed: first_date + dt.timedelta(days=k) for k, seed in enumerate(seeds)}
    naive = stage(naive_club_mean(train, test, first_date), "naive")
    swept = None
    for seed, day in days.items():
        found = naive.withColumn("run_date", F.lit(day))
        for m, features in MODELS.items():
            found = found.unionByName(score(models[seed, m], test, features, m, day))
        swept = found if swept is None else swept.unionByName(found)
    seed_of = F.create_map(*[F.lit(v) for seed, day in days.items() for v in (day, seed)])
    return error_metrics(swept, train.count()).withColumn("seed", F.element_at(seed_of, F.col("run_date")))


def covid_sensitivity(mart: DataFrame, run_date: dt.date, parallel: int = PARALLEL, **trees: object) -> DataFrame:
    """Metrics with and without the affected period; all fits are submitted together."""
    marked = {flag: split_rows(mart, flag) for flag in (True, False)}
    models = fit_all({(flag, m): (parts_of(rows)[0], MODELS[m]) for flag, rows in marked.items() for m in MODELS}, parallel, **trees)
    runs = [
        results(rows, {m: models[flag, m] for m in MODELS}, run_date)["model_metrics"].withColumn("drop_covid", F.lit(flag))
        for flag, rows in marked.items()
    ]
    return runs[0].unionByName(runs[1])
