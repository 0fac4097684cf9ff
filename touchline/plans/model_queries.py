"""Training, scoring and comparison of the models.

Tree training has no SQL counterpart, so queries return what SQL can state of it: which rows are
predicted, that predictions are finite numbers, how importances add up, how errors are ordered. The
queries fit the operators' defaults, 400 trees of depth 6, as the weekly run does (README has the
figures); a fitted model is stored, and read back by the other queries of a session.
"""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.config import MODELS
from touchline.operators import learn, reports
from touchline.plans import binding as b
from touchline.plans.oracle import sql
from touchline.plans.registry import query

SPLIT = """
split AS (
  SELECT *, CASE WHEN ROW_NUMBER() OVER (ORDER BY date, match_id) <= floor(COUNT(*) OVER () * 0.8::DOUBLE)
    THEN 'train' ELSE 'test' END AS part
  FROM mart WHERE attendance IS NOT NULL AND NOT is_covid_affected
)"""


def split_rows(spark: SparkSession, sf: str) -> DataFrame:
    return b.built(spark, sf, "split_rows", lambda: learn.split_rows(b.mart(spark, sf)))


def fitted(spark: SparkSession, sf: str, *names: str) -> dict[str, PipelineModel]:
    """The named models, each fitted and stored once per session; what is missing is fitted at once."""
    paths = b.kept(spark, sf, "models", dict)
    missing = [name for name in names if name not in paths]
    if missing:
        for name, model in learn.fit_models(split_rows(spark, sf), missing).items():
            paths[name] = learn.stored(model, spark)
    return {name: learn.read_model(paths[name]) for name in names}


@query(sql("SELECT match_id, part FROM split", SPLIT))
def chronological_split(spark: SparkSession, sf: str) -> DataFrame:
    return learn.with_split(learn.training_frame(b.mart(spark, sf))).select("match_id", "part")


@query(sql("""
SELECT a.season, a.n AS n_test, CAST(SUM(b.n) AS BIGINT) AS n_train
FROM (SELECT season, COUNT(*) AS n FROM mart GROUP BY 1) a JOIN (SELECT season, COUNT(*) AS n FROM mart GROUP BY 1) b
  ON b.season < a.season GROUP BY ALL"""))
def season_folds(spark: SparkSession, sf: str) -> DataFrame:
    return learn.fold_sizes(b.mart(spark, sf))


@query(sql("""
SELECT season, round(AVG(abs(predicted - actual)), 4) AS mae, round(AVG(abs((predicted - actual) / NULLIF(actual, 0))), 6) AS mape,
  round(sqrt(AVG((predicted - actual) * (predicted - actual))), 4) AS rmse, n_train, COUNT(*) AS n_test
FROM fold GROUP BY season, n_train""", """
fold AS (
  SELECT t.season, CAST(t.attendance AS DOUBLE) AS actual, CAST(a.n AS BIGINT) AS n_train, COALESCE(
    (SELECT AVG(attendance) FROM mart c WHERE c.home_club_id = t.home_club_id AND c.season < t.season AND NOT c.is_covid_affected), a.m) AS predicted
  FROM mart t JOIN (SELECT s.season, COUNT(e.attendance) AS n, AVG(e.attendance) AS m FROM (SELECT DISTINCT season FROM mart) s
    JOIN mart e ON e.season < s.season AND NOT e.is_covid_affected GROUP BY ALL) a ON a.season = t.season AND a.n > 0
  WHERE t.attendance IS NOT NULL AND NOT t.is_covid_affected
)"""))
def fold_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The naive model's errors, season by season, learned from all seasons before."""
    digits = {"mae": 4, "mape": 6, "rmse": 4}
    found = learn.fold_metrics(learn.training_frame(b.mart(spark, sf)))
    return found.withColumns({c: F.round(c, n) for c, n in digits.items()})


def told(predictions: DataFrame) -> DataFrame:
    """Predictions, with ``finite`` in place of the number."""
    number = F.col("predicted")
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf"))
    return predictions.select("match_id", "model_name", "run_date", "actual", F.coalesce(finite, F.lit(False)).alias("finite"))


def errors_told(metrics: DataFrame, *more: str) -> DataFrame:
    """Metrics, with the order of the errors in place of their size."""
    ordered = (F.col("mae") >= 0) & (F.col("mae") <= F.col("rmse") + 1e-9) & F.col("mape").isNotNull()
    return metrics.select("model_name", "run_date", "n_train", "n_test", *more, ordered.alias("ordered"))


def features_of(model: str) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"('{f}')" for f in MODELS[model]) + ") AS v(feature)"


SIZES = "SELECT COUNT(*) FILTER (part = 'train') AS n_train, COUNT(*) FILTER (part = 'test') AS n_test FROM split"
NAMES = "(VALUES ('naive_club_mean'), ('baseline'), ('prorel')) AS m(model_name)"


@query(sql("""
SELECT match_id, 'prorel' AS model_name, DATE '2001-08-01' AS run_date, CAST(attendance AS DOUBLE) AS actual, true AS finite
FROM split WHERE part = 'test'""", SPLIT))
def train_one(spark: SparkSession, sf: str) -> DataFrame:
    """Holdout predictions of one fitted model."""
    model, (_, test) = fitted(spark, sf, "prorel")["prorel"], learn.parts_of(split_rows(spark, sf))
    return told(learn.score(model, test, MODELS["prorel"], "prorel", b.RUN_DATE))


@query(f"""
SELECT 'baseline' AS model_name, DATE '2001-08-01' AS run_date, feature, false AS is_prorel, true AS adds_up FROM ({features_of('baseline')})
UNION ALL SELECT 'prorel', DATE '2001-08-01', feature, feature NOT IN ({features_of('baseline')}), true FROM ({features_of('prorel')})""")
def importance(spark: SparkSession, sf: str) -> DataFrame:
    """Every feature of every model; importances are not negative and add up to 1."""
    gains = learn.gains_of(fitted(spark, sf, *MODELS), b.RUN_DATE, spark)
    sums = gains.groupBy("model_name", "run_date").agg(
        (F.abs(F.sum("importance") - 1) < 1e-9).alias("whole"), F.min("importance").alias("least")
    )
    return gains.join(sums, ["model_name", "run_date"]).select(
        "model_name", "run_date", "feature", "is_prorel", (F.col("whole") & (F.col("least") >= 0)).alias("adds_up")
    )


@query(sql("""
SELECT model_name, run_date, feature, importance, CAST(place AS INT) AS place FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY model_name, run_date ORDER BY importance DESC, feature) AS place FROM gains)
WHERE place <= 3""", """
gains AS (
  SELECT 'prorel' AS model_name, run_date, feature, importance FROM (
    SELECT CAST(date_trunc('month', date) AS DATE) AS run_date, AVG(day_of_week) AS day_of_week, AVG(month) AS month,
      AVG(matches_remaining) AS matches_remaining, AVG(rank_before) AS rank_before,
      AVG(opponent_rank_before) AS opponent_rank_before, AVG(rank_gap) AS rank_gap,
      AVG(points_from_playoff_line) AS points_from_playoff_line,
      AVG(matches_since_elimination) AS matches_since_elimination,
      AVG(points_from_relegation_line) AS points_from_relegation_line
    FROM mart GROUP BY ALL)
  UNPIVOT (importance FOR feature IN (day_of_week, month, matches_remaining, rank_before, opponent_rank_before, rank_gap,
    points_from_playoff_line, matches_since_elimination, points_from_relegation_line)))"""))
def top_features(spark: SparkSession, sf: str) -> DataFrame:
    """The top three of an importance history; monthly feature means stand in for gains."""
    names = [
        "day_of_week", "month", "matches_remaining", "rank_before", "opponent_rank_before", "rank_gap",
        "points_from_playoff_line", "matches_since_elimination", "points_from_relegation_line",
    ]
    means = b.mart(spark, sf).groupBy(F.trunc("date", "month").alias("run_date")).agg(*[F.avg(c).alias(c) for c in names])
    history = means.unpivot("run_date", names, "feature", "importance").withColumn("model_name", F.lit("prorel"))
    return reports.top_features(history, 3)


@query(f"SELECT feature, true AS finite FROM ({features_of('prorel')})")
def permutation_importance(spark: SparkSession, sf: str) -> DataFrame:
    """Every feature of the larger model, dealt out on the holdout."""
    model, (_, test) = fitted(spark, sf, "prorel")["prorel"], learn.parts_of(split_rows(spark, sf))
    found = learn.permutation_importance(model, test, MODELS["prorel"])
    return found.select("feature", (F.abs("delta_mae") < float("inf")).alias("finite"))


@query(sql(f"SELECT model_name, DATE '2001-08-01' AS run_date, CAST(n_train AS INT) AS n_train, CAST(n_test AS INT) AS n_test, true AS ordered FROM ({SIZES}), {NAMES}", SPLIT))
def train_all(spark: SparkSession, sf: str) -> DataFrame:
    return errors_told(learn.results(split_rows(spark, sf), fitted(spark, sf, *MODELS), b.RUN_DATE)["model_metrics"])


@query(sql("""
SELECT match_id, 'prorel' AS model_name, DATE '2001-08-01' AS run_date, CAST(NULL AS DOUBLE) AS actual, true AS finite
FROM stg_matches WHERE home_goals IS NULL"""))
def score(spark: SparkSession, sf: str) -> DataFrame:
    """Forecasts of the fixtures without a result."""
    features = MODELS["prorel"]
    model = learn.train_one(learn.training_frame(b.mart(spark, sf)), features)
    fixtures = b.mart(spark, sf, include_unplayed=True)
    ahead = b.stg(spark, sf).filter("home_goals is null").select("match_id")
    return told(learn.score(model, fixtures.join(ahead, "match_id", "left_semi"), features, "prorel", b.RUN_DATE))


@query(sql("SELECT match_id, model_name, run_date, predicted, actual FROM predictions"))
def fill_actuals(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions made before the season, completed from the matches played since."""
    made = b.predictions(spark, sf).withColumn("actual", F.lit(None).cast("double"))
    return learn.fill_actuals(made, b.stg(spark, sf))


@query(sql("""
SELECT attendance, COUNT(*) AS n FROM mart WHERE attendance IS NOT NULL AND NOT is_covid_affected GROUP BY 1"""))
def shuffled(spark: SparkSession, sf: str) -> DataFrame:
    """Dealing a column out keeps its values, each as often as before."""
    dealt = learn.shuffled(learn.training_frame(b.mart(spark, sf)), "attendance", 42, buckets=8)
    return dealt.groupBy("attendance").agg(F.count("*").alias("n"))
