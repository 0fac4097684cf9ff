"""Aggregations, windows, set operations and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.values import differs as differs_
from touchline.operators import checks, features, learn, reports, runlog, staging
from touchline.operators import standings as st
from touchline.plans import binding as b
from touchline.plans.oracle import sql
from touchline.plans.registry import query
from touchline.session import stage

# --- aggregations ----------------------------------------------------------------------------


@query(sql("SELECT * FROM final_table"))
def final_table(spark: SparkSession, sf: str) -> DataFrame:
    return st.final_table(b.stg(spark, sf))


@query(sql("SELECT season, club_id, date, COUNT(*) AS n FROM sides GROUP BY ALL HAVING COUNT(*) > 1"))
def duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return checks.duplicates(checks.club_dates(b.stg(spark, sf)), ["season", "club_id", "date"])


#: Columns of staged matches, and of the provider's records.
STAGED = (
    "match_id", "season", "date", "home_club_id", "away_club_id", "home_raw", "away_raw", "home_goals", "away_goals", "attendance",
    "is_covid_affected", "day_of_week", "month", "is_weekend", "is_midweek",
)
FIELDS = ("id", "season", "date_unix", "homeID", "awayID", "stadium_name", "homeGoalCount", "awayGoalCount", "attendance")


@query(sql("SELECT COUNT(*) AS n, " + ", ".join(f"COUNT(*) - COUNT({c}) AS {c}" for c in STAGED) + " FROM stg_matches"))
def null_counts(spark: SparkSession, sf: str) -> DataFrame:
    return checks.null_counts(b.stg(spark, sf), list(STAGED))


@query(sql("SELECT field, COUNT(*) FILTER (v IS NOT NULL AND v NOT IN ('', '-1')) AS present, COUNT(*) AS total FROM ("
           + " UNION ALL ".join(f"""SELECT '{c}' AS field, CAST("{c}" AS VARCHAR) AS v FROM payload""" for c in FIELDS)
           + """ UNION ALL SELECT 'home_name', n_name FROM payload JOIN nation ON n_nationkey = "homeID"
  UNION ALL SELECT 'away_name', n_name FROM payload JOIN nation ON n_nationkey = "awayID") GROUP BY field"""))
def null_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return reports.null_coverage(b.payload(spark, sf), [*FIELDS, "home_name", "away_name"])


@query(sql("""
SELECT 'attendance' AS field, (SELECT COUNT(*) FROM ok) AS populated, (SELECT COUNT(*) FROM payload) AS total,
  (SELECT COUNT(*) FROM ok) / (SELECT COUNT(*) FROM payload) AS share, MIN(v) AS min,
  MAX(CASE WHEN i = (SELECT COUNT(*) FROM ok) // 2 THEN v END) AS median, MAX(v) AS max,
  (SELECT COUNT(*) FROM ok) / (SELECT COUNT(*) FROM payload) >= 0.8 AS usable
FROM (SELECT v, ROW_NUMBER() OVER (ORDER BY v) - 1 AS i FROM ok)""", """
ok AS (SELECT TRY_CAST(attendance AS DOUBLE) AS v FROM payload WHERE TRY_CAST(attendance AS DOUBLE) > 0)"""))
def coverage_gate(spark: SparkSession, sf: str) -> DataFrame:
    return reports.coverage_gate(b.payload(spark, sf))


@query(sql("""
SELECT 'attendance' AS field, COUNT(*) AS total, COUNT(attendance) AS with_value FROM payload"""))
def find_fields(spark: SparkSession, sf: str) -> DataFrame:
    """The discovered gate fields of the payload, with how many records carry each."""
    records = b.payload(spark, sf)
    fields = reports.find_fields(records)
    counts = records.agg(F.count("*").alias("total"), *[F.count(f).alias(f) for f in fields])
    return counts.unpivot("total", fields, "field", "with_value")


@query(sql("SELECT * FROM fixtures"))
def fixture_counts(spark: SparkSession, sf: str) -> DataFrame:
    return features.fixture_counts(b.stg(spark, sf))


@query(sql("""
SELECT match_id, 'naive_club_mean' AS model_name, DATE '2001-08-01' AS run_date,
  round(COALESCE(m, (SELECT AVG(attendance) FROM split WHERE part = 'train')), 6) AS predicted,
  CAST(attendance AS DOUBLE) AS actual
FROM split s LEFT JOIN (SELECT home_club_id, AVG(attendance) AS m FROM split WHERE part = 'train' GROUP BY ALL)
  USING (home_club_id) WHERE part = 'test'""", """
split AS (
  SELECT *, CASE WHEN ROW_NUMBER() OVER (ORDER BY date, match_id) <= floor(COUNT(*) OVER () * 0.8::DOUBLE)
    THEN 'train' ELSE 'test' END AS part
  FROM mart WHERE attendance IS NOT NULL AND NOT is_covid_affected
)"""))
def naive_club_mean(spark: SparkSession, sf: str) -> DataFrame:
    train, test = learn.chronological_split(learn.training_frame(b.mart(spark, sf)))
    return learn.naive_club_mean(train, test, b.RUN_DATE).withColumn("predicted", F.round("predicted", 6))


@query(sql("""
SELECT model_name, run_date, round(mae, 4) AS mae, round(mape, 4) AS mape, round(rmse, 4) AS rmse, n_test FROM metrics"""))
def error_metrics(spark: SparkSession, sf: str) -> DataFrame:
    rounded = {c: F.round(c, 4) for c in ("mae", "mape", "rmse")}
    metrics = learn.error_metrics(b.predictions(spark, sf)).drop("n_train").withColumns(rounded)
    return metrics.withColumn("n_test", F.col("n_test").cast("bigint"))


@query(sql("""
SELECT matches_since_elimination, COUNT(*) AS n, round(AVG(attendance / own), 8) AS index_vs_own_baseline
FROM mart LEFT JOIN (SELECT season, home_club_id, AVG(attendance) AS own FROM mart
  WHERE matches_since_elimination < 0 AND NOT is_covid_affected GROUP BY ALL) USING (season, home_club_id)
WHERE matches_since_elimination >= 0 AND NOT is_covid_affected GROUP BY ALL"""))
def decay_curve(spark: SparkSession, sf: str) -> DataFrame:
    return reports.decay_curve(b.mart(spark, sf)).withColumn(
        "index_vs_own_baseline", F.round("index_vs_own_baseline", 8)
    )


@query(sql("""
SELECT week, n_eliminated, n_live, round(e, 6) AS eliminated_mean, round(l, 6) AS live_mean, round(e - l, 6) AS difference
FROM (SELECT CAST(date_trunc('week', date) AS DATE) AS week,
    COUNT(*) FILTER (matches_since_elimination >= 0) AS n_eliminated,
    COUNT(*) FILTER (matches_since_elimination < 0) AS n_live,
    AVG(attendance) FILTER (matches_since_elimination >= 0) AS e,
    AVG(attendance) FILTER (matches_since_elimination < 0) AS l
  FROM mart WHERE NOT is_covid_affected GROUP BY 1)
WHERE n_eliminated > 0 AND n_live > 0"""))
def decay_vs_live(spark: SparkSession, sf: str) -> DataFrame:
    names = ("eliminated_mean", "live_mean", "difference")
    return reports.decay_vs_live(b.mart(spark, sf)).withColumns({c: F.round(c, 6) for c in names})


@query(sql("""
SELECT COUNT(*) AS n, round(regr_slope(attendance, rank_before), 4) AS slope,
  round(regr_intercept(attendance, rank_before), 4) AS intercept,
  round(regr_r2(attendance, rank_before), 8) AS r2, round(corr(attendance, rank_before), 8) AS correlation
FROM mart WHERE attendance IS NOT NULL"""))
def rank_attendance_fit(spark: SparkSession, sf: str) -> DataFrame:
    digits = {"slope": 4, "intercept": 4, "r2": 8, "correlation": 8}
    return reports.rank_attendance_fit(b.mart(spark, sf)).withColumns({c: F.round(c, d) for c, d in digits.items()})


@query(sql("""
SELECT model_name, home_club_id, COUNT(*) AS n, round(AVG(actual), 4) AS actual_mean,
  round(AVG(predicted), 4) AS predicted_mean
FROM predictions JOIN mart USING (match_id) WHERE actual IS NOT NULL GROUP BY ALL"""))
def actual_vs_predicted(spark: SparkSession, sf: str) -> DataFrame:
    names = ("actual_mean", "predicted_mean")
    report = reports.actual_vs_predicted(b.predictions(spark, sf), b.mart(spark, sf))
    return report.withColumns({c: F.round(c, 4) for c in names})


@query(sql("""
SELECT model_name, home_club_id, round(AVG(abs(actual - predicted)), 4) AS mae, COUNT(*) AS n,
  round(quantile_cont(actual - predicted, 0.1), 4) AS low, round(quantile_cont(actual - predicted, 0.9), 4) AS high
FROM predictions JOIN stg_matches USING (match_id) WHERE actual IS NOT NULL GROUP BY ALL"""))
def residual_band(spark: SparkSession, sf: str) -> DataFrame:
    clubs = b.stg(spark, sf).select("match_id", "home_club_id")
    known = b.predictions(spark, sf).join(clubs, "match_id")
    band = reports.residual_band(known, ["model_name", "home_club_id"])
    return band.withColumns({c: F.round(c, 4) for c in ("mae", "low", "high")})


@query(sql("""
SELECT p.match_id, p.model_name, p.predicted, round(p.predicted + low, 4) AS predicted_low,
  round(p.predicted + high, 4) AS predicted_high
FROM predictions p LEFT JOIN (SELECT model_name, quantile_cont(actual - predicted, 0.1) AS low,
    quantile_cont(actual - predicted, 0.9) AS high FROM predictions WHERE actual IS NOT NULL GROUP BY ALL)
  USING (model_name) WHERE p.actual IS NULL"""))
def forecast_band(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.predictions(spark, sf)
    open_rows = rows.filter("actual is null").select("match_id", "model_name", "predicted")
    banded = reports.forecast_band(open_rows, reports.residual_band(rows))
    return banded.withColumns({c: F.round(c, 4) for c in ("predicted_low", "predicted_high")})


@query(sql("""
SELECT COUNT(*) AS runs, COUNT(*) FILTER (gap > 0) AS prorel_wins, round(median(gap), 4) AS median_gap,
  round(stddev_samp(gap), 4) AS sd_gap
FROM (SELECT b.mae - p.mae AS gap FROM metrics b JOIN metrics p ON b.run_date = p.run_date
  AND b.model_name = 'baseline' AND p.model_name = 'prorel')"""))
def compare_models(spark: SparkSession, sf: str) -> DataFrame:
    report = reports.compare_models(learn.error_metrics(b.predictions(spark, sf)))
    return report.withColumns({c: F.round(c, 4) for c in ("median_gap", "sd_gap")})


@query(sql("""
SELECT season, home_club_id, COUNT(*) AS home_matches, COUNT(m.attendance) AS recorded,
  COALESCE(SUM(CAST(m.attendance AS DOUBLE)), 0) AS to_date,
  SUM(COALESCE(CAST(m.attendance AS DOUBLE), predicted)) AS projected
FROM stg_matches m LEFT JOIN predictions p ON p.match_id = m.match_id AND model_name = 'prorel' GROUP BY ALL"""))
def gate_projection(spark: SparkSession, sf: str) -> DataFrame:
    forecast = b.predictions(spark, sf).filter("model_name = 'prorel'")
    return reports.gate_projection(b.stg(spark, sf), forecast)


# --- windows ---------------------------------------------------------------------------------


@query(sql("SELECT season, club_id, date, pts_before, gd_before, gf_before, played_before FROM running"))
def running_totals(spark: SparkSession, sf: str) -> DataFrame:
    return st.running_totals(st.club_days(st.played(b.stg(spark, sf))))


@query(sql("SELECT * FROM in_action"))
def rank_in_action(spark: SparkSession, sf: str) -> DataFrame:
    return st.rank_in_action(st.running_totals(st.club_days(st.played(b.stg(spark, sf)))))


@query(sql("""
SELECT r.*, conference, CAST(RANK() OVER (PARTITION BY r.season, conference, date
  ORDER BY pts_before DESC, gd_before DESC, gf_before DESC) AS INT) AS rank_before
FROM running r JOIN club_conference c ON c.season = r.season AND c.club_id = r.club_id"""))
def rank_in_conference(spark: SparkSession, sf: str) -> DataFrame:
    rows = st.played(b.stg(spark, sf))
    return st.int_standings(rows, b.clubs(spark, sf), field="action")


@query(sql("SELECT * FROM int_standings"))
def int_standings(spark: SparkSession, sf: str) -> DataFrame:
    return st.int_standings(b.stg(spark, sf), b.clubs(spark, sf))


@query(sql("SELECT match_id, last_home_gate FROM masked_lags"))
def last_home_gate(spark: SparkSession, sf: str) -> DataFrame:
    return features.lags(b.stg(spark, sf), mask=b.MASK).select("match_id", "last_home_gate")


@query(sql("SELECT match_id, home_gate_ma3 FROM plain_lags"))
def home_gate_ma3(spark: SparkSession, sf: str) -> DataFrame:
    return features.lags(b.stg(spark, sf)).select("match_id", "home_gate_ma3")


@query(sql("SELECT match_id, home_gate_ma5 FROM plain_lags"))
def home_gate_ma5(spark: SparkSession, sf: str) -> DataFrame:
    return features.lags(b.stg(spark, sf)).select("match_id", "home_gate_ma5")


@query(sql("""
SELECT match_id, LAG(attendance) OVER w AS last_home_gate,
  AVG(attendance) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS home_gate_ma3,
  AVG(attendance) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS home_gate_ma5
FROM stg_matches WINDOW w AS (PARTITION BY home_club_id, season ORDER BY date, match_id)"""))
def lags_within_season(spark: SparkSession, sf: str) -> DataFrame:
    return features.lags(b.stg(spark, sf), by_season=True).select(
        "match_id", "last_home_gate", "home_gate_ma3", "home_gate_ma5"
    )


@query(sql("SELECT match_id, last_home_gate, home_gate_ma3, home_gate_ma5 FROM masked_lags"))
def masked_lags(spark: SparkSession, sf: str) -> DataFrame:
    return features.lags(b.stg(spark, sf), mask=b.MASK).select(
        "match_id", "last_home_gate", "home_gate_ma3", "home_gate_ma5"
    )


def stakes(spark: SparkSession, sf: str) -> DataFrame:
    """The stakes table on the clubs' own match dates, built once per session."""
    return b.built(spark, sf, "stakes", lambda: features.club_stakes(
        b.stg(spark, sf), b.clubs(spark, sf), b.PLAYOFF_SPOTS, b.RELEGATION_SPOTS
    ).filter("scheduled > 0"))


@query(sql("SELECT season, club_id, date, matches_remaining FROM stakes"))
def matches_remaining(spark: SparkSession, sf: str) -> DataFrame:
    return stakes(spark, sf).select("season", "club_id", "date", "matches_remaining")


@query(sql("SELECT * FROM flags"))
def opener_and_final(spark: SparkSession, sf: str) -> DataFrame:
    return features.opener_and_final(b.stg(spark, sf)).select("match_id", "is_season_opener", "is_final_home_match")


@query(sql("SELECT season, club_id, date, points_from_playoff_line FROM stakes"))
def points_from_playoff_line(spark: SparkSession, sf: str) -> DataFrame:
    return stakes(spark, sf).select("season", "club_id", "date", "points_from_playoff_line")


@query(sql("SELECT season, club_id, date, points_from_relegation_line FROM stakes"))
def points_from_relegation_line(spark: SparkSession, sf: str) -> DataFrame:
    return stakes(spark, sf).select("season", "club_id", "date", "points_from_relegation_line")


@query(sql("SELECT season, club_id, date, is_mathematically_live FROM stakes"))
def is_mathematically_live(spark: SparkSession, sf: str) -> DataFrame:
    return stakes(spark, sf).select("season", "club_id", "date", "is_mathematically_live")


@query(sql("SELECT season, club_id, date, matches_since_elimination FROM stakes"))
def matches_since_elimination(spark: SparkSession, sf: str) -> DataFrame:
    return stakes(spark, sf).select("season", "club_id", "date", "matches_since_elimination")


@query(sql("SELECT match_id, rank_before, opponent_rank_before, rank_gap FROM mart"))
def rank_gap(spark: SparkSession, sf: str) -> DataFrame:
    return b.mart(spark, sf).select("match_id", "rank_before", "opponent_rank_before", "rank_gap")


@query(sql("""
SELECT season, club_id, date, points, CAST(ROW_NUMBER() OVER w AS INT) AS n, LAG(points) OVER w AS prev_points
FROM (SELECT season, club_id, date, CAST(SUM(points) AS BIGINT) AS points FROM club_matches GROUP BY ALL)
WINDOW w AS (PARTITION BY season, club_id ORDER BY date)"""))
def club_sequence(spark: SparkSession, sf: str) -> DataFrame:
    return checks.club_sequence(b.stg(spark, sf))


@query("""
SELECT check_name, run_id, strftime(checked_at, '%Y-%m-%d %H:%M:%S.%f') AS checked_at FROM (
  SELECT event_type AS check_name, 'r' || CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id,
    ts AS checked_at, value < 30 AS passed, LAG(value < 30) OVER (PARTITION BY event_type ORDER BY ts,
      'r' || CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR)) AS was
  FROM events) WHERE was AND NOT passed""")
def check_flips(spark: SparkSession, sf: str) -> DataFrame:
    flips = runlog.check_flips(b.check_log(spark, sf))
    return flips.withColumn("checked_at", F.date_format("checked_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query(sql("""
SELECT model_name, run_date, round(m.mae, 4) AS mae,
  round(m.mae - LAG(m.mae) OVER (PARTITION BY model_name ORDER BY run_date), 4) AS mae_change,
  round(gap, 4) AS gap, CAST(sign(gap) AS INT) AS gap_sign
FROM metrics m JOIN (SELECT run_date, MAX(CASE WHEN model_name = 'baseline' THEN mae END)
    - MAX(CASE WHEN model_name = 'prorel' THEN mae END) AS gap FROM metrics GROUP BY ALL) USING (run_date)"""))
def metric_history(spark: SparkSession, sf: str) -> DataFrame:
    history = reports.metric_history(learn.error_metrics(b.predictions(spark, sf)))
    return history.withColumns({c: F.round(c, 4) for c in ("mae", "mae_change", "gap")})


# --- set operations, sorts, limits -----------------------------------------------------------


@query(sql("""
SELECT match_id, season, date, club_id, opponent_club_id, is_home, gf, ga,
  CASE WHEN gf > ga THEN 3 WHEN gf = ga THEN 1 WHEN gf < ga THEN 0 END AS points FROM sides"""))
def unpivot_sides(spark: SparkSession, sf: str) -> DataFrame:
    return st.unpivot_sides(b.stg(spark, sf))


@query(sql("""
SELECT home_raw AS name FROM raw_matches WHERE trim(home_raw) = '24'
UNION SELECT away_raw FROM raw_matches WHERE away_raw = '24'"""))
def unmapped_names(spark: SparkSession, sf: str) -> DataFrame:
    rows = staging.stg_matches(b.raw_matches(spark, sf), b.aliases_without_last(spark, sf), b.MASK)
    return staging.unmapped_names(rows)


@query(sql("SELECT season, club_id, date FROM sides"))
def club_dates(spark: SparkSession, sf: str) -> DataFrame:
    return checks.club_dates(b.stg(spark, sf))


def conference_days(spark: SparkSession, sf: str) -> DataFrame:
    return st.with_conference(st.club_days(b.stg(spark, sf)), b.clubs(spark, sf))


@query(sql("SELECT DISTINCT season, conference, date FROM club_dates"))
def distinct_dates(spark: SparkSession, sf: str) -> DataFrame:
    return st.distinct_dates(conference_days(spark, sf))


@query(sql("SELECT DISTINCT season, conference, club_id FROM club_dates"))
def club_seasons(spark: SparkSession, sf: str) -> DataFrame:
    return st.club_seasons(conference_days(spark, sf))


@query(sql("SELECT * FROM mart ORDER BY date, match_id LIMIT 20"))
def preview(spark: SparkSession, sf: str) -> DataFrame:
    return reports.preview(b.mart(spark, sf), 20)


@query(sql("SELECT match_id, date FROM mart ORDER BY date, match_id"))
def ordered(spark: SparkSession, sf: str) -> DataFrame:
    return b.mart(spark, sf).select("match_id", "date").orderBy("date", "match_id")


@query(sql("""
SELECT m.match_id, m.attendance, l.last_home_gate FROM stg_matches m JOIN plain_lags l USING (match_id)
WHERE m.attendance IS DISTINCT FROM l.last_home_gate"""))
def differs(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.lags(b.stg(spark, sf))
    unlike = differs_(F.col("attendance"), F.col("last_home_gate"))
    return rows.filter(unlike).select("match_id", "attendance", "last_home_gate")


# --- the marts -------------------------------------------------------------------------------


@query(sql("SELECT * FROM parity"))
def parity_mart(spark: SparkSession, sf: str) -> DataFrame:
    return features.parity_mart(stage(
        staging.stg_matches(b.raw_matches(spark, sf), b.aliases(spark, sf), b.MASK), "stg_matches"
    ))


@query(sql("SELECT * FROM mart"))
def mart_match_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = staging.stg_matches(b.raw_matches(spark, sf), b.aliases(spark, sf), b.MASK)
    return features.mart_match_features(
        stage(rows, "stg_matches"), b.clubs(spark, sf), b.derbies(spark, sf),
        b.PLAYOFF_SPOTS, b.RELEGATION_SPOTS, mask=b.MASK,
    )


@query(sql("SELECT * EXCLUDE (was_played) FROM mart_all WHERE NOT was_played"))
def upcoming_fixtures(spark: SparkSession, sf: str) -> DataFrame:
    """Features of fixtures without a result, which the forecasts read."""
    ahead = st_unplayed(b.stg(spark, sf))
    return b.mart(spark, sf, include_unplayed=True).join(ahead, "match_id", "left_semi")


def st_unplayed(matches: DataFrame) -> DataFrame:
    return matches.filter("home_goals is null").select("match_id")
