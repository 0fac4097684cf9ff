"""Loads, history tables, checks, logs and monitors."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators import checks, features, runlog, staging, upsert as up
from touchline.operators import standings as st
from touchline.plans import binding as b
from touchline.plans.load_queries import archived
from touchline.plans.oracle import sql
from touchline.plans.registry import query
from touchline.session import scratch_path, stage
from touchline.sources import archive
from touchline.streaming.ingest import stream_archive

LOADED_UNTIL = "2000-01-01"
AS_OF = dt.date(2001, 6, 5)
FIGURES = ("match_id", "season", "date", "home_goals", "away_goals", "attendance")

# --- loads -----------------------------------------------------------------------------------


def stored(spark: SparkSession, sf: str) -> DataFrame:
    """What an earlier load left: matches up to 1999, with a first figure for one season."""
    early = F.when(F.col("season") == 1999, "1").otherwise(F.col("attendance"))
    raw = b.raw_matches(spark, sf).filter(F.col("date") < LOADED_UNTIL)
    return raw.withColumn("attendance", early)


def delivery(spark: SparkSession, sf: str) -> DataFrame:
    """The whole schedule delivered again, every match twice: a stale copy and the latest."""
    raw = b.raw_matches(spark, sf)
    stale = raw.withColumns({
        "attendance": F.lit("7"), "ingested_at": F.col("ingested_at") - F.expr("interval 1 hour"),
    })
    return stale.unionByName(raw)


MERGED = """
SELECT match_id, season, date, home_goals, away_goals, attendance,
  CASE WHEN date >= '2000-01-01' THEN 'inserted'
    WHEN season = 1999 AND attendance IS DISTINCT FROM '1' THEN 'updated' ELSE 'unchanged' END AS action
FROM raw_matches"""


@query(sql(MERGED))
def upsert(spark: SparkSession, sf: str) -> DataFrame:
    return up.upsert(stored(spark, sf), delivery(spark, sf)).select(*FIGURES, "action")


@query(sql(f"""
SELECT COUNT(*) FILTER (action = 'inserted') AS inserted, COUNT(*) FILTER (action = 'updated') AS updated,
  COUNT(*) FILTER (action = 'unchanged') AS unchanged, COUNT(*) AS total FROM ({MERGED})"""))
def load_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return up.load_statistics(up.upsert(stored(spark, sf), delivery(spark, sf)))


@query(sql(f"""
SELECT season, COUNT(*) FILTER (action = 'inserted') AS inserted, COUNT(*) FILTER (action = 'updated') AS updated,
  COUNT(*) FILTER (action = 'unchanged') AS unchanged, COUNT(*) AS total FROM ({MERGED}) GROUP BY season"""))
def backfill(spark: SparkSession, sf: str) -> DataFrame:
    records = archive.to_raw_matches(archive.read_archive(spark, archived(spark, sf), per_line=True))
    stray = F.substring("match_id", -1, 1) == "3"
    records = records.withColumn(
        "home_raw", F.when(stray, F.concat(F.lit("  "), "home_raw", F.lit(" "))).otherwise(F.col("home_raw"))
    )
    return up.backfill(stored(spark, sf), records, b.seasons(spark, sf))[1]


@query(sql("SELECT match_id, season, date, home_goals, away_goals, attendance FROM raw_matches"))
def dedupe_latest(spark: SparkSession, sf: str) -> DataFrame:
    return up.dedupe_latest(delivery(spark, sf)).select(*FIGURES)


@query(sql("SELECT match_id, season, date, home_goals, away_goals, attendance FROM raw_matches"))
def upsert_table(spark: SparkSession, sf: str) -> DataFrame:
    """The parquet table after the earlier load and the new delivery."""
    path = scratch_path(spark, "raw-table")
    up.upsert_table(spark, path, stored(spark, sf))
    up.upsert_table(spark, path, delivery(spark, sf))
    return up.read_table(spark, path).select(*FIGURES)


@query(sql("""
SELECT match_id, model_name, run_date, CASE WHEN model_name = 'prorel' AND run_date = DATE '2000-06-01'
  THEN predicted + 1 ELSE predicted END AS predicted, actual FROM predictions"""))
def upsert_run(spark: SparkSession, sf: str) -> DataFrame:
    """A prediction history in which one model's run of one date was repeated."""
    path = scratch_path(spark, "history")
    rows = b.predictions(spark, sf)
    up.upsert_run(rows, path)
    again = rows.filter("model_name = 'prorel' and run_date = date'2000-06-01'")
    up.upsert_run(again.withColumn("predicted", F.col("predicted") + 1), path)
    return spark.read.parquet(path).select(*rows.columns)


@query(sql("SELECT * FROM final_table"))
def materialise(spark: SparkSession, sf: str) -> DataFrame:
    """A derived table rebuilt twice."""
    path = scratch_path(spark, "derived")
    up.materialise(st.final_table(b.stg(spark, sf)), path)
    return up.materialise(st.final_table(b.stg(spark, sf)), path)


@query(sql("SELECT * FROM final_table"))
def publish(spark: SparkSession, sf: str) -> DataFrame:
    """Readers get the second version, not the first."""
    path = scratch_path(spark, "published")
    final = st.final_table(b.stg(spark, sf))
    up.publish(final.withColumn("pts", F.lit(0).cast("bigint")), path, 1)
    up.publish(final, path, 2)
    return up.read_published(spark, path).select(final.columns)


@query(sql("SELECT match_id, season, date, home_goals, away_goals, attendance FROM raw_matches"))
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """The archive consumed as a stream into the raw table, then once more with nothing new."""
    path, table = archived(spark, sf), scratch_path(spark, "streamed")
    checkpoint = scratch_path(spark, "stream-checkpoint")
    for _ in range(2):
        stream_archive(spark, path, checkpoint, table, per_line=True).awaitTermination()
    return up.read_table(spark, table).select(*FIGURES)


@query(sql("""
SELECT match_id, season, date, home_goals, away_goals, attendance, 'updated' AS action FROM raw_matches
WHERE season = 1999 AND attendance IS DISTINCT FROM '1'"""))
def late_correction(spark: SparkSession, sf: str) -> DataFrame:
    """Figures replaced by a later delivery."""
    return up.upsert(stored(spark, sf), delivery(spark, sf)).filter("action = 'updated'").select(*FIGURES, "action")


# --- logs ------------------------------------------------------------------------------------


def shown(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as text, independent of the session's zone."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in columns})


def at(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {column}"


@query(sql(f"""
SELECT run_id, stage, {at('started_at')}, {at('finished_at')}, status, rows_read, rows_inserted, rows_updated,
  CAST(epoch_us(finished_at) - epoch_us(started_at) AS DOUBLE) AS duration_us FROM runs"""))
def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """The duration is compared in whole microseconds: its seconds are a difference of doubles."""
    duration = F.round(F.col("duration_seconds") * 1e6).alias("duration_us")
    return shown(b.runs(spark, sf), "started_at", "finished_at").select(
        "run_id", "stage", "started_at", "finished_at", "status", "rows_read", "rows_inserted", "rows_updated", duration
    )


@query(sql("""
SELECT 'r' AS run_id, 'no_leakage' AS check_name, 'mart' AS tier, true AS passed, '{"offending":0}' AS metadata
UNION ALL SELECT 'r', 'row_count_preserved', 'staging', true,
  (SELECT '{"raw":' || COUNT(*) || ',"stg":' || COUNT(*) || '}' FROM raw_matches)"""))
def log_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Two results appended to the check log and read back."""
    path, now = scratch_path(spark, "check-log"), dt.datetime(2001, 8, 1)
    rows = b.stg(spark, sf)
    for result in (checks.no_leakage(rows, b.parity(spark, sf)), checks.row_count_preserved(b.raw_matches(spark, sf), rows)):
        runlog.log_checks(result, path, "r", now)
    return spark.read.parquet(path).drop("checked_at")


@query(sql("""
SELECT COUNT(*) AS rows_read, '[1995,1996,1997,1998,1999,2000,2001]' AS seasons, MAX(date) AS max_match_date,
  100.0::DOUBLE * COUNT(*) FILTER (attendance IS NULL) / COUNT(*) AS null_attendance_pct FROM stg_matches"""))
def stage_metadata(spark: SparkSession, sf: str) -> DataFrame:
    return runlog.stage_metadata(b.stg(spark, sf))


@query(sql(f"""
SELECT run_id, stage, {at('finished_at')}, rows_read, null_attendance_pct, max_match_date FROM runs
WHERE status = 'success'"""))
def freshness_history(spark: SparkSession, sf: str) -> DataFrame:
    return shown(runlog.freshness_history(b.runs(spark, sf)), "finished_at")


@query(sql(f"""
SELECT run_id, stage, {at('started_at')}, status FROM runs WHERE run_id =
  (SELECT run_id FROM runs WHERE status = 'failed' ORDER BY started_at DESC, run_id DESC LIMIT 1)"""))
def failed_stages(spark: SparkSession, sf: str) -> DataFrame:
    return shown(runlog.failed_stages(b.runs(spark, sf)), "started_at")


@query(sql(f"SELECT run_id, stage, {at('started_at')} FROM runs WHERE status = 'running'"))
def crashed_stages(spark: SparkSession, sf: str) -> DataFrame:
    return shown(runlog.crashed_stages(b.runs(spark, sf)), "started_at")


@query(sql(f"""
SELECT run_id, stage, {at('started_at')} FROM runs WHERE status = 'success' AND rows_inserted = 0 AND rows_updated = 0
  AND CAST(started_at AS DATE) BETWEEN make_date(year(started_at), 1, 1) AND make_date(year(started_at), 12, 31)"""))
def stale_green_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The events are from January, so their dates are moved into the season first."""
    log = b.runs(spark, sf)
    moved = log.withColumn("started_at", F.col("started_at") + F.expr("interval 120 days"))
    stale = runlog.stale_green_runs(moved)
    return shown(stale.withColumn("started_at", F.col("started_at") - F.expr("interval 120 days")), "started_at")


# --- checks ----------------------------------------------------------------------------------


def check(name: str, tier: str, passed: str, metadata: str, source: str = "(SELECT 1)", *extra: str) -> str:
    return sql(
        f"SELECT '{name}' AS name, '{tier}' AS tier, {passed} AS passed, {metadata} AS metadata FROM {source}", *extra
    )


@query(check(
    "matches_are_fresh", "staging", "date_diff('day', d, DATE '2001-06-05') <= 10",
    """'{"latest_match":"' || d || '","age_days":' || date_diff('day', d, DATE '2001-06-05') || '}'""",
    "(SELECT MAX(date) AS d FROM stg_matches WHERE home_goals IS NOT NULL)",
))
def matches_are_fresh(spark: SparkSession, sf: str) -> DataFrame:
    return checks.matches_are_fresh(b.stg(spark, sf), AS_OF)


@query(check(
    "all_clubs_mapped", "staging", "COUNT(*) = 0",
    """'{"unmapped":' || COUNT(*) || ',"names":[' || string_agg('"' || name || '"', ',' ORDER BY name) || ']}'""",
    """(SELECT home_raw AS name FROM raw_matches WHERE trim(home_raw) = '24'
        UNION SELECT away_raw FROM raw_matches WHERE away_raw = '24')""",
))
def all_clubs_mapped(spark: SparkSession, sf: str) -> DataFrame:
    """With the last club's aliases missing, its raw names are listed."""
    raw = b.raw_matches(spark, sf)
    return checks.all_clubs_mapped(staging.stg_matches(raw, b.aliases_without_last(spark, sf), b.MASK))


@query(check(
    "row_count_preserved", "staging", "r = s", """'{"raw":' || r || ',"stg":' || s || '}'""",
    "(SELECT (SELECT COUNT(*) FROM raw_matches) AS r, (SELECT COUNT(*) FROM stg_matches) AS s)",
))
def row_count_preserved(spark: SparkSession, sf: str) -> DataFrame:
    return checks.row_count_preserved(b.raw_matches(spark, sf), b.stg(spark, sf))


@query(check(
    "one_row_per_match", "staging", "n = 0", """'{"duplicated":' || n || ',"first":null}'""",
    "(SELECT COUNT(*) AS n FROM (SELECT match_id FROM stg_matches GROUP BY 1 HAVING COUNT(*) > 1))",
))
def one_row_per_match(spark: SparkSession, sf: str) -> DataFrame:
    return checks.one_row_per_match(b.stg(spark, sf))


@query(check(
    "one_match_per_club_per_date", "staging", "COUNT(*) = 0",
    """'{"duplicated":' || COUNT(*) || ',"first_date":"' || MIN(date) || '","first_club":"'
       || arg_min(club_id, (date, season, club_id)) || '"}'""",
    "(SELECT season, club_id, date FROM sides GROUP BY ALL HAVING COUNT(*) > 1)",
))
def one_match_per_club_per_date(spark: SparkSession, sf: str) -> DataFrame:
    return checks.one_match_per_club_per_date(b.stg(spark, sf))


@query(check(
    "no_future_leakage", "intermediate", "bad = 0", """'{"compared":' || n || ',"offending":' || bad || '}'""",
    """(SELECT COUNT(*) AS n, COUNT(*) FILTER ((s.pts_before, s.gd_before, s.gf_before, s.played_before)
          IS DISTINCT FROM (r.pts_before, r.gd_before, r.gf_before, r.played_before)) AS bad
        FROM int_standings s FULL JOIN field r USING (season, club_id, date))""",
))
def no_future_leakage(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.stg(spark, sf)
    return checks.no_future_leakage(rows, st.int_standings(rows, b.clubs(spark, sf)))


@query(check(
    "no_leakage", "mart", "bad = 0", """'{"offending":' || bad || '}'""",
    """(SELECT COUNT(*) FILTER (p.pts_before IS DISTINCT FROM q.prev_points) AS bad FROM parity p JOIN (
          SELECT season, club_id, date, ROW_NUMBER() OVER w AS n, LAG(points) OVER w AS prev_points
          FROM (SELECT season, club_id, date, SUM(points) AS points FROM club_matches GROUP BY ALL)
          WINDOW w AS (PARTITION BY season, club_id ORDER BY date)) q
        ON q.season = p.season AND q.club_id = p.home_club_id AND q.date = p.date AND q.n = 2)""",
))
def no_leakage(spark: SparkSession, sf: str) -> DataFrame:
    return checks.no_leakage(b.stg(spark, sf), b.parity(spark, sf))


@query(check(
    "first_match_is_zero", "mart", "bad = 0", """'{"offending":' || bad || '}'""",
    "(SELECT COUNT(*) FILTER (played_before = 0 AND (pts_before IS NULL OR pts_before <> 0)) AS bad FROM parity)",
))
def first_match_is_zero(spark: SparkSession, sf: str) -> DataFrame:
    return checks.first_match_is_zero(b.parity(spark, sf))


@query(check(
    "final_table", "mart", "true", """'{"club_seasons":' || COUNT(*) || ',"mismatches":0}'""", "final_table",
))
def final_table_matches(spark: SparkSession, sf: str) -> DataFrame:
    return checks.final_table_matches(b.stg(spark, sf))


@query(check("features_not_null", "mart", "COUNT(*) > 0", """
  '{"day_of_week":0,"month":0,"is_weekend":0,"is_midweek":0,"opponent_club_id":0,"is_derby":0,"matches_remaining":0,'
  || '"is_season_opener":0,"is_final_home_match":0,"rank_before":0,"opponent_rank_before":0,"rank_gap":0,'
  || '"points_from_playoff_line":0,"is_mathematically_live":0,"matches_since_elimination":0,'
  || '"points_from_relegation_line":' || COUNT(*) FILTER (points_from_relegation_line IS NULL) || '}'""", "mart"))
def features_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return checks.features_not_null(b.mart(spark, sf))


@query(check(
    "mart_matches_staging", "mart", "p = m", """'{"playable":' || p || ',"mart":' || m || '}'""",
    "(SELECT (SELECT COUNT(home_goals) FROM stg_matches) AS p, (SELECT COUNT(*) FROM mart) AS m)",
))
def mart_matches_staging(spark: SparkSession, sf: str) -> DataFrame:
    return checks.mart_matches_staging(b.stg(spark, sf), b.mart(spark, sf))


@query(check(
    "mart_columns_match_definitions", "mart", "COUNT(*) > 0", """'{"missing":[],"extra":[]}'""", "mart"
))
def mart_columns_match_definitions(spark: SparkSession, sf: str) -> DataFrame:
    """Compared on the columns of the mart as written."""
    return checks.mart_columns_match_definitions(b.mart(spark, sf))


@query(check(
    "one_stadium_per_match", "staging", "a + s = 0", """'{"without":' || a || ',"several":' || s || '}'""",
    """(SELECT COUNT(*) FILTER (k = 0) AS a, COUNT(*) FILTER (k > 1) AS s
        FROM (SELECT match_id, COUNT(stadium) AS k FROM with_grounds GROUP BY 1))""",
))
def one_stadium_per_match(spark: SparkSession, sf: str) -> DataFrame:
    return checks.one_stadium_per_match(b.with_grounds(spark, sf))


@query(check(
    "schema_drift", "staging", "COUNT(*) = 0",
    """'{"records":' || COUNT(*) || ',"missing":' || arg_min(missing, length(missing)) || ',"found":["awayGoalCount","awayID","away_name",'
       || '"date_unix","homeGoalCount","homeID","home_name","id","season","stadium_name"]}'""",
    """(SELECT '["attendance"]' AS missing FROM payload WHERE attendance IS NULL AND "homeGoalCount" IS NOT NULL
        UNION ALL SELECT '["attendance","awayGoalCount","homeGoalCount"]' FROM payload WHERE "homeGoalCount" IS NULL)""",
))
def schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    """The archive leaves out empty fields, which the check reports as missing."""
    records = archive.read_archive(spark, archived(spark, sf), per_line=True)
    return checks.schema_drift(records)


@query(sql("""
SELECT 'bodies_parse' AS name, 'ingest' AS tier, false AS passed,
  '{"parsed":' || (SELECT COUNT(*) FROM (SELECT DISTINCT year(day), id // 500 FROM payload))
    || ',"unparsed":' || (SELECT COUNT(*) FROM pages) || '}' AS metadata"""))
def bodies_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Web pages saved among the responses fail the load."""
    path = archived(spark, sf)
    pages = b.table(spark, sf, "pages").select(F.regexp_replace("html", "[\\r\\n]+", " ").alias("value"))
    pages.write.text(f"{path}/endpoint=league-matches/season_id=0")
    return checks.bodies_parse(archive.parsed(archive.documents(spark, path, per_line=True)))


@query(sql("""
SELECT 'all_clubs_mapped' AS check_name, '{"name":"' || name || '"}' AS offender FROM (
  SELECT home_raw AS name FROM raw_matches WHERE trim(home_raw) = '24' UNION SELECT away_raw FROM raw_matches WHERE away_raw = '24')
UNION ALL SELECT 'one_match_per_club_per_date', '{"season":' || season || ',"club_id":"' || club_id || '","date":"' || date
  || '","n":' || COUNT(*) || '}' FROM sides GROUP BY season, club_id, date HAVING COUNT(*) > 1"""))
def check_details(spark: SparkSession, sf: str) -> DataFrame:
    """Every offender of two checks, as it is written beside the check log."""
    unmapped = staging.unmapped_names(staging.stg_matches(b.raw_matches(spark, sf), b.aliases_without_last(spark, sf), b.MASK))
    twice = checks.duplicates(checks.club_dates(b.stg(spark, sf)), ["season", "club_id", "date"])
    return checks.details("all_clubs_mapped", unmapped).unionByName(checks.details("one_match_per_club_per_date", twice))


@query(sql("""
SELECT CAST(id AS VARCHAR) AS id, CASE WHEN "homeGoalCount" IS NULL THEN 'attendance,awayGoalCount,homeGoalCount'
  ELSE 'attendance' END AS missing FROM payload WHERE attendance IS NULL"""))
def drifted_records(spark: SparkSession, sf: str) -> DataFrame:
    records = archive.read_archive(spark, archived(spark, sf), per_line=True)
    return checks.drifted_records(records).select("id", F.array_join("missing", ",").alias("missing"))


@query(sql("""
SELECT 'one_row_per_match' AS name, COUNT(*) = COUNT(DISTINCT match_id) AS passed FROM stg_matches
UNION ALL SELECT 'row_count_preserved', COUNT(*) = (SELECT COUNT(*) FROM raw_matches) FROM stg_matches
UNION ALL SELECT 'matches_are_fresh', date_diff('day', MAX(date), DATE '2001-06-05') <= 10 FROM stg_matches WHERE home_goals IS NOT NULL
UNION ALL SELECT 'all_clubs_mapped', COUNT(*) = 0 FROM stg_matches WHERE home_club_id IS NULL OR away_club_id IS NULL
UNION ALL SELECT 'one_match_per_club_per_date', COUNT(*) = 0
  FROM (SELECT season, club_id, date FROM sides GROUP BY ALL HAVING COUNT(*) > 1)"""))
def run_tier(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.stg(spark, sf)
    return checks.run_tier([
        checks.matches_are_fresh(rows, AS_OF), checks.all_clubs_mapped(rows),
        checks.row_count_preserved(b.raw_matches(spark, sf), rows), checks.one_row_per_match(rows), checks.one_match_per_club_per_date(rows),
    ]).select("name", "passed")


@query(check(
    "expected_lag_nulls", "mart", "true",
    """'{"clubs":' || c || ',"after_unknown":' || (l - c) || ',"last_home_gate":' || l || ',"home_gate_ma3":' || m || '}'""",
    """(SELECT COUNT(DISTINCT home_club_id) AS c, COUNT(*) - COUNT(l.last_home_gate) AS l,
          COUNT(*) - COUNT(l.home_gate_ma3) AS m FROM stg_matches JOIN plain_lags l USING (match_id))""",
))
def expected_lag_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return checks.expected_lag_nulls(features.lags(b.stg(spark, sf)))


@query(check(
    "same_rows", "mart", "COUNT(*) = COUNT(DISTINCT match_id)", """'{"only_first":0,"only_second":0}'""", "mart"
))
def same_rows(spark: SparkSession, sf: str) -> DataFrame:
    from touchline.operators.learn import select_features

    mart = b.mart(spark, sf)
    return checks.same_rows(select_features(mart, "baseline"), select_features(mart, "prorel"))
