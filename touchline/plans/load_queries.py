"""Sources, scalar functions and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.config import MODELS
from touchline.functions import calendar, keys, values
from touchline.operators import checks, features, grounds, learn, ordered, standings, staging
from touchline.plans import binding as b
from touchline.plans.oracle import sql
from touchline.plans.registry import query
from touchline.session import scratch_path
from touchline.sources import archive, tables

# --- sources -------------------------------------------------------------------------------


def archived(spark: SparkSession, sf: str) -> str:
    """Write the provider records as an archive: bodies of up to 500 matches, a folder per season."""
    path = scratch_path(spark, "archive")
    records = b.payload(spark, sf).withColumn("season_no", F.substring("season", 1, 4).cast("int") - 370)
    archive.write_archive(records, path, "season_no", F.floor(F.col("id") / 500))
    return path


def raw_target(spark: SparkSession, sf: str) -> DataFrame:
    return b.raw_matches(spark, sf).drop("ingested_at", "source_endpoint")


@query(sql("""
SELECT CAST(year(day) - 370 AS VARCHAR) AS season_id, CAST(id AS VARCHAR) AS id, season,
  CAST(date_unix AS VARCHAR) AS date_unix, CAST("homeID" AS VARCHAR) AS home_id, attendance,
  'league-matches' AS source_endpoint FROM payload"""))
def read_archive(spark: SparkSession, sf: str) -> DataFrame:
    return archive.read_archive(spark, archived(spark, sf), per_line=True).select(
        "season_id", "id", "season", "date_unix", F.col("homeID").alias("home_id"), "attendance", "source_endpoint"
    )


@query(sql("""
SELECT match_id, season, date, trim(home_raw) AS home_raw, away_raw, home_goals, away_goals, attendance
FROM raw_matches"""))
def to_raw_matches(spark: SparkSession, sf: str) -> DataFrame:
    records = archive.read_archive(spark, archived(spark, sf), per_line=True)
    return archive.to_raw_matches(records).drop("ingested_at", "source_endpoint")


@query("SELECT trim(regexp_replace(html, '[ \\t\\r\\n\\f]+', ' ', 'g')) AS body FROM pages")
def malformed_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Web pages saved in place of responses end up in quarantine, the responses do not."""
    path = archived(spark, sf)
    pages = b.table(spark, sf, "pages").select(
        F.trim(F.regexp_replace("html", "[ \\t\\r\\n\\f]+", " ")).alias("value")
    )
    pages.write.text(f"{path}/endpoint=league-matches/season_id=0")
    return archive.malformed(spark, path, per_line=True).select("body")


@query(sql("""
SELECT 'league-matches' AS endpoint, string_agg(DISTINCT CAST(year(day) - 370 AS VARCHAR), ','
  ORDER BY CAST(year(day) - 370 AS VARCHAR)) AS season_ids, COUNT(DISTINCT year(day)) <= COUNT(*) AS files_for_all,
  true AS whole_bytes, true AS oldest_first FROM payload"""))
def archive_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Files, bytes and ages depend on the writer; they are held against a read of all contents."""
    path = archived(spark, sf)
    contents = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).agg(
        F.count("*").alias("n"), F.sum(F.length("content")).alias("size")
    )
    return archive.archive_summary(spark, path).join(F.broadcast(contents), F.lit(True)).select(
        "endpoint", F.array_join("season_ids", ",").alias("season_ids"),
        ((F.col("files") == F.col("n")) & (F.col("files") >= F.size("season_ids"))).alias("files_for_all"),
        (F.col("bytes") == F.col("size")).alias("whole_bytes"), (F.col("oldest") <= F.col("newest")).alias("oldest_first"),
    )


@query(sql("""
SELECT CAST(s AS INT) AS season, CAST(s - 370 AS VARCHAR) AS season_id FROM range(1995, 2003) t(s)
WHERE s NOT IN (SELECT year(day) FROM payload)"""))
def archive_missing(spark: SparkSession, sf: str) -> DataFrame:
    records = archive.read_archive(spark, archived(spark, sf), per_line=True)
    return archive.archive_missing(b.seasons(spark, sf), records)


@query(sql("""
SELECT 'club_aliases' AS file, raw_name AS a, club_id AS b, note AS c FROM club_aliases
UNION ALL SELECT 'club_conference', club_id, CAST(season AS VARCHAR), conference FROM club_conference
UNION ALL SELECT 'derbies', club_id_a, club_id_b, NULL FROM derbies
UNION ALL SELECT 'seasons', CAST(s AS VARCHAR), CAST(s - 370 AS VARCHAR), NULL FROM range(1995, 2003) t(s)
UNION ALL SELECT 'stadiums', club_id, stadium, CAST(valid_from AS VARCHAR) FROM stadiums"""))
def read_reference(spark: SparkSession, sf: str) -> DataFrame:
    """All five hand-kept files, written with stray blanks around their first keys, through one reader."""
    path = scratch_path(spark, "reference")
    made = {
        "club_aliases": b.aliases, "club_conference": b.club_conference, "derbies": b.derbies, "seasons": b.seasons, "stadiums": b.stadiums,
    }
    for name, make in made.items():
        rows = make(spark, sf)
        rows = rows.select(*[(F.col(c).cast("string") if c in rows.columns else F.lit(None).cast("string")).alias(c) for c in tables.REFERENCE[name]])
        first = rows.columns[0]
        rows.withColumn(first, F.concat(F.lit(" "), first, F.lit("  "))).write.option("header", True).option(
            "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{path}/{name}.csv")
    third = {"club_aliases": "note", "club_conference": "conference", "stadiums": "valid_from"}
    shown = None
    for name, rows in tables.read_reference(spark, path).items():
        keys = [F.col(c) for c in tables.REFERENCE[name][:2]]
        last = F.col(third[name]) if name in third else F.lit(None).cast("string")
        part = rows.select(F.lit(name).alias("file"), keys[0].alias("a"), keys[1].alias("b"), last.alias("c"))
        shown = part if shown is None else shown.unionByName(part)
    return shown


@query(sql("""
SELECT CAST("homeID" AS VARCHAR) AS raw_name, lower(n_name) AS club_id, 'derived from payload' AS note
FROM (SELECT "homeID" FROM payload UNION SELECT "awayID" FROM payload) JOIN nation ON n_nationkey = "homeID" """))
def derive_aliases(spark: SparkSession, sf: str) -> DataFrame:
    return archive.derive_aliases(b.payload(spark, sf))


@query(sql("SELECT * FROM final_table"))
def export_csv(spark: SparkSession, sf: str) -> DataFrame:
    final = standings.final_table(b.stg(spark, sf))
    out = tables.export_csv(final, "final_table", scratch_path(spark, "extracts"))
    return spark.read.schema(final.schema).option("header", True).csv(out)


@query(sql("""
SELECT 'raw_matches' AS table_name, COUNT(*) AS n FROM raw_matches
UNION ALL SELECT 'stg_matches', COUNT(*) FROM stg_matches
UNION ALL SELECT 'mart_match_features', COUNT(*) FROM mart"""))
def row_count(spark: SparkSession, sf: str) -> DataFrame:
    counted = {"raw_matches": b.raw_matches, "stg_matches": b.stg, "mart_match_features": b.mart}
    parts = [
        checks.row_count(make(spark, sf)).select(F.lit(name).alias("table_name"), "n")
        for name, make in counted.items()
    ]
    return checks.run_tier(parts)


# --- projections, predicates, scalar functions ---------------------------------------------


@query(sql("SELECT * FROM stg_matches"))
def stg_matches(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_matches(b.raw_matches(spark, sf), b.aliases(spark, sf), b.MASK)


@query(sql("SELECT match_id, TRY_CAST(attendance AS INT) AS attendance FROM raw_matches"))
def tolerant_cast(spark: SparkSession, sf: str) -> DataFrame:
    return b.raw_matches(spark, sf).select("match_id", values.to_int(F.col("attendance")).alias("attendance"))


@query(sql("SELECT match_id, COALESCE(TRY_CAST(attendance AS DOUBLE) > 0, false) AS populated FROM raw_matches"))
def is_populated(spark: SparkSession, sf: str) -> DataFrame:
    return b.raw_matches(spark, sf).select("match_id", values.is_populated(F.col("attendance")).alias("populated"))


@query(sql("SELECT match_id, attendance IS NOT NULL AND attendance NOT IN ('', '-1') AS present FROM raw_matches"))
def is_present(spark: SparkSession, sf: str) -> DataFrame:
    return b.raw_matches(spark, sf).select("match_id", values.is_present(F.col("attendance")).alias("present"))


@query(sql("""
SELECT match_id, CAST(home_goals AS INT) AS home_goals, CAST(away_goals AS INT) AS away_goals FROM raw_matches"""))
def split_score(spark: SparkSession, sf: str) -> DataFrame:
    score = F.concat("home_goals", F.lit("-"), "away_goals")
    home, away = values.split_score(score)
    return b.raw_matches(spark, sf).select("match_id", home.alias("home_goals"), away.alias("away_goals"))


@query(sql("SELECT match_id, trim(home_raw) AS home_key, away_raw AS away_key FROM raw_matches"))
def normalize_key(spark: SparkSession, sf: str) -> DataFrame:
    return b.raw_matches(spark, sf).select(
        "match_id", keys.normalize_key(F.col("home_raw")).alias("home_key"),
        keys.normalize_key(F.col("away_raw").cast("double"), numeric=True).alias("away_key"),
    )


@query("SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM part")
def slug(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "part").select("p_partkey", keys.slug(F.col("p_name")).alias("slug"))


@query(sql("SELECT match_id, day_of_week, month, is_weekend, is_midweek FROM stg_matches"))
def with_calendar(spark: SparkSession, sf: str) -> DataFrame:
    dated = b.raw_matches(spark, sf).select("match_id", F.to_date("date").alias("date"))
    return calendar.with_calendar(dated).drop("date")


@query(sql("SELECT match_id, is_covid_affected FROM stg_matches"))
def with_covid_flag(spark: SparkSession, sf: str) -> DataFrame:
    dated = b.raw_matches(spark, sf).select("match_id", F.to_date("date").alias("date"))
    return calendar.with_covid_flag(dated, b.MASK).drop("date")


@query(sql("""
SELECT match_id, date, attendance, is_covid_affected FROM mart
WHERE attendance IS NOT NULL AND NOT is_covid_affected"""))
def training_frame(spark: SparkSession, sf: str) -> DataFrame:
    return learn.training_frame(b.mart(spark, sf)).select("match_id", "date", "attendance", "is_covid_affected")


@query(sql("SELECT match_id FROM stg_matches WHERE home_goals IS NOT NULL"))
def played(spark: SparkSession, sf: str) -> DataFrame:
    return standings.played(b.stg(spark, sf)).select("match_id")


@query(sql("""
SELECT match_id, CASE WHEN home_goals > away_goals THEN 3 WHEN home_goals = away_goals THEN 1 ELSE 0 END AS home_points,
  CASE WHEN away_goals > home_goals THEN 3 WHEN home_goals = away_goals THEN 1 ELSE 0 END AS away_points
FROM stg_matches WHERE home_goals IS NOT NULL"""))
def points(spark: SparkSession, sf: str) -> DataFrame:
    home, away = F.col("home_goals"), F.col("away_goals")
    return standings.played(b.stg(spark, sf)).select(
        "match_id", values.points(home, away).alias("home_points"), values.points(away, home).alias("away_points")
    )


@query(sql("""
SELECT match_id AS by_id, 'fs:' || sha256(CAST(season AS VARCHAR) || '~' || date || '~' || home_raw || '~' || away_raw)
  AS by_key FROM raw_matches"""))
def with_match_id(spark: SparkSession, sf: str) -> DataFrame:
    raw = b.raw_matches(spark, sf)
    with_id = raw.withColumn("id", F.substring("match_id", 4, 20))
    by_key = keys.match_key(raw)
    return with_id.select(keys.match_key(with_id).alias("by_id"), by_key.alias("by_key"))


@query(sql("""
SELECT match_id, date BETWEEN make_date(year(date), 3, 1) AND make_date(year(date), 11, 15) AS in_season
FROM stg_matches"""))
def in_season(spark: SparkSession, sf: str) -> DataFrame:
    return b.stg(spark, sf).select("match_id", calendar.in_season(F.col("date")).alias("in_season"))


@query(sql("""
SELECT v.feature, evidence, is_prorel, nulls FROM (VALUES
  ('last_home_gate', 'measured', false, (SELECT COUNT(*) - COUNT(last_home_gate) FROM mart)),
  ('home_gate_ma3', 'measured', false, (SELECT COUNT(*) - COUNT(home_gate_ma3) FROM mart)),
  ('home_gate_ma5', 'measured', false, (SELECT COUNT(*) - COUNT(home_gate_ma5) FROM mart)),
  ('same_fixture_last_season', 'measured', false, (SELECT COUNT(*) - COUNT(same_fixture_last_season) FROM mart)),
  ('day_of_week', 'measured', false, 0), ('month', 'measured', false, 0), ('is_weekend', 'measured', false, 0),
  ('is_midweek', 'measured', false, 0), ('opponent_club_id', 'measured', false, 0), ('is_derby', 'measured', false, 0),
  ('matches_remaining', 'measured', false, 0), ('is_season_opener', 'measured', false, 0),
  ('is_final_home_match', 'measured', false, 0), ('matches_since_elimination', 'measured', true, 0),
  ('rank_before', 'proxy', true, 0), ('opponent_rank_before', 'proxy', true, 0), ('rank_gap', 'proxy', true, 0),
  ('points_from_playoff_line', 'proxy', true, 0), ('is_mathematically_live', 'proxy', true, 0),
  ('points_from_relegation_line', 'instrumented', true, 0)) v(feature, evidence, is_prorel, nulls)"""))
def feature_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """The catalogue next to each feature's nulls in the mart."""
    names = list(MODELS["prorel"])
    nulls = checks.null_counts(b.mart(spark, sf), names).unpivot("n", names, "feature", "nulls").drop("n")
    return learn.feature_catalog(spark).join(nulls, "feature")


@query(sql("""
SELECT match_id, date, home_club_id, attendance, day_of_week, month, is_weekend, is_midweek, last_home_gate,
  home_gate_ma3, home_gate_ma5, same_fixture_last_season, opponent_club_id, is_derby, matches_remaining,
  is_season_opener, is_final_home_match, matches_since_elimination, rank_before, opponent_rank_before, rank_gap,
  points_from_playoff_line, is_mathematically_live, points_from_relegation_line, true AS baseline_inside FROM mart"""))
def select_features(spark: SparkSession, sf: str) -> DataFrame:
    """The larger model's columns, and whether the smaller one's are among them and nothing else is."""
    small, large = (learn.select_features(b.mart(spark, sf), m) for m in ("baseline", "prorel"))
    more = [c for c in large.columns if c not in small.columns]
    return large.withColumn("baseline_inside", F.lit(set(small.columns) < set(large.columns) and len(more) == 7))


# --- joins -----------------------------------------------------------------------------------


@query(sql("""
SELECT match_id, h.club_id AS home_club_id, a.club_id AS away_club_id FROM raw_matches
LEFT JOIN (SELECT * FROM club_aliases WHERE club_id <> 'nation_24') h ON trim(home_raw) = h.raw_name
LEFT JOIN (SELECT * FROM club_aliases WHERE club_id <> 'nation_24') a ON away_raw = a.raw_name"""))
def map_clubs(spark: SparkSession, sf: str) -> DataFrame:
    return staging.map_clubs(b.raw_matches(spark, sf), b.aliases_without_last(spark, sf)).select(
        "match_id", "home_club_id", "away_club_id"
    )


@query(sql("""
SELECT s.match_id, s.season, s.club_id, c.conference, s.points FROM club_matches s
JOIN club_conference c ON c.club_id = s.club_id AND c.season = s.season"""))
def with_conference(spark: SparkSession, sf: str) -> DataFrame:
    sides = standings.unpivot_sides(standings.played(b.stg(spark, sf)))
    return standings.with_conference(sides, b.clubs(spark, sf)).select(
        "match_id", "season", "club_id", "conference", "points"
    )


@query(sql("""
SELECT c.club_id, season, conference, MIN(raw_name) AS display_name
FROM club_conference c JOIN club_aliases a ON a.club_id = c.club_id AND note = 'name' GROUP BY ALL"""))
def stg_clubs(spark: SparkSession, sf: str) -> DataFrame:
    return b.clubs(spark, sf)


@query(sql("""
SELECT m.match_id, h.rank_before, a.rank_before AS opponent_rank_before FROM stg_matches m
JOIN in_action h ON h.season = m.season AND h.club_id = m.home_club_id AND h.date = m.date
JOIN in_action a ON a.season = m.season AND a.club_id = m.away_club_id AND a.date = m.date
WHERE m.home_goals IS NOT NULL"""))
def standings_lookup(spark: SparkSession, sf: str) -> DataFrame:
    rows = standings.played(b.stg(spark, sf))
    ranks = standings.rank_in_action(standings.running_totals(standings.club_days(rows)))
    return features.with_sides(
        rows, ranks, {"rank_before": "rank_before"}, {"rank_before": "opponent_rank_before"}, "inner"
    ).select("match_id", "rank_before", "opponent_rank_before")


@query(sql("SELECT m.match_id, l.last_home_gate FROM stg_matches m LEFT JOIN plain_lags l USING (match_id)"))
def lag_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return features.lags(b.stg(spark, sf)).select("match_id", "last_home_gate")


@query(sql("SELECT season, conference, club_id, date FROM grid"))
def club_date_grid(spark: SparkSession, sf: str) -> DataFrame:
    days = standings.with_conference(standings.club_days(b.stg(spark, sf)), b.clubs(spark, sf))
    return standings.club_date_grid(days)


@query(sql("""
SELECT g.season, g.conference, g.club_id, g.date, r.date AS last_date, r.pts
FROM grid g ASOF LEFT JOIN totals r ON g.season = r.season AND g.club_id = r.club_id AND g.date > r.date""", """
day_points AS (SELECT season, club_id, date, SUM(points) AS points FROM club_matches GROUP BY ALL)""", """
totals AS (
  SELECT season, club_id, date,
    CAST(SUM(points) OVER (PARTITION BY season, club_id ORDER BY date) AS BIGINT) AS pts
  FROM day_points
)"""))
def asof_last(spark: SparkSession, sf: str) -> DataFrame:
    """Points including the latest earlier matchday, for every club on every date."""
    rows = b.stg(spark, sf)
    grid = standings.club_date_grid(standings.with_conference(standings.club_days(rows), b.clubs(spark, sf)))
    totals = standings.running_totals(standings.club_days(standings.played(rows)), keep=("points",)).select(
        "season", "club_id", "date", (F.col("pts_before") + F.col("points")).alias("pts"),
        F.col("date").alias("last_date"),
    )
    return ordered.asof_last(grid, totals, ["season", "club_id"], "date", ["last_date", "pts"])


@query(sql("""
SELECT m.match_id, p.figure AS same_fixture_last_season FROM stg_matches m LEFT JOIN pairings p
ON p.season = m.season - 1 AND p.home_club_id = m.home_club_id AND p.away_club_id = m.away_club_id"""))
def same_fixture_last_season(spark: SparkSession, sf: str) -> DataFrame:
    return features.same_fixture_last_season(b.stg(spark, sf), b.MASK).select("match_id", "same_fixture_last_season")


@query(sql("SELECT match_id, is_derby FROM derby_flags"))
def with_derby(spark: SparkSession, sf: str) -> DataFrame:
    return features.with_derby(b.stg(spark, sf), b.derbies(spark, sf)).select("match_id", "is_derby")


@query(sql("SELECT match_id, stadium, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon FROM with_grounds"))
def asof_stadium(spark: SparkSession, sf: str) -> DataFrame:
    return b.with_grounds(spark, sf).select("match_id", "stadium", "lat", "lon")


@query(sql("""
SELECT m.match_id, w.weather_source, w.temperature_2m_max, w.precipitation_sum
FROM with_grounds m LEFT JOIN best_weather w ON w.location = m.stadium AND w.date = m.date"""))
def with_weather(spark: SparkSession, sf: str) -> DataFrame:
    best = grounds.resolve_weather(b.weather(spark, sf))
    return grounds.with_weather(b.with_grounds(spark, sf), best).select(
        "match_id", "weather_source", "temperature_2m_max", "precipitation_sum"
    )


@query(sql("SELECT * FROM best_weather"))
def resolve_weather(spark: SparkSession, sf: str) -> DataFrame:
    return grounds.resolve_weather(b.weather(spark, sf))


@query(sql("""
SELECT DISTINCT name FROM (SELECT trim(home_raw) AS name FROM raw_matches UNION ALL SELECT away_raw FROM raw_matches)
WHERE name NOT IN (SELECT raw_name FROM club_aliases WHERE club_id <> 'nation_24')"""))
def unmapped_raw(spark: SparkSession, sf: str) -> DataFrame:
    return staging.unmapped_raw(b.raw_matches(spark, sf), b.aliases_without_last(spark, sf))


@query(sql("""
SELECT season, club_id, pts, gd, gf, pts + 1 AS published_pts, gd AS published_gd, gf AS published_gf
FROM final_table WHERE gd > 0"""))
def compare_table(spark: SparkSession, sf: str) -> DataFrame:
    """A published table that credits every club with a positive goal difference one point more."""
    final = standings.final_table(b.stg(spark, sf))
    published = final.withColumn("pts", F.col("pts") + F.when(F.col("gd") > 0, 1).otherwise(0))
    return standings.compare_table(final, published)
