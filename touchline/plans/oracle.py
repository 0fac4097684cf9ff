"""The same tables and results in plain SQL, written without the Spark code's shortcuts."""

from __future__ import annotations

CTES = """
payload AS (
  SELECT o_orderkey AS id,
    CAST(year(o_orderdate) AS VARCHAR) || '/' || CAST(year(o_orderdate) + 1 AS VARCHAR) AS season,
    CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) * 86400
      + (o_orderkey % 24) * 3600 AS date_unix,
    CAST(o_orderdate AS DATE) AS day,
    CAST(c_nationkey AS BIGINT) AS "homeID",
    CAST((c_nationkey + 1 + o_orderkey % 24) % 25 AS BIGINT) AS "awayID",
    'Ground ' || CAST(c_nationkey AS VARCHAR) AS stadium_name,
    CASE WHEN o_orderdate < DATE '2001-06-01' THEN (o_orderkey * 7 + o_custkey * 3) % 5 END AS "homeGoalCount",
    CASE WHEN o_orderdate < DATE '2001-06-01' THEN (o_orderkey * 11 + o_custkey) % 4 END AS "awayGoalCount",
    CASE WHEN o_orderdate >= DATE '2001-06-01' THEN NULL
      WHEN o_orderkey % 50 = 0 THEN 'n/a' WHEN o_orderkey % 50 = 1 THEN '' WHEN o_orderkey % 50 = 2 THEN '0'
      WHEN o_orderkey % 50 = 3 THEN NULL WHEN o_orderkey % 50 = 4 THEN '-1'
      WHEN o_orderkey % 50 = 5 THEN CAST(CAST(floor(o_totalprice / 10) AS BIGINT) AS VARCHAR) || '.0'
      ELSE CAST(CAST(floor(o_totalprice / 10) AS BIGINT) AS VARCHAR) END AS attendance
  FROM orders JOIN customer ON o_custkey = c_custkey
),
raw_matches AS (
  SELECT 'fs:' || CAST(id AS VARCHAR) AS match_id, CAST(year(day) AS INT) AS season,
    strftime(day, '%Y-%m-%d') AS date,
    CASE WHEN id % 10 = 3 THEN '  ' || CAST("homeID" AS VARCHAR) || ' ' ELSE CAST("homeID" AS VARCHAR) END AS home_raw,
    CAST("awayID" AS VARCHAR) AS away_raw,
    CAST("homeGoalCount" AS VARCHAR) AS home_goals, CAST("awayGoalCount" AS VARCHAR) AS away_goals,
    attendance, id
  FROM payload
),
club_aliases AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS raw_name, lower(n_name) AS club_id, 'id' AS note FROM nation
  UNION ALL SELECT n_name, lower(n_name), 'name' FROM nation
),
season_list AS (SELECT CAST(s AS INT) AS season FROM range(1995, 2002) t(s)),
club_conference AS (
  SELECT lower(n_name) AS club_id, season, r_name AS conference
  FROM nation CROSS JOIN season_list JOIN region
    ON r_regionkey = (n_regionkey + CASE WHEN season >= 1999 AND n_nationkey % 7 = 0 THEN 1 ELSE 0 END) % 5
),
derbies AS (
  SELECT lower(a.n_name) AS club_id_a, lower(b.n_name) AS club_id_b
  FROM nation a JOIN nation b ON (a.n_nationkey + 1) % 25 = b.n_nationkey
),
stadiums AS (
  SELECT lower(n_name) AS club_id, 'Old Ground ' || CAST(n_nationkey AS VARCHAR) AS stadium, n_nationkey * 1.5 AS lat,
    n_nationkey * -2.0 AS lon, DATE '1900-01-01' AS valid_from, DATE '1997-12-31' AS valid_to FROM nation
  UNION ALL
  SELECT lower(n_name), 'New Ground ' || CAST(n_nationkey AS VARCHAR), n_nationkey * 1.5 + 0.25,
    n_nationkey * -2.0 - 0.25, DATE '1998-01-01', DATE '2099-12-31' FROM nation
),
stg_matches AS (
  SELECT match_id, season, CAST(date AS DATE) AS date, home_raw, away_raw,
    h.club_id AS home_club_id, a.club_id AS away_club_id,
    CAST(home_goals AS INT) AS home_goals, CAST(away_goals AS INT) AS away_goals,
    CASE WHEN TRY_CAST(attendance AS INT) > 0 THEN TRY_CAST(attendance AS INT) END AS attendance,
    CAST(dayofweek(CAST(date AS DATE)) AS INT) AS day_of_week, CAST(month(CAST(date AS DATE)) AS INT) AS month,
    dayofweek(CAST(date AS DATE)) IN (0, 6) AS is_weekend, dayofweek(CAST(date AS DATE)) IN (2, 3, 4) AS is_midweek,
    CAST(date AS DATE) BETWEEN DATE '1998-03-01' AND DATE '1998-08-31' AS is_covid_affected
  FROM raw_matches LEFT JOIN club_aliases h ON trim(home_raw) = h.raw_name
    LEFT JOIN club_aliases a ON trim(away_raw) = a.raw_name
),
sides AS (
  SELECT match_id, season, date, home_club_id AS club_id, away_club_id AS opponent_club_id, true AS is_home,
    home_goals AS gf, away_goals AS ga FROM stg_matches
  UNION ALL
  SELECT match_id, season, date, away_club_id, home_club_id, false, away_goals, home_goals FROM stg_matches
),
club_matches AS (
  SELECT *, CASE WHEN gf > ga THEN 3 WHEN gf = ga THEN 1 ELSE 0 END AS points FROM sides WHERE gf IS NOT NULL
),
running AS (
  SELECT DISTINCT season, club_id, date,
    CAST(COALESCE(SUM(points) OVER w, 0) AS BIGINT) AS pts_before,
    CAST(COALESCE(SUM(gf - ga) OVER w, 0) AS BIGINT) AS gd_before,
    CAST(COALESCE(SUM(gf) OVER w, 0) AS BIGINT) AS gf_before,
    COUNT(*) OVER w AS played_before
  FROM club_matches
  WINDOW w AS (PARTITION BY season, club_id ORDER BY date
    RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING)
),
in_action AS (
  SELECT *, CAST(RANK() OVER (PARTITION BY season, date
    ORDER BY pts_before DESC, gd_before DESC, gf_before DESC) AS INT) AS rank_before
  FROM running
),
final_table AS (
  SELECT season, club_id, CAST(SUM(points) AS BIGINT) AS pts, CAST(SUM(gf - ga) AS BIGINT) AS gd,
    CAST(SUM(gf) AS BIGINT) AS gf
  FROM club_matches GROUP BY ALL
),
club_dates AS (
  SELECT DISTINCT s.season, conference, s.club_id, date
  FROM sides s JOIN club_conference c ON c.club_id = s.club_id AND c.season = s.season
),
grid AS (
  SELECT d.season, d.conference, c.club_id, d.date
  FROM (SELECT DISTINCT season, conference, date FROM club_dates) d
  JOIN (SELECT DISTINCT season, conference, club_id FROM club_dates) c
    ON c.season = d.season AND c.conference = d.conference
),
field AS (
  SELECT g.season, g.conference, g.club_id, g.date, COUNT(m.match_id) AS played_before,
    CAST(COALESCE(SUM(m.points), 0) AS BIGINT) AS pts_before,
    CAST(COALESCE(SUM(m.gf - m.ga), 0) AS BIGINT) AS gd_before,
    CAST(COALESCE(SUM(m.gf), 0) AS BIGINT) AS gf_before
  FROM grid g LEFT JOIN club_matches m ON m.club_id = g.club_id AND m.season = g.season AND m.date < g.date
  GROUP BY ALL
),
int_standings AS (
  SELECT *, CAST(RANK() OVER (PARTITION BY season, conference, date
    ORDER BY pts_before DESC, gd_before DESC, gf_before DESC) AS INT) AS rank_before
  FROM field
),
fixtures AS (SELECT season, club_id, COUNT(*) AS fixtures FROM sides GROUP BY ALL),
placed AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY season, conference, date ORDER BY pts_before DESC) AS place,
    COUNT(*) OVER (PARTITION BY season, conference, date) AS members
  FROM int_standings
),
lines AS (
  SELECT season, conference, date,
    MAX(CASE WHEN place = least(2, members) THEN pts_before END) AS playoff_pts,
    MAX(CASE WHEN place = greatest(members - 1, 1) THEN pts_before END) AS safe_pts
  FROM placed GROUP BY ALL
),
alive AS (
  SELECT s.*, f.fixtures - played_before AS matches_remaining,
    playoff_pts - pts_before AS points_from_playoff_line, safe_pts - pts_before AS points_from_relegation_line,
    pts_before + 3 * (f.fixtures - played_before) > playoff_pts AS is_mathematically_live
  FROM int_standings s JOIN lines USING (season, conference, date) JOIN fixtures f USING (season, club_id)
),
own_days AS (SELECT season, club_id, date, COUNT(*) AS scheduled FROM sides GROUP BY ALL),
stakes AS (
  SELECT a.*, CAST(CASE WHEN is_mathematically_live THEN -1 ELSE COALESCE((
      SELECT SUM(o.scheduled) FROM own_days o JOIN alive b USING (season, club_id, date)
      WHERE o.season = a.season AND o.club_id = a.club_id AND o.date < a.date AND NOT b.is_mathematically_live
    ), 0) END AS BIGINT) AS matches_since_elimination
  FROM alive a SEMI JOIN own_days USING (season, club_id, date)
),
history AS (
  SELECT match_id, home_club_id, season, date, attendance, is_covid_affected AS hidden,
    COUNT(*) FILTER (NOT is_covid_affected) OVER (PARTITION BY home_club_id ORDER BY date, match_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS k,
    ROW_NUMBER() OVER (PARTITION BY home_club_id, is_covid_affected ORDER BY date, match_id) AS rn
  FROM stg_matches
),
masked_lags AS (
  SELECT a.match_id,
    MAX(b.attendance) FILTER (b.rn = a.k) AS last_home_gate,
    AVG(b.attendance) FILTER (b.rn > a.k - 3) AS home_gate_ma3,
    AVG(b.attendance) AS home_gate_ma5
  FROM history a CROSS JOIN range(5) r(i)
  LEFT JOIN history b ON b.home_club_id = a.home_club_id AND b.rn = a.k - r.i AND NOT b.hidden
  GROUP BY a.match_id
),
plain_lags AS (
  SELECT match_id, LAG(attendance) OVER w AS last_home_gate,
    AVG(attendance) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS home_gate_ma3,
    AVG(attendance) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS home_gate_ma5
  FROM stg_matches WINDOW w AS (PARTITION BY home_club_id ORDER BY date, match_id)
),
pairings AS (
  SELECT season, home_club_id, away_club_id, AVG(attendance) AS figure
  FROM stg_matches WHERE NOT is_covid_affected GROUP BY ALL
),
flags AS (
  SELECT match_id,
    ROW_NUMBER() OVER (PARTITION BY season, home_club_id ORDER BY date, match_id) = 1 AS is_season_opener,
    ROW_NUMBER() OVER (PARTITION BY season, home_club_id ORDER BY date DESC, match_id DESC) = 1 AS is_final_home_match
  FROM stg_matches
),
derby_flags AS (
  SELECT match_id, EXISTS (SELECT 1 FROM derbies d WHERE
    (d.club_id_a = m.home_club_id AND d.club_id_b = m.away_club_id)
    OR (d.club_id_b = m.home_club_id AND d.club_id_a = m.away_club_id)) AS is_derby
  FROM stg_matches m
),
mart_all AS (
  SELECT m.match_id, m.season, m.date, m.home_club_id, m.attendance, m.is_covid_affected,
    m.day_of_week, m.month, m.is_weekend, m.is_midweek,
    l.last_home_gate, l.home_gate_ma3, l.home_gate_ma5, p.figure AS same_fixture_last_season,
    m.away_club_id AS opponent_club_id, is_derby, h.matches_remaining, is_season_opener, is_final_home_match,
    h.rank_before, a.rank_before AS opponent_rank_before, a.rank_before - h.rank_before AS rank_gap,
    h.points_from_playoff_line, h.is_mathematically_live, h.matches_since_elimination,
    h.points_from_relegation_line, m.home_goals IS NOT NULL AS was_played
  FROM stg_matches m
  JOIN stakes h ON h.season = m.season AND h.club_id = m.home_club_id AND h.date = m.date
  JOIN stakes a ON a.season = m.season AND a.club_id = m.away_club_id AND a.date = m.date
  JOIN masked_lags l ON l.match_id = m.match_id
  JOIN flags f ON f.match_id = m.match_id
  JOIN derby_flags d ON d.match_id = m.match_id
  LEFT JOIN pairings p ON p.season = m.season - 1 AND p.home_club_id = m.home_club_id
    AND p.away_club_id = m.away_club_id
),
mart AS (SELECT * EXCLUDE (was_played) FROM mart_all WHERE was_played),
parity AS (
  SELECT m.match_id, m.season, m.date, m.home_club_id, m.attendance, m.day_of_week, m.month, m.is_weekend,
    m.is_midweek, l.last_home_gate, l.home_gate_ma3, m.away_club_id AS opponent_club_id,
    h.rank_before, a.rank_before AS opponent_rank_before, a.rank_before - h.rank_before AS rank_gap,
    h.pts_before, h.played_before
  FROM stg_matches m
  JOIN in_action h ON h.season = m.season AND h.club_id = m.home_club_id AND h.date = m.date
  JOIN in_action a ON a.season = m.season AND a.club_id = m.away_club_id AND a.date = m.date
  LEFT JOIN plain_lags l ON l.match_id = m.match_id
  WHERE m.home_goals IS NOT NULL
),
with_grounds AS (
  SELECT m.*, s.stadium, s.lat, s.lon FROM stg_matches m LEFT JOIN stadiums s
    ON s.club_id = m.home_club_id AND m.date BETWEEN s.valid_from AND s.valid_to
),
weather_days AS (
  SELECT DISTINCT stadium AS location, date,
    (date_diff('day', DATE '1970-01-01', date) * 7 + length(stadium) * 13) % 40 AS code
  FROM with_grounds
),
weather AS (
  SELECT location, date, CAST(code + s - 5 AS DOUBLE) AS temperature_2m_max,
    CAST(code + s - 12 AS DOUBLE) AS temperature_2m_min, CAST((code + s) % 9 AS DOUBLE) AS precipitation_sum,
    CAST((code + s) % 31 AS DOUBLE) AS wind_speed_10m_max, CAST((code + s) * 2 AS DOUBLE) AS cloud_cover_mean,
    weather_source, forecast_horizon_days
  FROM weather_days CROSS JOIN (VALUES ('forecast', 7, 3), ('forecast', 3, 1), ('archive', NULL, 0))
    v(weather_source, forecast_horizon_days, s)
  WHERE weather_source = 'forecast' OR date < DATE '2001-06-01'
),
best_weather AS (
  SELECT location, date, temperature_2m_max, temperature_2m_min, precipitation_sum, wind_speed_10m_max,
    cloud_cover_mean, weather_source, CAST(forecast_horizon_days AS INT) AS forecast_horizon_days,
    weather_source = 'archive' AS upgraded
  FROM weather QUALIFY ROW_NUMBER() OVER (PARTITION BY location, date
    ORDER BY weather_source, forecast_horizon_days) = 1
),
predictions AS (
  SELECT match_id, model_name, CAST(date_trunc('month', date) AS DATE) AS run_date,
    COALESCE(CAST(attendance AS DOUBLE), 25000.0) + (CAST(substr(match_id, 4) AS BIGINT) * a) % b - (b - 1) / 2 AS predicted,
    CAST(attendance AS DOUBLE) AS actual
  FROM stg_matches CROSS JOIN (VALUES ('baseline', 13, 2001), ('prorel', 17, 1801)) v(model_name, a, b)
),
metrics AS (
  SELECT model_name, run_date, AVG(abs(predicted - actual)) AS mae, AVG(abs((predicted - actual) / actual)) AS mape,
    sqrt(AVG((predicted - actual) * (predicted - actual))) AS rmse, COUNT(*) AS n_test
  FROM predictions WHERE actual IS NOT NULL GROUP BY ALL
),
stage_events AS (
  SELECT 'r' || CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id,
    CASE event_id % 4 WHEN 0 THEN 'ingest' WHEN 1 THEN 'transform' WHEN 2 THEN 'train' ELSE 'export' END AS stage,
    ts AS event_ts, CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed' ELSE 'running' END AS status,
    event_id AS rows_read, event_id % 3 AS rows_inserted, event_id % 2 AS rows_updated,
    CAST(ts AS DATE) AS max_match_date, value AS null_attendance_pct
  FROM events
),
runs AS (
  SELECT run_id, stage, MIN(event_ts) OVER w AS started_at,
    CASE WHEN status <> 'running' THEN MAX(CASE WHEN status <> 'running' THEN event_ts END) OVER w END AS finished_at,
    status, rows_read, rows_inserted, rows_updated, max_match_date, null_attendance_pct
  FROM stage_events
  WINDOW w AS (PARTITION BY run_id, stage ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
  QUALIFY ROW_NUMBER() OVER (PARTITION BY run_id, stage ORDER BY event_ts DESC, rows_read DESC) = 1
)
"""


def sql(select: str, *extra: str) -> str:
    """A statement over the derived tables, optionally with more of them."""
    return "WITH " + ",\n".join([CTES.strip(), *extra]) + "\n" + select
