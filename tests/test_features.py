from __future__ import annotations

import datetime as dt

import pytest
from conftest import SEASON, day, round_robin, typed
from pyspark.sql import functions as F

from touchline import config
from touchline.operators import features
from touchline.operators.grounds import asof_stadium, resolve_weather, with_weather
from touchline.operators.staging import stg_matches


@pytest.fixture(scope="module")
def two_seasons(spark, league):
    _, aliases = league
    rows = round_robin(season=2023, seed=1) + [("n" + r[0], *r[1:]) for r in round_robin(season=2024, seed=2)]
    raw = spark.createDataFrame(
        rows,
        "match_id string, season int, date string, home_raw string, away_raw string, home_goals string, away_goals string, attendance string",
    )
    return stg_matches(raw, aliases)


@pytest.fixture(scope="module")
def clubs(spark):
    rows = [(f"t{k}", s, "East" if k < 4 else "West") for k in range(8) for s in (2023, 2024)]
    return spark.createDataFrame(rows, "club_id string, season int, conference string")


@pytest.fixture(scope="module")
def derbies(spark):
    return spark.createDataFrame([("t1", "t0"), ("t5", "t6")], "club_id_a string, club_id_b string")


@pytest.fixture(scope="module")
def mart(two_seasons, clubs, derbies):
    return features.mart_match_features(two_seasons, clubs, derbies, 2, 1).cache()


def test_catalogue_is_complete():
    assert set(config.EVIDENCE) == set(config.MODELS["prorel"])
    assert set(config.MODELS["prorel"]) - set(config.MODELS["baseline"]) == set(config.PROREL) and len(config.PROREL) == 7
    assert len(config.MODELS["prorel"]) == 20


def test_mart_columns_and_rows(mart, two_seasons):
    assert set(mart.columns) == set(config.MART_KEYS) | set(config.MODELS["prorel"])
    assert mart.count() == two_seasons.count() == mart.select("match_id").distinct().count() == 112


def test_only_lags_are_null(mart):
    for c in mart.columns:
        missing = mart.filter(F.col(c).isNull()).count()
        assert missing == 0 or c in config.NULLABLE_FEATURES, c
    assert mart.filter("last_home_gate is null").count() == 8


def test_derbies_go_both_ways(mart):
    found = {(r.home_club_id, r.opponent_club_id) for r in mart.filter("is_derby").collect()}
    assert found == {("t0", "t1"), ("t1", "t0"), ("t5", "t6"), ("t6", "t5")}


def test_opener_and_final(mart):
    counts = mart.groupBy("season", "home_club_id").agg(
        F.count_if("is_season_opener").alias("o"), F.count_if("is_final_home_match").alias("f"),
        F.min_by("is_season_opener", "date").alias("first"), F.max_by("is_final_home_match", "date").alias("last"),
    ).collect()
    assert len(counts) == 16 and all((r.o, r.f, r["first"], r["last"]) == (1, 1, True, True) for r in counts)


def test_same_fixture_last_season(mart):
    rows = {(r.season, r.home_club_id, r.opponent_club_id): r for r in mart.collect()}
    for (season, home, away), r in rows.items():
        before = rows.get((season - 1, home, away))
        assert r.same_fixture_last_season == (before.attendance if before else None)


def test_repeated_pairing_does_not_fan_out(spark):
    rows = [
        ("a", 2023, "2023-04-01", "x", "y", 1, 0, 100), ("b", 2023, "2023-05-01", "x", "y", 1, 0, 300),
        ("c", 2024, "2024-04-01", "x", "y", 1, 0, 500),
    ]
    got = features.same_fixture_last_season(typed(spark.createDataFrame(rows, SEASON)))
    assert {r.match_id: r.same_fixture_last_season for r in got.collect()} == {"a": None, "b": None, "c": 200.0}


def brute_stakes(matches, clubs, spots, down):
    """Lines, liveness and elimination from the definitions, club by club."""
    conf = {(r.club_id, r.season): r.conference for r in clubs.collect()}
    rows = matches.collect()
    out = {}
    for (club, season), c in conf.items():
        members = [k for (k, s), cc in conf.items() if s == season and cc == c]
        own = sorted({r.date for r in rows if r.season == season and club in (r.home_club_id, r.away_club_id)})
        eliminated = 0
        for date in own:
            def total(k):
                pts = gd = gf = n = 0
                for r in rows:
                    if r.season == season and r.date < date and r.home_goals is not None and k in (r.home_club_id, r.away_club_id):
                        f, a = (r.home_goals, r.away_goals) if r.home_club_id == k else (r.away_goals, r.home_goals)
                        pts += 3 if f > a else 1 if f == a else 0
                        gd, gf, n = gd + f - a, gf + f, n + 1
                return pts, gd, gf, n
            ranked = sorted((total(k)[:3] for k in members), reverse=True)
            mine = total(club)
            left = sum(club in (r.home_club_id, r.away_club_id) for r in rows if r.season == season) - mine[3]
            line, safe = ranked[spots - 1][0], ranked[len(ranked) - down - 1][0]
            live = mine[0] + 3 * left > line
            out[club, date] = (
                1 + sum(x > mine[:3] for x in ranked), left, line - mine[0], safe - mine[0], live, -1 if live else eliminated
            )
            eliminated += not live
    return out


def test_stakes_equal_brute_force(two_seasons, clubs):
    table = features.club_stakes(two_seasons, clubs, 2, 1).filter("scheduled > 0")
    want = brute_stakes(two_seasons, clubs, 2, 1)
    got = {
        (r.club_id, r.date): (
            r.rank_before, r.matches_remaining, r.points_from_playoff_line, r.points_from_relegation_line,
            r.is_mathematically_live, r.matches_since_elimination,
        ) for r in table.collect()
    }
    assert got == want
    assert any(v[-1] > 0 for v in got.values())


def test_spots_per_season_and_conference(spark, two_seasons, clubs):
    spots = spark.createDataFrame(
        [(s, c, 1 if c == "East" else 2) for s in (2023, 2024) for c in ("East", "West")],
        "season int, conference string, spots int",
    )
    varied = features.club_stakes(two_seasons, clubs, spots, 1)
    for conference, k in (("East", 1), ("West", 2)):
        fixed = features.club_stakes(two_seasons, clubs, k, 1).filter(F.col("conference") == conference)
        assert varied.filter(F.col("conference") == conference).select(fixed.columns).exceptAll(fixed).count() == 0


def test_unplayed_fixtures(spark, two_seasons, clubs, derbies, mart):
    cut = day("2024-05-01")
    later = F.col("date") >= F.lit(cut)
    blank = two_seasons.withColumns({
        c: F.when(~later, F.col(c)) for c in ("home_goals", "away_goals", "attendance")
    })
    ahead = features.mart_match_features(blank, clubs, derbies, 2, 1, include_unplayed=True)
    assert ahead.count() == 112 and ahead.filter(later & F.col("rank_before").isNull()).count() == 0
    done = features.mart_match_features(blank, clubs, derbies, 2, 1)
    assert done.filter(later).count() == 0
    before = mart.filter(~later)
    assert done.exceptAll(before).count() == 0 and before.exceptAll(done).count() == 0


def test_parity_mart_has_no_fan_out(two_seasons):
    rows = features.parity_mart(two_seasons)
    assert rows.count() == 112
    first = rows.filter("played_before = 0").select("pts_before", "rank_before").distinct().collect()
    assert [tuple(r) for r in first] == [(0, 1)]


def test_grounds(spark, tiny_season):
    def ranges(first_end, second_start):
        rows = [("club_a", "Old", "1", "2", "2017-01-01", first_end, ""), ("club_a", "New", "3", "4", second_start, "2099-12-31", "")]
        rows += [(f"club_{c}", c, "0", "0", "2017-01-01", "2099-12-31", "") for c in "bcd"]
        return spark.createDataFrame(rows, "club_id string, stadium string, lat string, lon string, valid_from string, valid_to string, note string")

    good = asof_stadium(tiny_season, ranges("2024-03-09", "2024-03-10"))
    assert {r.match_id: r.stadium for r in good.filter("home_club_id = 'club_a'").collect()} == {"m1": "Old", "m5": "New"}
    assert asof_stadium(tiny_season, ranges("2024-03-20", "2024-03-10")).count() == 7
    gap = asof_stadium(tiny_season, ranges("2024-03-10", "2024-03-20"))
    assert gap.count() == 6 and gap.filter("stadium is null").count() == 1

    schema = "location string, date date, temperature_2m_max double, weather_source string, forecast_horizon_days int"
    weather = spark.createDataFrame([
        ("Old", day("2024-03-02"), 9.0, "forecast", 3), ("Old", day("2024-03-02"), 8.0, "forecast", 7),
        ("Old", day("2024-03-02"), 7.0, "archive", None), ("New", day("2024-03-16"), 5.0, "forecast", 7),
        ("New", day("2024-03-16"), 4.0, "forecast", 2),
    ], schema)
    best = resolve_weather(weather)
    assert {(r.location, r.temperature_2m_max, r.upgraded) for r in best.collect()} == {("Old", 7.0, True), ("New", 4.0, False)}
    joined = with_weather(good, best)
    assert joined.count() == 6 and joined.filter("weather_source is not null").count() == 2
