"""Each check on good data, and on the fault it exists for."""

from __future__ import annotations

import json

import pytest
from conftest import day, one
from pyspark.sql import Window
from pyspark.sql import functions as F

from touchline.operators import checks, features
from touchline.operators import standings as st
from touchline.operators.grounds import asof_stadium
from touchline.operators.staging import map_clubs, stg_matches, unmapped_names, unmapped_raw


@pytest.fixture(scope="module")
def stg(league):
    return stg_matches(*league).cache()


@pytest.fixture(scope="module")
def parity(stg):
    return features.parity_mart(stg).cache()


def passed(check):
    return one(check).passed


def detail(check):
    return json.loads(one(check).metadata)


def test_good_data_passes(league, stg, parity):
    raw, _ = league
    results = checks.run_tier([
        checks.all_clubs_mapped(stg), checks.row_count_preserved(raw, stg), checks.one_row_per_match(stg),
        checks.one_match_per_club_per_date(stg), checks.no_leakage(stg, parity), checks.first_match_is_zero(parity),
        checks.final_table_matches(stg), checks.mart_matches_staging(stg, parity),
        checks.expected_lag_nulls(features.lags(stg)), checks.same_rows(stg, parity),
    ])
    assert checks.gate(results).count() == 10
    assert detail(checks.expected_lag_nulls(features.lags(stg))) == {
        "clubs": 8, "after_unknown": 0, "last_home_gate": 8, "home_gate_ma3": 8
    }


def test_missing_alias_is_named(league):
    raw, aliases = league
    rows = stg_matches(raw, aliases.filter("club_id <> 't3'"))
    assert detail(checks.all_clubs_mapped(rows)) == {"unmapped": 1, "names": ["t3"]}
    assert passed(checks.row_count_preserved(raw, rows))
    assert [r.name for r in unmapped_names(rows).collect()] == ["t3"]
    assert [r.name for r in unmapped_raw(raw, aliases.filter("club_id <> 't3'")).collect()] == ["t3"]
    with pytest.raises(checks.CheckFailure, match="t3"):
        checks.gate(checks.all_clubs_mapped(rows))


def test_inner_join_shows_in_the_row_count_only(league):
    raw, aliases = league
    rows = stg_matches(raw, aliases.filter("club_id <> 't3'")).dropna(subset=["home_club_id", "away_club_id"])
    assert rows.count() == 42
    assert passed(checks.all_clubs_mapped(rows)) and not passed(checks.row_count_preserved(raw, rows))


def test_two_clubs_on_one_id(league):
    raw, aliases = league
    merged = aliases.withColumn("club_id", F.when(F.col("club_id") == "t3", "t4").otherwise(F.col("club_id")))
    rows = stg_matches(raw, merged)
    assert passed(checks.all_clubs_mapped(rows)) and not passed(checks.one_match_per_club_per_date(rows))


def test_same_match_twice(league):
    raw, aliases = league
    twice = raw.unionByName(raw.filter("match_id = 'm000'"))
    rows = stg_matches(twice, aliases)
    assert passed(checks.row_count_preserved(twice, rows))
    assert not passed(checks.one_match_per_club_per_date(rows))
    assert detail(checks.one_row_per_match(rows)) == {"duplicated": 1, "first": "m000"}
    assert features.parity_mart(rows).count() == 57


def test_frame_that_includes_the_current_match(stg, parity):
    upto = Window.partitionBy("season", "club_id").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    leaky = st.club_days(stg).withColumn("pts_before", F.sum("points").over(upto))
    wrong = parity.drop("pts_before").join(
        leaky.select("season", F.col("club_id").alias("home_club_id"), "date", "pts_before"), ["season", "home_club_id", "date"]
    )
    assert not passed(checks.no_leakage(stg, wrong))
    assert not passed(checks.no_future_leakage(stg, leaky))
    assert passed(checks.no_future_leakage(stg, st.running_totals(st.club_days(stg))))


def test_wrong_standings_are_offending(spark, stg):
    clubs = spark.createDataFrame([(f"t{k}", 2024, "East", "") for k in range(8)], "club_id string, season int, conference string, display_name string")
    good = st.int_standings(stg, clubs).cache()
    assert detail(checks.no_future_leakage(stg, good)) == {"compared": good.count(), "offending": 0}
    shifted = good.withColumn("gd_before", F.col("gd_before") + 5)
    assert detail(checks.no_future_leakage(stg, shifted))["offending"] == good.count()
    some = good.filter("club_id <> 't3'")
    assert detail(checks.no_future_leakage(stg, some))["offending"] == 14
    assert checks.leaked_rows(stg, some).count() == 14
    resting = good.join(checks.club_dates(stg), ["season", "club_id", "date"], "left_anti").select(good.columns).limit(1)
    wrong = good.exceptAll(resting).unionByName(resting.withColumn("pts_before", F.lit(99).cast("bigint")))
    assert detail(checks.no_future_leakage(stg, wrong))["offending"] == resting.count()


def test_more_names_than_fit_a_page(spark, league):
    raw, aliases = league
    rows = spark.range(1500).select(F.format_string("x%04d", "id").alias("home_raw"))
    many = raw.limit(1).drop("home_raw", "match_id").crossJoin(rows).withColumn("match_id", F.col("home_raw"))
    found = detail(checks.all_clubs_mapped(stg_matches(many.select(raw.columns), aliases)))
    assert found["unmapped"] == 1500 and found["names"][-1] == "x1499"


def test_first_match_not_zeroed(parity):
    wrong = parity.withColumn("pts_before", F.when(F.col("played_before") > 0, F.col("pts_before")))
    assert not passed(checks.first_match_is_zero(wrong))


def test_freshness(stg):
    newest = stg.agg(F.max("date")).first()[0]
    assert passed(checks.matches_are_fresh(stg, newest))
    assert not passed(checks.matches_are_fresh(stg, day("2024-08-01")))
    assert passed(checks.matches_are_fresh(stg, day("2025-01-20")))
    assert detail(checks.matches_are_fresh(stg, day("2024-08-01")))["latest_match"] == newest.isoformat()


def test_lost_mart_rows_and_injected_nulls(spark, stg):
    assert not passed(checks.mart_matches_staging(stg, stg.limit(3)))
    clubs = stg.select("home_club_id").distinct().select(
        F.col("home_club_id").alias("club_id"), F.lit(2024).alias("season"), F.lit("East").alias("conference")
    )
    none = spark.createDataFrame([], "club_id_a string, club_id_b string")
    mart = features.mart_match_features(stg, clubs, none, 2, 1)
    assert passed(checks.features_not_null(mart)) and passed(checks.mart_columns_match_definitions(mart))
    bad = mart.withColumn("rank_gap", F.when(F.col("match_id") != "m005", F.col("rank_gap")))
    assert detail(checks.features_not_null(bad))["rank_gap"] == 1 and not passed(checks.features_not_null(bad))
    other = mart.withColumnRenamed("rank_gap", "rank_difference")
    assert detail(checks.mart_columns_match_definitions(other)) == {"missing": ["rank_gap"], "extra": ["rank_difference"]}


def test_lag_nulls_count_unknown_gates(stg):
    holes = stg.withColumn("attendance", F.when(~F.col("match_id").isin("m000", "m001", "m055"), F.col("attendance")))
    found = checks.expected_lag_nulls(features.lags(holes))
    assert passed(found) and detail(found)["last_home_gate"] > 8
    broken = features.lags(holes).withColumn("last_home_gate", F.coalesce("last_home_gate", F.lit(0)))
    assert not passed(checks.expected_lag_nulls(broken))


def test_stadium_overlap_and_gap(spark, stg):
    rows = [(f"t{k}", "g", "0", "0", "2000-01-01", "2099-12-31") for k in range(8)]
    schema = "club_id string, stadium string, lat string, lon string, valid_from string, valid_to string"
    fine = spark.createDataFrame(rows, schema)
    assert passed(checks.one_stadium_per_match(asof_stadium(stg, fine)))
    overlap = fine.unionByName(fine.filter("club_id = 't1'").withColumn("stadium", F.lit("h")))
    assert detail(checks.one_stadium_per_match(asof_stadium(stg, overlap)))["several"] == 7
    assert detail(checks.one_stadium_per_match(asof_stadium(stg, fine.filter("club_id <> 't1'"))))["without"] == 7


def test_same_rows_in_both_directions(stg):
    assert not passed(checks.same_rows(stg, stg.filter("match_id <> 'm001'")))
    assert detail(checks.same_rows(stg.filter("match_id <> 'm001'"), stg)) == {"only_first": 0, "only_second": 1}


def test_staging_keeps_placeholders_out(spark, league):
    raw, aliases = league
    dirty = raw.limit(1).withColumn("attendance", F.explode(F.array(*[F.lit(v) for v in ("5000.0", "0", "-1", "", "n/a")])))
    got = [r.attendance for r in stg_matches(dirty, aliases).collect()]
    assert sorted(got, key=str) == [5000, None, None, None, None]
    kept = [r.attendance for r in stg_matches(dirty, aliases, keep_placeholders=True).collect()]
    assert sorted(kept, key=str) == [-1, 0, 5000, None, None]


def test_score_text_is_split(spark, league):
    raw, aliases = league
    scored = raw.withColumn("score", F.concat_ws("-", "home_goals", "away_goals")).drop("home_goals", "away_goals")
    a, b = stg_matches(scored, aliases), stg_matches(raw, aliases)
    assert a.exceptAll(b).count() == 0 and a.count() == 56


def test_numeric_ids_and_spacing_map(spark):
    raw = spark.createDataFrame([("m", 93.0, " 7 ")], "match_id string, home_raw double, away_raw string")
    aliases = spark.createDataFrame([("93", "x"), ("7", "y")], "raw_name string, club_id string")
    got = one(map_clubs(raw, aliases))
    assert (got.home_club_id, got.away_club_id) == ("x", "y")
