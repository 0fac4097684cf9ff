from __future__ import annotations

from conftest import SEASON, day, typed
from pyspark.sql import functions as F

from touchline.operators import standings as st
from touchline.operators.staging import stg_matches


def test_final_table(tiny_season):
    got = {r.club_id[-1]: (r.pts, r.gd, r.gf) for r in st.final_table(tiny_season).collect()}
    assert got == {"a": (7, 4, 6), "b": (4, -1, 2), "c": (3, 0, 2), "d": (1, -3, 3)}


def test_totals_exclude_the_day_itself(tiny_season):
    rows = st.running_totals(st.club_days(tiny_season)).filter("club_id = 'club_a'").orderBy("date").collect()
    assert [(r.pts_before, r.gd_before, r.gf_before, r.played_before) for r in rows] == [
        (0, 0, 0, 0), (3, 2, 2, 1), (6, 4, 5, 2)
    ]


def test_two_matches_on_one_date_do_not_see_each_other(spark):
    rows = [
        ("x", 2024, "2024-03-02", "a", "b", 1, 0, 1), ("y", 2024, "2024-03-02", "a", "c", 1, 0, 1),
        ("z", 2024, "2024-03-09", "a", "b", 1, 0, 1),
    ]
    table = st.running_totals(st.club_days(typed(spark.createDataFrame(rows, SEASON))))
    got = [(r.date.day, r.pts_before, r.played_before) for r in table.filter("club_id = 'a'").orderBy("date").collect()]
    assert got == [(2, 0, 0), (9, 6, 2)]


def test_ties_share_a_rank(tiny_season, tiny_clubs):
    first = st.int_standings(tiny_season, tiny_clubs).filter(F.col("date") == day("2024-03-02")).collect()
    assert len(first) == 4 and {r.rank_before for r in first} == {1}


def test_full_field_ranks_clubs_that_do_not_play(spark, tiny_season, tiny_clubs):
    extra = typed(spark.createDataFrame([("m7", 2024, "2024-03-20", "club_b", "club_d", 0, 0, 1)], SEASON))
    table = st.int_standings(tiny_season.unionByName(extra), tiny_clubs)
    last = {r.club_id[-1]: (r.pts_before, r.rank_before) for r in table.filter("date = date'2024-03-20'").collect()}
    assert last == {"a": (7, 1), "b": (4, 2), "c": (3, 3), "d": (1, 4)}
    acting = st.int_standings(tiny_season.unionByName(extra), tiny_clubs, field="action")
    assert {r.club_id[-1]: r.rank_before for r in acting.filter("date = date'2024-03-20'").collect()} == {"b": 1, "d": 2}


def test_each_conference_has_its_own_leader(spark, tiny_season, tiny_clubs):
    west = tiny_clubs.withColumn(
        "conference", F.when(F.col("club_id").isin("club_c", "club_d"), "West").otherwise("East")
    )
    rows = st.int_standings(tiny_season, west).filter("date = date'2024-03-16' and rank_before = 1").collect()
    assert {(r.conference, r.club_id) for r in rows} == {("East", "club_a"), ("West", "club_c")}


def test_club_season_without_conference_drops_out(tiny_season, tiny_clubs):
    rows = st.int_standings(tiny_season, tiny_clubs.filter("club_id <> 'club_d'"))
    assert rows.filter("club_id = 'club_d'").count() == 0 and rows.count() == 9


def test_compare_table(tiny_season):
    final = st.final_table(tiny_season)
    assert st.compare_table(final, final).count() == 0
    wrong = final.filter("club_id <> 'club_d'").withColumn("gf", F.when(F.col("club_id") == "club_a", 9).otherwise(F.col("gf")))
    assert {r.club_id for r in st.compare_table(final, wrong).collect()} == {"club_a", "club_d"}


def test_last_matchday_rank_is_the_final_table(league, spark):
    raw, aliases = league
    rows = stg_matches(raw, aliases)
    clubs = aliases.select("club_id", F.lit(2024).alias("season"), F.lit("East").alias("conference"))
    end = typed(spark.createDataFrame([("end", 2024, "2024-12-31", "t0", "t1", None, None, None)], SEASON))
    table = st.int_standings(rows.select(*end.columns).unionByName(end), clubs).filter("date = date'2024-12-31'")
    final = sorted(st.final_table(rows).collect(), key=lambda r: (-r.pts, -r.gd, -r.gf))
    got = {r.club_id: (r.pts_before, r.gd_before, r.gf_before) for r in table.collect()}
    assert got == {r.club_id: (r.pts, r.gd, r.gf) for r in final}
    assert [r.club_id for r in table.orderBy("rank_before").collect()][0] == final[0].club_id
