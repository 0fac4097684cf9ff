"""League standings as they stood before each match date.

Everything works on club-days: one row per season, club and date. Pre-aggregating makes two
matches on one date safe (neither sees the other) and bounds every season-club window by the
days of a year.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.values import points
from touchline.operators.ordered import UNBOUNDED, tally_scores
from touchline.session import stage

TOTALS = ("pts_before", "gd_before", "gf_before", "played_before")
SCORE = ("pts_before", "gd_before", "gf_before")


SIDE_FIELDS = ("match_id", "season", "date", "club_id", "opponent_club_id", "is_home", "gf", "ga", "points")


def unpivot_sides(matches: DataFrame, fields: Sequence[str] = SIDE_FIELDS) -> DataFrame:
    """Two club rows per match from a single pass over the matches.

    Only what ``fields`` needs is put into the rows, so the scan reads no other column.
    """
    def side(own: str, other: str, is_home: bool):
        gf, ga = F.col(f"{own}_goals"), F.col(f"{other}_goals")
        made = {
            "club_id": F.col(f"{own}_club_id"), "opponent_club_id": F.col(f"{other}_club_id"),
            "is_home": F.lit(is_home), "gf": gf, "ga": ga,
            "points": F.when(gf.isNotNull() & ga.isNotNull(), points(gf, ga)),
        }
        return F.struct(*[made.get(f, F.col(f)).alias(f) for f in fields])

    return matches.select(F.inline(F.array(side("home", "away", True), side("away", "home", False))))


def played(matches: DataFrame) -> DataFrame:
    return matches.filter(F.col("home_goals").isNotNull())


def club_days(matches: DataFrame) -> DataFrame:
    """Scheduled and played matches, points and goals per season, club and date."""
    sides = unpivot_sides(matches, ("season", "club_id", "date", "gf", "ga", "points"))
    return sides.groupBy("season", "club_id", "date").agg(
        F.count("*").alias("scheduled"),
        F.count("points").alias("played"),
        F.coalesce(F.sum("points"), F.lit(0)).alias("points"),
        F.coalesce(F.sum(F.col("gf") - F.col("ga")), F.lit(0)).alias("gd"),
        F.coalesce(F.sum("gf"), F.lit(0)).alias("gf"),
    )


def running_totals(days: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Season totals strictly before each club-day, zero on the first one."""
    before = Window.partitionBy("season", "club_id").orderBy("date").rowsBetween(UNBOUNDED, -1)
    columns = dict(zip(TOTALS, ("points", "gd", "gf", "played")))
    totals = [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(t) for t, c in columns.items()]
    return days.select("season", "club_id", "date", *keep, *totals)


def with_conference(rows: DataFrame, clubs: DataFrame) -> DataFrame:
    """Attach the club-season's conference; a club-season without one drops out."""
    return rows.join(clubs.select("club_id", "season", "conference"), ["club_id", "season"])


def with_rank(table: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Shared ranks by points, goal difference and goals within ``scope``."""
    tallies = tally_scores(table, scope, SCORE)
    ranks = tallies.select(*scope, *SCORE, (F.col("ahead") + 1).cast("int").alias("rank_before"))
    return table.join(ranks, [*scope, *SCORE])


def rank_in_action(running: DataFrame, by_conference: bool = False) -> DataFrame:
    """Rank among the clubs that play on the date."""
    return with_rank(running, ["season", "conference", "date"] if by_conference else ["season", "date"])


def distinct_dates(club_dates: DataFrame) -> DataFrame:
    return club_dates.select("season", "conference", "date").distinct()


def club_seasons(club_dates: DataFrame) -> DataFrame:
    return club_dates.select("season", "conference", "club_id").distinct()


def club_date_grid(club_dates: DataFrame) -> DataFrame:
    """Every club of a conference on every match date of that conference's season.

    The dates of a season form one short array (a year's days at most), so the join matches
    each club-season with one row. The grid then grows out of it
    locally.
    """
    dates = distinct_dates(club_dates).groupBy("season", "conference").agg(
        F.collect_list("date").alias("_dates")
    )
    return (
        club_seasons(club_dates)
        .join(dates, ["season", "conference"])
        .select("season", "conference", "club_id", F.explode("_dates").alias("date"))
    )


def full_field(matches: DataFrame, clubs: DataFrame) -> DataFrame:
    """Totals of every club on every match date of its conference, with its matches that day.

    The club-days are written once: they are all that is needed of the matches, and a fraction
    of their size. Empty grid rows and club-days are then summed together, partitioned by
    club-season as the running totals need them.
    """
    days = stage(with_conference(club_days(matches), clubs), "club-days")
    figures = ("scheduled", "played", "points", "gd", "gf")
    empty = club_date_grid(days).select("*", *[F.lit(0).cast("bigint").alias(c) for c in figures])
    filled = (
        empty.unionByName(days).repartition("season", "club_id")
        .groupBy("season", "conference", "club_id", "date").agg(*[F.sum(c).alias(c) for c in figures])
    )
    return running_totals(filled, keep=("conference", "scheduled"))


def int_standings(matches: DataFrame, clubs: DataFrame, field: str = "full") -> DataFrame:
    """Conference table before each date: all clubs ("full") or those in action ("action")."""
    if field == "full":
        table = full_field(matches, clubs).drop("scheduled")
    else:
        table = with_conference(running_totals(club_days(matches)), clubs)
    return with_rank(table, ["season", "conference", "date"]).select(
        "season", "conference", "club_id", "date",
        "played_before", "pts_before", "gd_before", "gf_before", "rank_before",
    )


def final_table(matches: DataFrame) -> DataFrame:
    """Points, goal difference and goals per season and club."""
    sides = unpivot_sides(played(matches), ("season", "club_id", "gf", "ga", "points"))
    return sides.groupBy("season", "club_id").agg(
        F.sum("points").alias("pts"),
        F.sum(F.col("gf") - F.col("ga")).alias("gd"),
        F.sum("gf").alias("gf"),
    )


def compare_table(final: DataFrame, published: DataFrame) -> DataFrame:
    """Club-seasons whose computed row differs from the published one, or lacks a partner."""
    names = ("pts", "gd", "gf")
    theirs = published.select("season", "club_id", *[F.col(c).alias(f"published_{c}") for c in names])
    unequal = [~F.col(c).eqNullSafe(F.col(f"published_{c}")) for c in names]
    return final.join(theirs, ["season", "club_id"], "full_outer").filter(unequal[0] | unequal[1] | unequal[2])
