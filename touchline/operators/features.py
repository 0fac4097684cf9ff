"""Lag, context and stakes features, and the one-row-per-match mart."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.config import COVID_RANGE, MART_KEYS, MODELS, ROWS_PER_TASK
from touchline.functions.calendar import in_range
from touchline.operators.ordered import UNBOUNDED, prior_rows, tally_scores, with_chunk
from touchline.operators.standings import (
    club_days, full_field, played, rank_in_action, running_totals, unpivot_sides,
)
from touchline.session import stage

Bounds = tuple[dt.date, dt.date]


def lags(
    matches: DataFrame, by_season: bool = False, mask: Bounds | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """A club's previous home gate and the means of its last three and five.

    Ordered by date and match_id. Matches inside ``mask`` get features but never feed them.
    """
    club = ["home_club_id", "season"] if by_season else ["home_club_id"]
    rows = with_chunk(matches, [*club, "date"], "match_id", rows_per_task)
    rows = prior_rows(
        rows, club, ["date", "chunk"], ["match_id"], F.struct("attendance"), 5,
        skip=in_range(F.col("date"), mask), name="_gates",
    )
    gates = [F.get("_gates", F.size("_gates") - k)["attendance"] for k in range(1, 6)]
    return rows.withColumns({
        "last_home_gate": gates[0],
        "home_gate_ma3": _mean(gates[:3]),
        "home_gate_ma5": _mean(gates),
    }).drop("_gates", "chunk")


def _mean(values: Sequence[Column]) -> Column:
    """Mean of the non-null values, null without any."""
    total = sum((F.coalesce(v, F.lit(0)).cast("bigint") for v in values), F.lit(0).cast("bigint"))
    count = sum((v.isNotNull().cast("int") for v in values), F.lit(0))
    return total / F.nullif(count, F.lit(0))


PAIRING = ("season", "home_club_id", "away_club_id")
HOME_SEASON = ("season", "home_club_id")


def pairing_means(matches: DataFrame, mask: Bounds | None = None) -> DataFrame:
    """Mean gate per pairing, labelled with the season after; one row however often they met."""
    means = matches.filter(~in_range(F.col("date"), mask)).groupBy(*PAIRING).agg(
        F.avg("attendance").alias("same_fixture_last_season")
    )
    return stage(means.withColumn("season", F.col("season") + 1), "pairings")


def same_fixture_last_season(matches: DataFrame, mask: Bounds | None = None) -> DataFrame:
    """Mean gate of the same pairing at the same ground one season earlier."""
    return matches.join(pairing_means(matches, mask), list(PAIRING), "left")


def with_derby(matches: DataFrame, derbies: DataFrame, home: str = "home_club_id", away: str = "away_club_id") -> DataFrame:
    """Flag matches between an unordered pair of the derby list."""
    a, b = F.col("club_id_a"), F.col("club_id_b")
    pairs = derbies.select(
        F.least(a, b).alias("_one"), F.greatest(a, b).alias("_two"), F.lit(True).alias("_derby")
    ).distinct()
    one, two = F.least(home, away), F.greatest(home, away)
    hit = (F.col("_one") == one) & (F.col("_two") == two)
    return (
        matches.join(pairs, hit, "left")
        .withColumn("is_derby", F.coalesce("_derby", F.lit(False)))
        .drop("_one", "_two", "_derby")
    )


def season_ends(matches: DataFrame) -> DataFrame:
    """A club's first and last scheduled home match per season.

    The first and last day come from a hash aggregate over all matches; ids are compared only
    among the matches of those two days.
    """
    schedule = matches.select(*HOME_SEASON, "date", "match_id")
    days = stage(
        schedule.groupBy(*HOME_SEASON).agg(F.min("date").alias("_from"), F.max("date").alias("_to")), "season-days"
    )
    on_first, on_last = F.col("date") == F.col("_from"), F.col("date") == F.col("_to")
    ends = schedule.join(days, list(HOME_SEASON)).filter(on_first | on_last).groupBy(*HOME_SEASON).agg(
        F.min(F.when(on_first, F.col("match_id"))).alias("_first"),
        F.max(F.when(on_last, F.col("match_id"))).alias("_last"),
    )
    return stage(ends, "season-ends")


def with_season_ends(rows: DataFrame, ends: DataFrame) -> DataFrame:
    return rows.join(ends, list(HOME_SEASON), "left").withColumns({
        "is_season_opener": F.coalesce(F.col("match_id") == F.col("_first"), F.lit(False)),
        "is_final_home_match": F.coalesce(F.col("match_id") == F.col("_last"), F.lit(False)),
    }).drop("_first", "_last")


def opener_and_final(matches: DataFrame) -> DataFrame:
    """Flag a club's first and last scheduled home match of the season."""
    return with_season_ends(matches, season_ends(matches))


def fixture_counts(matches: DataFrame) -> DataFrame:
    """Scheduled matches per season and club, played or not."""
    return unpivot_sides(matches, ("season", "club_id")).groupBy("season", "club_id").agg(
        F.count("*").alias("fixtures")
    )


def club_stakes(
    matches: DataFrame, clubs: DataFrame, playoff_spots: int | DataFrame, relegation_spots: int | DataFrame
) -> DataFrame:
    """Conference table and stakes of every club on every match date.

    Spots are numbers, or tables (season, conference, spots). Lines fall back to the last or
    first place where a conference has too few clubs. Ranks and lines both come from counted
    scores. Liveness compares the club's ceiling with the points now held by the last
    qualifying place, strictly.
    """
    scope = ["season", "conference", "date"]
    score = ["pts_before", "gd_before", "gf_before"]
    table = stage(full_field(matches, clubs), "full-field")
    tallies = tally_scores(table, scope, score)
    for name, spots in (("_in", playoff_spots), ("_down", relegation_spots)):
        if isinstance(spots, DataFrame):
            tallies = tallies.join(
                spots.select("season", "conference", F.col("spots").alias(name)), ["season", "conference"], "left"
            )
        else:
            tallies = tallies.withColumn(name, F.lit(spots))
    everyone = Window.partitionBy(*scope)
    def points_at(place: Column) -> Column:
        return F.max(F.when(F.col("upto") >= place, F.col("pts_before"))).over(everyone)

    ranked = tallies.select(
        *scope, *score,
        (F.col("ahead") + 1).cast("int").alias("rank_before"),
        points_at(F.least("_in", "members")).alias("playoff_pts"),
        points_at(F.greatest(F.col("members") - F.col("_down"), F.lit(1))).alias("safe_pts"),
    )
    season = Window.partitionBy("season", "club_id")
    so_far = season.orderBy("date").rowsBetween(UNBOUNDED, -1)
    dead = F.sum(F.when(~F.col("is_mathematically_live"), F.col("scheduled")).otherwise(0)).over(so_far)
    return (
        table.join(ranked, [*scope, *score])
        .withColumn("matches_remaining", F.sum("scheduled").over(season) - F.col("played_before"))
        .withColumns({
            "points_from_playoff_line": F.col("playoff_pts") - F.col("pts_before"),
            "points_from_relegation_line": F.col("safe_pts") - F.col("pts_before"),
            "is_mathematically_live":
                F.col("pts_before") + 3 * F.col("matches_remaining") > F.col("playoff_pts"),
        })
        .withColumn(
            "matches_since_elimination",
            F.when(F.col("is_mathematically_live"), F.lit(-1)).otherwise(F.coalesce(dead, F.lit(0))).cast("bigint"),
        )
        .drop("safe_pts", "playoff_pts")
    )


def with_sides(matches: DataFrame, table: DataFrame, home: dict[str, str], away: dict[str, str], how: str) -> DataFrame:
    """Join a (season, club_id, date) table for both sides, under the given column names."""
    for side, names in (("home", home), ("away", away)):
        part = table.select(
            "season", "date", F.col("club_id").alias(f"{side}_club_id"),
            *[F.col(c).alias(n) for c, n in names.items()],
        )
        matches = matches.join(part, ["season", "date", f"{side}_club_id"], how)
    return matches


def mart_match_features(
    matches: DataFrame, clubs: DataFrame, derbies: DataFrame,
    playoff_spots: int | DataFrame, relegation_spots: int | DataFrame,
    mask: Bounds | None = COVID_RANGE, include_unplayed: bool = False,
    lags_by_season: bool = False, rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """One row per match with every feature of both models.

    ``include_unplayed`` keeps fixtures without a result, which forecasts need.
    """
    def own_days() -> DataFrame:
        table = club_stakes(matches, clubs, playoff_spots, relegation_spots)
        return stage(table.filter("scheduled > 0"), "stakes")

    # The side tables do not depend on each other, so their jobs share the cluster.
    with ThreadPoolExecutor(max_workers=3) as pool:
        stakes, means, ends = (
            pool.submit(own_days), pool.submit(pairing_means, matches, mask), pool.submit(season_ends, matches)
        )
        rows = lags(matches, lags_by_season, mask, rows_per_task)
    rows = with_season_ends(rows.join(means.result(), list(PAIRING), "left"), ends.result())
    stakes = stakes.result()
    if not include_unplayed:
        rows = played(rows)
    own = {c: c for c in (
        "rank_before", "matches_remaining", "points_from_playoff_line", "is_mathematically_live",
        "matches_since_elimination", "points_from_relegation_line",
    )}
    rows = with_sides(rows, stakes, own, {"rank_before": "opponent_rank_before"}, "inner")
    rows = with_derby(rows, derbies).withColumns({
        "rank_gap": F.col("opponent_rank_before") - F.col("rank_before"),
        "opponent_club_id": F.col("away_club_id"),
    })
    return rows.select(*MART_KEYS, *MODELS["prorel"])


def parity_mart(matches: DataFrame) -> DataFrame:
    """The short mart: league-wide rank among clubs in action, lags without a mask."""
    table = stage(rank_in_action(running_totals(club_days(played(matches)))), "in-action")
    rows = played(lags(matches))
    rows = with_sides(
        rows, table,
        {c: c for c in ("rank_before", "pts_before", "played_before")},
        {"rank_before": "opponent_rank_before"}, "inner",
    )
    return rows.select(
        "match_id", "season", "date", "home_club_id", "attendance",
        "day_of_week", "month", "is_weekend", "is_midweek",
        "last_home_gate", "home_gate_ma3",
        F.col("away_club_id").alias("opponent_club_id"),
        "rank_before", "opponent_rank_before",
        (F.col("opponent_rank_before") - F.col("rank_before")).alias("rank_gap"),
        "pts_before", "played_before",
    )
