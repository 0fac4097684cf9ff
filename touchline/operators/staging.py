"""Typed staging tables and club mapping."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.config import COVID_RANGE
from touchline.functions.calendar import with_calendar, with_covid_flag
from touchline.functions.keys import normalized
from touchline.functions.values import gate_figure, split_score, to_int


def map_clubs(raw: DataFrame, aliases: DataFrame) -> DataFrame:
    """Add home_club_id and away_club_id; an unmapped side stays as a null.

    The alias table is joined without a hint: Catalyst broadcasts it when its files are small.
    """
    names = aliases.select(normalized(aliases, "raw_name").alias("_name"), "club_id")
    for side in ("home", "away"):
        lookup = names.withColumnRenamed("club_id", f"{side}_club_id")
        raw = raw.withColumn("_key", normalized(raw, f"{side}_raw"))
        raw = raw.join(lookup, F.col("_key") == F.col("_name"), "left").drop("_key", "_name")
    return raw


def stg_matches(
    raw: DataFrame, aliases: DataFrame, covid: tuple[dt.date, dt.date] | None = COVID_RANGE,
    keep_placeholders: bool = False,
) -> DataFrame:
    """One typed row per raw match.

    Attendance placeholders (zero, negative, text) become null; ``keep_placeholders`` only
    drops what is not a number. A raw table with ``score`` text is split into goals.
    """
    if "score" in raw.columns:
        home, away = split_score(F.col("score"))
        raw = raw.withColumns({"home_goals": home, "away_goals": away})
    figure = to_int if keep_placeholders else gate_figure
    typed = map_clubs(raw, aliases).select(
        "match_id",
        F.col("season").cast("int").alias("season"),
        F.to_date("date").alias("date"),
        "home_raw", "away_raw", "home_club_id", "away_club_id",
        to_int(F.col("home_goals")).alias("home_goals"),
        to_int(F.col("away_goals")).alias("away_goals"),
        figure(F.col("attendance")).alias("attendance"),
    )
    return with_covid_flag(with_calendar(typed), covid)


def stg_clubs(aliases: DataFrame, club_conference: DataFrame) -> DataFrame:
    """One row per club and season; the display name is the smallest non-numeric alias."""
    name = F.when(~F.col("raw_name").rlike(r"^\d+$"), F.col("raw_name"))
    display = aliases.groupBy("club_id").agg(F.min(name).alias("display_name"))
    seasons = club_conference.select("club_id", F.col("season").cast("int").alias("season"), "conference")
    return seasons.join(display, "club_id").select("club_id", "season", "conference", "display_name")


def unmapped_names(stg: DataFrame) -> DataFrame:
    """Distinct raw names, of either side, without a club."""
    sides = F.array(
        F.struct(F.col("home_raw").alias("name"), F.col("home_club_id").alias("club")),
        F.struct(F.col("away_raw").alias("name"), F.col("away_club_id").alias("club")),
    )
    return stg.select(F.inline(sides)).filter("club is null").select("name").distinct()


def unmapped_raw(raw: DataFrame, aliases: DataFrame) -> DataFrame:
    """The same names found by an anti-join on the alias table."""
    sides = F.array(normalized(raw, "home_raw"), normalized(raw, "away_raw"))
    known = aliases.select(normalized(aliases, "raw_name").alias("name"))
    return raw.select(F.explode(sides).alias("name")).distinct().join(known, "name", "left_anti")
