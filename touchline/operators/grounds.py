"""Grounds with validity ranges, and the weather at them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def asof_stadium(matches: DataFrame, stadiums: DataFrame) -> DataFrame:
    """The home club's ground on the match date; none leaves nulls, overlaps repeat the match."""
    grounds = stadiums.select(
        F.col("club_id").alias("_club"), "stadium",
        *[F.col(c).cast("double").alias(c) for c in ("lat", "lon")],
        *[F.to_date(c).alias(c) for c in ("valid_from", "valid_to")],
    )
    hit = (F.col("home_club_id") == F.col("_club")) & F.col("date").between(F.col("valid_from"), F.col("valid_to"))
    return matches.join(grounds, hit, "left").drop("_club", "valid_from", "valid_to")


def resolve_weather(weather: DataFrame) -> DataFrame:
    """One row per place and day: observed beats forecast, a short horizon beats a long one.

    ``upgraded`` marks observations that replaced a forecast.
    """
    key = ["location", "date"]
    others = [c for c in weather.columns if c not in key]
    preference = F.struct(
        (F.col("weather_source") != "archive").alias("guess"), "forecast_horizon_days", *sorted(others)
    )
    return (
        weather.groupBy(*key)
        .agg(
            F.min_by(F.struct(*others), preference).alias("_best"),
            F.count_if(F.col("weather_source") == "forecast").alias("_guesses"),
        )
        .select(
            *key, "_best.*",
            ((F.col("_best.weather_source") == "archive") & (F.col("_guesses") > 0)).alias("upgraded"),
        )
    )


def with_weather(matches: DataFrame, weather: DataFrame) -> DataFrame:
    """Daily weather of the match's ground (``stadium``), left-joined on place and date."""
    return matches.join(weather.withColumnRenamed("location", "stadium"), ["stadium", "date"], "left")
