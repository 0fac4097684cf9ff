"""Report queries behind the dashboard views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.config import GATE_FIELD_HINTS, USABLE_SHARE
from touchline.functions.values import is_populated, is_present
from touchline.operators.ordered import order_statistics
from touchline.session import stage


def find_fields(df: DataFrame, hints: Sequence[str] = GATE_FIELD_HINTS) -> list[str]:
    """Columns whose name suggests a gate figure."""
    return [c for c in df.columns if any(h in c.lower() for h in hints)]


def null_coverage(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Present and total rows per field; zero counts as present."""
    counts = df.agg(F.count("*").alias("total"), *[F.count_if(is_present(F.col(c))).alias(c) for c in fields])
    return counts.unpivot("total", list(fields), "field", "present").select("field", "present", "total")


def coverage_gate(df: DataFrame, fields: Sequence[str] | None = None, threshold: float = USABLE_SHARE) -> DataFrame:
    """Populated share, minimum, upper median, maximum and verdict per candidate field."""
    fields = list(fields or find_fields(df))
    long = df.select(F.inline(F.array(*[
        F.struct(
            F.lit(c).alias("field"),
            F.when(is_populated(F.col(c)), F.col(c).cast("string").try_cast("double")).alias("figure"),
        ) for c in fields
    ])))
    counts = long.groupBy("field").agg(
        F.count("*").alias("total"), F.count("figure").alias("populated"),
        F.min("figure").alias("min"), F.max("figure").alias("max"),
    )
    middle = order_statistics(long, ["field"], "figure", {"median": F.floor(F.col("n") / 2)})
    share = F.col("populated") / F.col("total")
    return counts.join(middle.select("field", "median"), "field", "left").select(
        "field", "populated", "total", share.alias("share"), "min", "median", "max",
        (share >= threshold).alias("usable"),
    )


def decay_curve(mart: DataFrame) -> DataFrame:
    """Gates of eliminated clubs against their own mean before elimination."""
    clean = mart.filter(~F.col("is_covid_affected"))
    own = clean.filter("matches_since_elimination < 0").groupBy("season", "home_club_id").agg(
        F.avg("attendance").alias("_own")
    )
    return (
        clean.filter("matches_since_elimination >= 0")
        .join(stage(own, "own-means"), ["season", "home_club_id"], "left")
        .groupBy("matches_since_elimination")
        .agg(F.count("*").alias("n"), F.avg(F.col("attendance") / F.col("_own")).alias("index_vs_own_baseline"))
    )


def decay_vs_live(mart: DataFrame) -> DataFrame:
    """Mean gates of eliminated and still-live clubs within the same week."""
    out = F.col("matches_since_elimination") >= 0
    gate = F.col("attendance")
    return (
        mart.filter(~F.col("is_covid_affected"))
        .groupBy(F.to_date(F.date_trunc("week", "date")).alias("week"))
        .agg(
            F.count_if(out).alias("n_eliminated"), F.count_if(~out).alias("n_live"),
            F.avg(F.when(out, gate)).alias("eliminated_mean"), F.avg(F.when(~out, gate)).alias("live_mean"),
        )
        .filter("n_eliminated > 0 and n_live > 0")
        .withColumn("difference", F.col("eliminated_mean") - F.col("live_mean"))
    )


def rank_attendance_fit(mart: DataFrame) -> DataFrame:
    """Least-squares line of attendance on table position."""
    x, y = F.col("rank_before"), F.col("attendance")
    known = mart.filter(x.isNotNull() & y.isNotNull())
    return known.agg(
        F.count("*").alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"), F.corr(y, x).alias("correlation"),
    )


def actual_vs_predicted(predictions: DataFrame, mart: DataFrame) -> DataFrame:
    """Mean actual and predicted gate per model and home club."""
    return (
        predictions.filter("actual is not null")
        .join(mart.select("match_id", "home_club_id"), "match_id")
        .groupBy("model_name", "home_club_id")
        .agg(F.count("*").alias("n"), F.avg("actual").alias("actual_mean"), F.avg("predicted").alias("predicted_mean"))
    )


def residual_band(
    predictions: DataFrame, by: Sequence[str] = ("model_name",), low: float = 0.1, high: float = 0.9
) -> DataFrame:
    """Mean absolute error and residual percentiles (interpolated, exact) per group."""
    known = predictions.filter("actual is not null").withColumn("residual", F.col("actual") - F.col("predicted"))
    position = {"low": (F.col("n") - 1) * low, "high": (F.col("n") - 1) * high}
    ranks = {}
    for name, at in position.items():
        ranks |= {f"{name}_0": F.floor(at), f"{name}_1": F.ceil(at)}
    picks = order_statistics(known, by, "residual", ranks)
    bounds = []
    for name, at in position.items():
        below, above = F.col(f"{name}_0"), F.col(f"{name}_1")
        bounds.append((below + (above - below) * (at - F.floor(at))).alias(name))
    error = known.groupBy(*by).agg(F.avg(F.abs("residual")).alias("mae"))
    return error.join(picks.select(*by, "n", *bounds), list(by))


def forecast_band(forecasts: DataFrame, band: DataFrame, by: Sequence[str] = ("model_name",)) -> DataFrame:
    """Forecasts with the residual band around them; the bounds say which percentiles they are."""
    return forecasts.join(band, list(by), "left").select(
        *forecasts.columns,
        (F.col("predicted") + F.col("low")).alias("predicted_low"),
        (F.col("predicted") + F.col("high")).alias("predicted_high"),
    )


def compare_models(metrics: DataFrame) -> DataFrame:
    """How often the larger model had the lower error, by how much, against the spread."""
    gaps = (
        metrics.groupBy("run_date").pivot("model_name", ["baseline", "prorel"]).agg(F.first("mae"))
        .filter("baseline is not null and prorel is not null")
        .withColumn("gap", F.col("baseline") - F.col("prorel"))
    )
    return gaps.agg(
        F.count("*").alias("runs"), F.count_if(F.col("gap") > 0).alias("prorel_wins"),
        F.median("gap").alias("median_gap"), F.stddev_samp("gap").alias("sd_gap"),
    )


def gate_projection(fixtures: DataFrame, predictions: DataFrame) -> DataFrame:
    """Season gate per club: recorded so far, and with forecasts for the rest."""
    forecast = predictions.select("match_id", "predicted")
    gate = F.col("attendance").cast("double")
    return (
        fixtures.join(forecast, "match_id", "left")
        .groupBy("season", "home_club_id")
        .agg(
            F.count("*").alias("home_matches"), F.count("attendance").alias("recorded"),
            F.coalesce(F.sum(gate), F.lit(0.0)).alias("to_date"),
            F.coalesce(F.sum(F.coalesce(gate, "predicted")), F.lit(0.0)).alias("projected"),
        )
    )


def metric_history(metrics: DataFrame) -> DataFrame:
    """Error per model and run with its change, and the gap between the models with its sign."""
    runs = Window.partitionBy("model_name").orderBy("run_date")
    gap = F.max(F.when(F.col("model_name") == "baseline", F.col("mae"))) - F.max(
        F.when(F.col("model_name") == "prorel", F.col("mae"))
    )
    gaps = metrics.groupBy("run_date").agg(gap.alias("gap"))
    return (
        metrics.withColumn("mae_change", F.col("mae") - F.lag("mae").over(runs))
        .join(gaps, "run_date")
        .select("model_name", "run_date", "mae", "mae_change", "gap", F.signum("gap").cast("int").alias("gap_sign"))
    )


def top_features(importance: DataFrame, n: int = 10) -> DataFrame:
    """The n most important features per model and run; ties by name."""
    best = Window.partitionBy("model_name", "run_date").orderBy(F.desc("importance"), "feature")
    return importance.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= n)


def preview(mart: DataFrame, n: int) -> DataFrame:
    """The first n matches by date and id."""
    return mart.orderBy("date", "match_id").limit(n)
