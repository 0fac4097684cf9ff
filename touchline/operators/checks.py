"""Data-quality checks. Each returns one row: name, tier, passed, metadata (JSON text)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.config import (
    LAGS, MART_KEYS, MAX_MATCH_AGE_DAYS, MODELS, NULLABLE_FEATURES, REQUIRED_FIELDS,
)
from touchline.functions.calendar import in_season
from touchline.operators.ordered import UNBOUNDED
from touchline.operators.standings import TOTALS, club_days, final_table, played, running_totals, unpivot_sides
from touchline.operators.staging import unmapped_names


class CheckFailure(RuntimeError):
    """A tier has failing checks."""


def _result(df: DataFrame, name: str, tier: str, passed: Column, **metadata: Column) -> DataFrame:
    """Shape a one-row frame into a check row."""
    detail = F.to_json(F.struct(*[c.alias(n) for n, c in metadata.items()]), {"ignoreNullFields": "false"})
    return df.select(
        F.lit(name).alias("name"), F.lit(tier).alias("tier"),
        F.coalesce(passed, F.lit(False)).alias("passed"), detail.alias("metadata"),
    )


def _pair(a: DataFrame, b: DataFrame, left: str, right: str) -> DataFrame:
    """Two one-row counts as one row."""
    sides = [
        a.agg(F.count("*").alias("n")).select(F.lit(left).alias("side"), "n"),
        b.agg(F.count("*").alias("n")).select(F.lit(right).alias("side"), "n"),
    ]
    at = [F.max(F.when(F.col("side") == s, F.col("n"))).alias(s) for s in (left, right)]
    return sides[0].union(sides[1]).agg(*at)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls per column, in one pass."""
    return df.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def matches_are_fresh(matches: DataFrame, as_of: dt.date, max_age: int = MAX_MATCH_AGE_DAYS) -> DataFrame:
    """The newest match is recent, or it is the off-season."""
    today = F.lit(as_of)
    newest = played(matches).agg(F.max("date").alias("latest"))
    age = F.datediff(today, F.col("latest"))
    return _result(
        newest, "matches_are_fresh", "staging", (age <= max_age) | ~in_season(today),
        latest_match=F.col("latest"), age_days=age,
    )


def all_clubs_mapped(stg: DataFrame) -> DataFrame:
    """No raw name without a club. All distinct names are listed: as many as there are spellings of clubs."""
    names = unmapped_names(stg).agg(F.count("*").alias("n"), F.array_sort(F.collect_list("name")).alias("listed"))
    return _result(
        names, "all_clubs_mapped", "staging", F.col("n") == 0, unmapped=F.col("n"), names=F.col("listed")
    )


def details(name: str, offenders: DataFrame) -> DataFrame:
    """Every offender of a check as a row: the check's name and the offender as JSON text."""
    return offenders.select(F.lit(name).alias("check_name"), F.to_json(F.struct(*offenders.columns)).alias("offender"))


def row_count_preserved(raw: DataFrame, stg: DataFrame) -> DataFrame:
    """Staging has as many rows as raw, neither fewer nor more."""
    return _result(
        _pair(raw, stg, "raw", "stg"), "row_count_preserved", "staging",
        F.col("raw") == F.col("stg"), raw=F.col("raw"), stg=F.col("stg"),
    )


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def one_row_per_match(stg: DataFrame) -> DataFrame:
    found = duplicates(stg, ["match_id"]).agg(F.count("*").alias("n"), F.min("match_id").alias("first"))
    return _result(
        found, "one_row_per_match", "staging", F.col("n") == 0, duplicated=F.col("n"), first=F.col("first")
    )


def club_dates(stg: DataFrame) -> DataFrame:
    """Season, club and date of both sides of every match."""
    return unpivot_sides(stg, ("season", "club_id", "date"))


def one_match_per_club_per_date(stg: DataFrame) -> DataFrame:
    found = duplicates(club_dates(stg), ["season", "club_id", "date"]).agg(
        F.count("*").alias("n"), F.min(F.struct("date", "season", "club_id")).alias("first")
    )
    return _result(
        found, "one_match_per_club_per_date", "staging", F.col("n") == 0,
        duplicated=F.col("n"), first_date=F.col("first.date"), first_club=F.col("first.club_id"),
    )


def no_future_leakage(matches: DataFrame, standings: DataFrame) -> DataFrame:
    """Standings equal totals recomputed over a day range that ends the day before."""
    compared = _recomputed(matches, standings).agg(F.count("*").alias("n"), F.count_if("bad").alias("bad"))
    return _result(
        compared, "no_future_leakage", "intermediate", F.col("bad") == 0,
        compared=F.col("n"), offending=F.col("bad"),
    )


def leaked_rows(matches: DataFrame, standings: DataFrame) -> DataFrame:
    """Rows of the standings that say something else than the matches before them, and missing ones."""
    return _recomputed(matches, standings).filter("bad").drop("bad")


def _recomputed(matches: DataFrame, standings: DataFrame) -> DataFrame:
    """Every row of the standings and every club-day of the matches, with ``bad``.

    A club-day that the standings lack is bad, and so is any total of theirs that differs.
    """
    key, sums = ["season", "club_id", "date"], dict(zip(TOTALS, ("points", "gd", "gf", "played")))
    days = club_days(played(matches)).select(*key, *sums.values(), F.lit(0).alias("_listed"))
    listed = standings.select(*key, *[F.lit(0).cast("bigint").alias(c) for c in sums.values()], F.lit(1).alias("_listed"))
    both = days.unionByName(listed).groupBy(*key).agg(
        *[F.sum(c).alias(c) for c in sums.values()], F.max("_listed").alias("_listed")
    )
    earlier = Window.partitionBy("season", "club_id").orderBy(F.unix_date("date")).rangeBetween(UNBOUNDED, -1)
    expected = both.select(
        *key, "_listed", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{t}") for t, c in sums.items()]
    )
    compared = [t for t in TOTALS if t in standings.columns]
    bad = F.col("_listed") == 0
    for t in compared:
        bad = bad | ~F.col(t).eqNullSafe(F.col(f"_{t}"))
    return expected.join(standings.select(*key, *compared), key, "left").select(*key, *compared, bad.alias("bad"))


def club_sequence(matches: DataFrame) -> DataFrame:
    """Each club's playing days of a season in order, with the points of the day before."""
    order = Window.partitionBy("season", "club_id").orderBy("date")
    return club_days(played(matches)).select(
        "season", "club_id", "date", "points",
        F.row_number().over(order).alias("n"), F.lag("points").over(order).alias("prev_points"),
    )


def no_leakage(matches: DataFrame, mart: DataFrame) -> DataFrame:
    """On a club's second day, its points so far are those of its first."""
    second = club_sequence(matches).filter("n = 2")
    bad = mart.join(
        second.withColumnRenamed("club_id", "home_club_id"), ["season", "home_club_id", "date"]
    ).agg(F.count_if(~F.col("pts_before").eqNullSafe(F.col("prev_points"))).alias("bad"))
    return _result(bad, "no_leakage", "mart", F.col("bad") == 0, offending=F.col("bad"))


def first_match_is_zero(mart: DataFrame) -> DataFrame:
    wrong = (F.col("played_before") == 0) & (F.col("pts_before").isNull() | (F.col("pts_before") != 0))
    return _result(
        mart.agg(F.count_if(wrong).alias("bad")), "first_match_is_zero", "mart",
        F.col("bad") == 0, offending=F.col("bad"),
    )


def final_table_matches(matches: DataFrame) -> DataFrame:
    """Summed points equal the last running total plus the last day's points."""
    days = club_days(played(matches))
    totals = running_totals(days, keep=("points",))
    last = totals.groupBy("season", "club_id").agg(
        F.max_by(F.col("pts_before") + F.col("points"), "date").alias("_route")
    )
    compared = final_table(matches).join(last, ["season", "club_id"], "full_outer").agg(
        F.count("*").alias("n"), F.count_if(~F.col("pts").eqNullSafe(F.col("_route"))).alias("bad")
    )
    return _result(
        compared, "final_table", "mart", F.col("bad") == 0, club_seasons=F.col("n"), mismatches=F.col("bad")
    )


def features_not_null(mart: DataFrame, allowed: Sequence[str] = NULLABLE_FEATURES) -> DataFrame:
    """Nulls only in the lag columns."""
    strict = [c for c in MODELS["prorel"] if c not in allowed]
    counts = null_counts(mart, strict)
    total = sum((F.col(c) for c in strict), F.lit(0))
    return _result(counts, "features_not_null", "mart", total == 0, **{c: F.col(c) for c in strict})


def mart_matches_staging(stg: DataFrame, mart: DataFrame) -> DataFrame:
    return _result(
        _pair(played(stg), mart, "playable", "mart"), "mart_matches_staging", "mart",
        F.col("playable") == F.col("mart"), playable=F.col("playable"), mart=F.col("mart"),
    )


def mart_columns_match_definitions(mart: DataFrame) -> DataFrame:
    """Every defined feature is a column and every other column is a key."""
    have, want = set(mart.columns) - set(MART_KEYS), set(MODELS["prorel"])
    missing, extra = sorted(want - have), sorted(have - want)
    names = mart.sparkSession.createDataFrame([(missing, extra)], "missing array<string>, extra array<string>")
    return _result(
        names, "mart_columns_match_definitions", "mart",
        (F.size("missing") == 0) & (F.size("extra") == 0), missing=F.col("missing"), extra=F.col("extra"),
    )


def one_stadium_per_match(with_stadium: DataFrame) -> DataFrame:
    """Every match found exactly one ground."""
    hits = with_stadium.groupBy("match_id").agg(F.count("stadium").alias("k")).agg(
        F.count_if(F.col("k") == 0).alias("none"), F.count_if(F.col("k") > 1).alias("several")
    )
    return _result(
        hits, "one_stadium_per_match", "staging", F.col("none") + F.col("several") == 0,
        without=F.col("none"), several=F.col("several"),
    )


def drifted_records(records: DataFrame, required: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    """Archived records that lack a required field, with what is missing and what was found."""
    found = F.json_object_keys("record")
    missing = F.array_except(F.array(*[F.lit(c) for c in required]), found)
    return (
        records.withColumns({"missing": F.array_sort(missing), "found": F.array_sort(found)})
        .filter(F.size("missing") > 0)
    )


def schema_drift(records: DataFrame, required: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    """Every record carries the required fields; the message names both sides of one that does not."""
    bad = drifted_records(records, required).agg(
        F.count("*").alias("n"), F.min(F.struct("missing", "found")).alias("first")
    )
    return _result(
        bad, "schema_drift", "staging", F.col("n") == 0,
        records=F.col("n"), missing=F.col("first.missing"), found=F.col("first.found"),
    )


def bodies_parse(bodies: DataFrame) -> DataFrame:
    """Every archived body is a response; ``bodies`` has a ``parsed`` column."""
    counts = bodies.agg(F.count("*").alias("n"), F.count_if(~F.col("parsed")).alias("bad"))
    return _result(
        counts, "bodies_parse", "ingest", F.col("bad") == 0, parsed=F.col("n") - F.col("bad"), unparsed=F.col("bad")
    )


def expected_lag_nulls(with_lags: DataFrame) -> DataFrame:
    """The last gate is missing for a club's first home match, and after an unknown gate.

    Takes all matches with their lags. An unknown gate counts unless no home match follows it.
    The mean of three is missing no more often, and at least once per club.
    """
    unknown = F.col("attendance").isNull().cast("int")
    clubs = with_lags.groupBy("home_club_id").agg(
        (F.sum(unknown) - F.max_by(unknown, F.struct("date", "match_id"))).alias("after_unknown"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in LAGS[:2]],
    )
    counts = clubs.agg(
        F.count("*").alias("clubs"), F.sum("after_unknown").alias("after_unknown"),
        *[F.sum(c).alias(c) for c in LAGS[:2]],
    )
    exact = F.col(LAGS[0]) == F.col("clubs") + F.col("after_unknown")
    bounded = F.col(LAGS[1]).between(F.col("clubs"), F.col(LAGS[0]))
    names = ("clubs", "after_unknown", *LAGS[:2])
    return _result(
        counts, "expected_lag_nulls", "mart", exact & bounded, **{c: F.col(c) for c in names}
    )


def same_rows(a: DataFrame, b: DataFrame, key: str = "match_id") -> DataFrame:
    """Both models see the same matches."""
    left, right = a.select(key), b.select(key)
    counts = _pair(left.exceptAll(right), right.exceptAll(left), "only_first", "only_second")
    return _result(
        counts, "same_rows", "mart", F.col("only_first") + F.col("only_second") == 0,
        only_first=F.col("only_first"), only_second=F.col("only_second"),
    )


def run_tier(checks: Sequence[DataFrame]) -> DataFrame:
    """All results of a tier as one frame."""
    return reduce(DataFrame.unionByName, checks)


def gate(results: DataFrame) -> DataFrame:
    """Stop before the next tier if any recorded check of this one failed."""
    failed = [f"{r.name}: {r.metadata}" for r in results.filter(~F.col("passed")).collect()]
    if failed:
        raise CheckFailure("; ".join(failed))
    return results
