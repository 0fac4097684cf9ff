"""Column expressions on the awkward values they exist for."""

from __future__ import annotations

import datetime as dt

from conftest import as_dicts, day
from hypothesis import given, settings
from hypothesis import strategies as some
from pyspark.sql import functions as F

from touchline.functions import calendar, keys, values


def column(spark, rows, kind, expression):
    df = spark.createDataFrame([(r,) for r in rows], f"v {kind}")
    return [r[0] for r in df.select(expression(F.col("v"))).collect()]


def test_figures(spark):
    texts = ["5000", "5000.0", "5000.7", "0", "-1", "", None, "N/A", "nan", "inf", " 12 "]
    assert column(spark, texts, "string", values.to_int) == [5000, 5000, 5001, 0, -1, None, None, None, None, None, 12]
    assert column(spark, texts, "string", values.gate_figure) == [5000, 5000, 5001] + [None] * 7 + [12]
    assert column(spark, texts, "string", values.is_populated) == [True] * 3 + [False] * 6 + [True, True]
    assert column(spark, ["", None, "-1", "0", "x"], "string", values.is_present) == [False, False, False, True, True]


def test_score_and_points(spark):
    df = spark.createDataFrame([("2-1",), ("0 - 0",), ("x",), (None,), ("10-3",)], "s string")
    home, away = values.split_score(F.col("s"))
    assert [tuple(r) for r in df.select(home, away).collect()] == [(2, 1), (0, 0), (None, None), (None, None), (10, 3)]
    pairs = spark.createDataFrame([(1, 0), (1, 1), (0, 1)], "a int, b int")
    assert [r[0] for r in pairs.select(values.points(F.col("a"), F.col("b"))).collect()] == [3, 1, 0]


def test_keys(spark):
    names = ["North Town ", "North  Town", "\tNorth Town\n", "north town", "North Town FC"]
    assert column(spark, names, "string", keys.normalize_key) == ["North Town"] * 3 + ["north town", "North Town FC"]
    numbers = spark.createDataFrame([(93.0,), (12345678.0,)], "v double")
    assert [r[0] for r in numbers.select(keys.normalized(numbers, "v")).collect()] == ["93", "12345678"]
    assert column(spark, ["AFC Foo & Bar!", "__x__", "Ünder"], "string", keys.slug) == ["afc_foo_bar", "x", "nder"]


@settings(max_examples=15, deadline=None)
@given(texts=some.lists(some.text(alphabet="aB \t-93", max_size=8), min_size=1, max_size=20))
def test_normalising_twice_changes_nothing_and_merges_only_spacing(spark, texts):
    got = column(spark, texts, "string", keys.normalize_key)
    assert got == [" ".join(t.split()) for t in texts]


def test_match_ids(spark):
    rows = [(2024, "2024-03-02", "a", "b"), (2024, "2024-03-02", "b", "a"), (2024, "2024-03-09", "a", "b")]
    df = spark.createDataFrame(rows, "season int, date string, home_raw string, away_raw string")
    first, again = ([r.match_id for r in keys.with_match_id(df).collect()] for _ in range(2))
    assert first == again and len(set(first)) == 3 and all(i.startswith("fs:") for i in first)
    assert keys.with_match_id(df.withColumn("id", F.lit(7))).first().match_id == "fs:7"


def test_calendar(spark):
    dates = [day("2024-03-02") + dt.timedelta(k) for k in range(7)]  # Saturday to Friday
    got = as_dicts(calendar.with_calendar(spark.createDataFrame([(d,) for d in dates], "date date")))
    assert [r["day_of_week"] for r in got] == [6, 0, 1, 2, 3, 4, 5]
    assert [r["is_weekend"] for r in got] == [True, True] + [False] * 5
    assert [r["is_midweek"] for r in got] == [False] * 3 + [True] * 3 + [False]


def test_ranges(spark):
    dates = [day(d) for d in ("2020-02-29", "2020-03-01", "2021-06-30", "2021-07-01")]
    assert column(spark, dates, "date", calendar.in_range) == [False, True, True, False]
    dates = [day(d) for d in ("2023-02-28", "2023-03-01", "2023-11-15", "2023-11-16")]
    assert column(spark, dates, "date", calendar.in_season) == [False, True, True, False]
