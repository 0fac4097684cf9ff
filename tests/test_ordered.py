"""Chunked ordering against brute force, with chunks forced to be tiny."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import day
from pyspark.sql import functions as F

from touchline.operators import ordered
from touchline.operators.features import lags
from touchline.operators.learn import with_split
from touchline.operators.ordered import asof_last, numbered, order_statistics, tally_scores, with_chunk

SCHEMA = "match_id string, season int, date date, home_club_id string, away_club_id string, home_goals int, attendance int"


def random_matches(n: int, seed: int) -> list[tuple]:
    """One club holds a third of all rows, and one of its dates most of those."""
    rng, rows = random.Random(seed), []
    for k in range(n):
        hot = rng.random() < 0.4
        date = dt.date(2024, 1, 10) if hot and rng.random() < 0.7 else dt.date(2024, 1, 1) + dt.timedelta(rng.randint(0, 40))
        club = "hot" if hot else rng.choice(["a", "b", "c", None])
        gate = None if rng.random() < 0.1 else rng.randint(1, 10_000)
        rows.append((f"fs:{rng.randint(0, 10**6)}-{k}", 2024 + (date > day("2024-01-20")), date, club, "z", 1, gate))
    return rows


def brute_lags(rows, by_season=False, mask=None):
    out = {}
    for m in rows:
        before = sorted(
            (r for r in rows if r[3] == m[3] and (not by_season or r[1] == m[1])
             and (r[2], r[0]) < (m[2], m[0]) and not (mask and mask[0] <= r[2] <= mask[1])),
            key=lambda r: (r[2], r[0]),
        )
        gates = [r[6] for r in before][-5:]
        def mean(values):
            known = [v for v in values if v is not None]
            return sum(known) / len(known) if known else None
        out[m[0]] = (gates[-1] if gates else None, mean(gates[-3:]), mean(gates))
    return out


@pytest.mark.parametrize("rows_per_task", [5, 10**6])
@pytest.mark.parametrize("by_season", [False, True])
@pytest.mark.parametrize("mask", [None, (day("2024-01-08"), day("2024-01-18"))])
def test_lags_equal_brute_force(spark, rows_per_task, by_season, mask):
    rows = random_matches(300, 7)
    df = lags(spark.createDataFrame(rows, SCHEMA), by_season, mask, rows_per_task)
    got = {r.match_id: (r.last_home_gate, r.home_gate_ma3, r.home_gate_ma5) for r in df.collect()}
    want = brute_lags(rows, by_season, mask)
    assert got.keys() == want.keys()
    for key, expected in want.items():
        assert got[key] == pytest.approx(expected), key


def test_large_groups_are_split_in_order(spark):
    rows = random_matches(400, 3)
    df = with_chunk(spark.createDataFrame(rows, SCHEMA), ["home_club_id", "date"], "match_id", 10)
    sizes = df.groupBy("home_club_id", "date", "chunk").count().agg(F.max("count")).first()[0]
    assert sizes <= 40 and df.count() == 400
    found = df.filter("home_club_id = 'hot' and date = date'2024-01-10'").select("chunk", "match_id").collect()
    assert len({r.chunk for r in found}) > 3
    assert [r.match_id for r in sorted(found)] == sorted(r.match_id for r in found)


def test_an_outlier_id_does_not_keep_a_group_whole(spark):
    ids = spark.range(20000).select(F.format_string("fs:2024-%06d", "id").alias("match_id")).union(spark.sql("SELECT 'fs:1'"))
    df = with_chunk(ids.withColumn("club", F.lit("a")), ["club"], "match_id", 1000)
    sizes = [r["count"] for r in df.groupBy("chunk").count().collect()]
    assert max(sizes) <= 2500 and sum(sizes) == 20001


def test_positions_of_a_large_group(spark):
    rows = random_matches(300, 5)
    got = numbered(spark.createDataFrame(rows, SCHEMA), ["date"], "match_id", rows_per_task=8)
    for date in {r[2] for r in rows}:
        ids = sorted(r[0] for r in rows if r[2] == date)
        assert {r.match_id: r.position for r in got.filter(F.col("date") == date).collect()} == {
            m: k + 1 for k, m in enumerate(ids)
        }


@pytest.mark.parametrize("strict", [True, False])
def test_asof_last_equals_brute_force(spark, strict):
    rng = random.Random(11)
    start = dt.date(2024, 1, 1)
    events = [(rng.choice("ab"), start + dt.timedelta(rng.randint(0, 200)), k) for k in range(60)]
    grid = [(g, start + dt.timedelta(d)) for g in "abc" for d in range(0, 210, 3)]
    got = asof_last(
        spark.createDataFrame(grid, "g string, d date"), spark.createDataFrame(events, "g string, d date, v int"),
        ["g"], "d", ["v"], strict=strict, tie="v",
    ).collect()
    assert len(got) == len(grid)
    for r in got:
        earlier = [e for e in events if e[0] == r.g and (e[1] < r.d or (not strict and e[1] == r.d))]
        assert r.v == (max(earlier, key=lambda e: (e[1], e[2]))[2] if earlier else None)


def test_asof_includes_the_most_recent_earlier_match(spark):
    """A club that does not play on a date still counts its last match before it."""
    events = spark.createDataFrame([("a", day("2024-03-02"), 3)], "g string, d date, v int")
    grid = spark.createDataFrame([("a", day("2024-03-09")), ("a", day("2024-03-02"))], "g string, d date")
    got = {r.d.day: r.v for r in asof_last(grid, events, ["g"], "d", ["v"]).collect()}
    assert got == {9: 3, 2: None}


@pytest.mark.parametrize("rows_per_task", [20, 10**6])
def test_order_statistics_equal_sorting(spark, rows_per_task):
    rng = random.Random(2)
    rows = [("hot" if k % 3 else "x", rng.choice([-1, 1]) * rng.random() * 10 ** rng.randint(0, 6)) for k in range(500)]
    rows += [("hot", 5.0)] * 200 + [("x", None), ("n", None)] + [("x", 1e9 + k / 7) for k in range(300)]
    rows += [("x", float("inf"))] * 2
    ranks = {"lo": F.lit(0), "mid": F.floor(F.col("n") / 2), "hi": F.col("n") - 1}
    got = order_statistics(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", ranks, rows_per_task).collect()
    assert {r.g for r in got} == {"hot", "x"}
    for r in got:
        values = sorted(v for g, v in rows if g == r.g and v is not None)
        assert (r.n, r.lo, r.mid, r.hi) == (len(values), values[0], values[len(values) // 2], values[-1])
    total = order_statistics(spark.createDataFrame(rows, "g string, v double"), [], "v", ranks, rows_per_task).first()
    values = sorted(v for _, v in rows if v is not None)
    assert (total.n, total.mid) == (len(values), values[len(values) // 2])


def test_scores_are_counted_best_first(spark):
    df = spark.createDataFrame([("s", 3), ("s", 3), ("s", 1), ("s", 0)], "scope string, pts int")
    got = {r.pts: (r.ahead, r.upto, r.members) for r in tally_scores(df, ["scope"], ["pts"]).collect()}
    assert got == {3: (0, 2, 4), 1: (2, 3, 4), 0: (3, 4, 4)}


@pytest.mark.parametrize("n, per_day", [(100, 1), (100, 7), (90, 90)])
def test_split_is_exact_and_chronological(spark, n, per_day):
    rows = [(f"m{k:03d}", dt.date(2024, 3, 1) + dt.timedelta(k // per_day)) for k in range(n)]
    marked = with_split(spark.createDataFrame(rows, "match_id string, date date"), 0.2).collect()
    train = [r for r in marked if r.part == "train"]
    test = [r for r in marked if r.part == "test"]
    assert (len(train), len(test)) == (int(n * 0.8), n - int(n * 0.8))
    assert max((r.date, r.match_id) for r in train) < min((r.date, r.match_id) for r in test)


def test_rows_are_exchanged_once(spark):
    """Windows and the join of carried values share one partitioning, nulls in keys included."""
    rows = spark.createDataFrame([(None if k % 5 == 0 else f"c{k % 3}", k, k) for k in range(40)], "club string, at int, gate int")
    with_parts = ordered.with_chunk(rows, ["club"], "at", rows_per_task=7)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        found = ordered.prior_rows(with_parts, ["club"], ["chunk"], ["at"], F.struct("gate"), 3)
        plan = found._jdf.queryExecution().executedPlan().toString()
        # One for the rows, one for the table of chunk ends.
        assert plan.count("Exchange hashpartitioning") == 2
        got = {r["at"]: [p.gate for p in r.prior] for r in found.collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    by_club = {}
    for k in range(40):
        group = by_club.setdefault(None if k % 5 == 0 else k % 3, [])
        assert got[k] == group[-3:]
        group.append(k)
