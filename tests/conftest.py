"""Shared session and hand-made fixtures."""

from __future__ import annotations

import datetime as dt
import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from touchline.functions.calendar import with_calendar, with_covid_flag  # noqa: E402
from touchline.session import build_session  # noqa: E402

SEASON = "match_id string, season int, date string, home_club_id string, away_club_id string, home_goals int, away_goals int, attendance int"
RAW = "match_id string, season int, date string, home_raw string, away_raw string, home_goals string, away_goals string, attendance string"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("touchline-tests", 8, 4, str(tmp_path_factory.mktemp("scratch")))
    yield session
    session.stop()


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def typed(df):
    """Hand-made rows as staging rows."""
    return with_covid_flag(with_calendar(df.withColumn("date", df["date"].cast("date"))))


@pytest.fixture(scope="session")
def tiny_season(spark):
    rows = [
        ("m1", 2024, "2024-03-02", "club_a", "club_b", 2, 0, 5000),
        ("m2", 2024, "2024-03-02", "club_c", "club_d", 1, 1, 4000),
        ("m3", 2024, "2024-03-09", "club_b", "club_c", 0, 0, 4500),
        ("m4", 2024, "2024-03-09", "club_d", "club_a", 1, 3, 3000),
        ("m5", 2024, "2024-03-16", "club_a", "club_c", 1, 1, 5500),
        ("m6", 2024, "2024-03-16", "club_b", "club_d", 2, 1, 4200),
    ]
    return typed(spark.createDataFrame(rows, SEASON))


@pytest.fixture(scope="session")
def tiny_clubs(spark):
    rows = [(f"club_{c}", 2024, "East", f"Club {c.upper()}") for c in "abcd"]
    return spark.createDataFrame(rows, "club_id string, season int, conference string, display_name string")


def round_robin(clubs: int = 8, season: int = 2024, seed: int = 42) -> list[tuple]:
    """A double round robin, a matchday a week from 2 March, in the raw layout."""
    rng, ring, rows = random.Random(seed), list(range(clubs)), []
    for leg in range(2):
        for turn in range(clubs - 1):
            date = dt.date(season, 3, 2) + dt.timedelta(weeks=leg * (clubs - 1) + turn)
            for k in range(clubs // 2):
                pair = (ring[k], ring[-1 - k])
                home, away = pair if leg == 0 else pair[::-1]
                rows.append((
                    f"m{len(rows):03d}", season, date.isoformat(), f"t{home}", f"t{away}",
                    str(rng.randint(0, 4)), str(rng.randint(0, 3)), str(rng.randint(1000, 9000)),
                ))
            ring = [ring[0], ring[-1], *ring[1:-1]]
    return rows


@pytest.fixture(scope="session")
def league(spark):
    """Raw rows and aliases of the round robin."""
    raw = spark.createDataFrame(round_robin(), RAW)
    aliases = spark.createDataFrame([(f"t{k}", f"t{k}", "") for k in range(8)], "raw_name string, club_id string, note string")
    return raw, aliases


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def as_dicts(df):
    return [r.asDict() for r in df.collect()]
