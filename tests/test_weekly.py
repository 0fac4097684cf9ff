"""The whole run on a small archive: twice, with a correction, and with a renamed club."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from conftest import day, round_robin

from touchline.operators import runlog
from touchline.operators.checks import CheckFailure
from touchline.plans import weekly as plan
from touchline.plans.weekly import Settings, weekly

AS_OF = dt.datetime(2024, 6, 4, 6)


def records(season: int) -> list[dict]:
    rows = []
    for match_id, _, date, home, away, hg, ag, gate in round_robin(season=season, seed=season):
        kickoff = dt.datetime.fromisoformat(f"{date}T19:00:00+00:00")
        rows.append({
            "id": int(match_id[1:]) + season * 1000, "season": f"{season}/{season + 1}", "date_unix": int(kickoff.timestamp()),
            "homeID": int(home[1:]), "awayID": int(away[1:]), "homeGoalCount": int(hg), "awayGoalCount": int(ag),
            "attendance": int(gate),
        })
    return rows


def save(folder, season: int, rows: list[dict]) -> None:
    (folder / f"league-matches_season_{season - 370}.json").write_text(json.dumps({"data": rows}))


@pytest.fixture
def league_files(tmp_path):
    ref, archive = tmp_path / "ref", tmp_path / "archive"
    ref.mkdir(), archive.mkdir()
    (ref / "club_aliases.csv").write_text("raw_name,club_id,note\n" + "".join(f"{k},club_{k},\nClub {k},club_{k},\n" for k in range(8)))
    (ref / "club_conference.csv").write_text("club_id,season,conference,note\n" + "".join(
        f"club_{k},{s},{'East' if k < 4 else 'West'},\n" for k in range(8) for s in (2023, 2024)))
    (ref / "derbies.csv").write_text("club_id_a,club_id_b,note\nclub_1,club_0,\n")
    (ref / "seasons.csv").write_text("season,season_id,note\n2023,1653,\n2024,1654,\n")
    (ref / "stadiums.csv").write_text("club_id,stadium,lat,lon,valid_from,valid_to,note\n")
    for season in (2023, 2024):
        save(archive, season, records(season))
    return tmp_path


def settings(root) -> Settings:
    return Settings(
        warehouse=str(root / "warehouse"), archive=str(root / "archive"), reference=str(root / "ref"),
        extracts=str(root / "extracts"), playoff_spots=2, relegation_spots=1, trees={"maxIter": 2, "maxDepth": 2},
    )


def test_forecasts_are_made_and_scored_later(spark, league_files):
    s = settings(league_files)
    rows = records(2024)
    late = [{**r, "homeGoalCount": None, "awayGoalCount": None, "attendance": None} for r in rows[-8:]]
    save(league_files / "archive", 2024, rows[:-8] + late)
    weekly(spark, s, dt.datetime(2024, 5, 25))
    made = spark.read.parquet(s.path("forecasts")).collect()
    assert len(made) == 8 and all(r.actual is None and r.predicted is not None for r in made)
    save(league_files / "archive", 2024, rows)
    weekly(spark, s, AS_OF + dt.timedelta(days=1))
    scored = {r.match_id: r.actual for r in spark.read.parquet(s.path("scored_forecasts")).collect()}
    assert scored == {f"fs:{r['id']}": float(r["attendance"]) for r in rows[-8:]}


def test_weekly_run(spark, league_files):
    s = settings(league_files)
    first = weekly(spark, s, AS_OF)

    def log():
        return {(r.run_id, r.stage): r for r in runlog.run_log(spark.read.parquet(s.path("run_log"))).collect()}

    rows = log()
    assert {stage for _, stage in rows} == {"ingest", "transform", "train", "export"}
    assert all(r.status == "success" for r in rows.values())
    assert rows[first, "ingest"].rows_inserted == 112
    assert rows[first, "transform"].seasons == "[2023,2024]" and rows[first, "transform"].max_match_date == day("2024-06-01")
    assert spark.read.parquet(s.path("mart_match_features")).count() == 112
    assert spark.read.parquet(s.path("model_metrics")).count() == 3
    assert spark.read.parquet(s.path("check_log")).count() == 12
    assert len(list((league_files / "extracts").iterdir())) == 7

    changed = records(2024)
    changed[0]["attendance"] += 1
    save(league_files / "archive", 2024, changed)
    second = weekly(spark, s, AS_OF + dt.timedelta(days=1))
    r = log()[second, "ingest"]
    assert (r.rows_inserted, r.rows_updated, r.rows_unchanged) == (0, 1, 111)
    assert spark.read.parquet(s.path("model_metrics")).count() == 6
    weekly(spark, s, AS_OF + dt.timedelta(days=1))
    assert spark.read.parquet(s.path("model_metrics")).count() == 6

    (league_files / "archive" / "league-matches_season_1655.json").write_text('{"data": [{"id": 1')
    (league_files / "archive" / "league-matches_season_1656.json").write_text('{"error": "limit"}')
    with pytest.raises(CheckFailure, match="bodies_parse"):
        weekly(spark, s, AS_OF + dt.timedelta(days=2))
    kept = spark.read.parquet(s.path("check_details")).filter("check_name = 'bodies_parse'").collect()
    assert {json.loads(r.offender)["body"] for r in kept} == {'{"data": [{"id": 1', '{"error": "limit"}'}
    assert spark.read.parquet(s.path("check_log")).filter("check_name = 'bodies_parse' and not passed").count() == 1
    for season in (1655, 1656):
        save(league_files / "archive", season + 370, [])

    aliases = league_files / "ref" / "club_aliases.csv"
    aliases.write_text(aliases.read_text().replace("3,club_3,\n", "", 1))
    with pytest.raises(CheckFailure, match='"names":\\["3"\\]'):
        weekly(spark, s, AS_OF + dt.timedelta(days=2))
    failed = runlog.failed_stages(runlog.run_log(spark.read.parquet(s.path("run_log")))).collect()
    assert {(r.stage, r.status) for r in failed} == {("ingest", "success"), ("transform", "failed")}
    flips = runlog.check_flips(spark.read.parquet(s.path("check_log"))).collect()
    assert {r.check_name for r in flips} == {"all_clubs_mapped", "bodies_parse"}


def test_a_run_that_breaks_off_leaves_the_whole_old_state(spark, league_files, monkeypatch):
    s = settings(league_files)
    weekly(spark, s, AS_OF)
    names = ("stg_matches", "int_standings", "mart_match_features", "raw_matches")
    state = lambda: [sorted(tuple(r) for r in plan.read(spark, s, n).select("season", "date").collect()) for n in names] + [
        plan.read(spark, s, "mart_match_features").agg({"attendance": "sum"}).first()[0],
        plan.read(spark, s, "raw_matches").agg({"attendance": "max"}).first()[0],
    ]
    old = state()
    changed = records(2024)
    changed[0]["attendance"] = 99_999
    save(league_files / "archive", 2024, changed)
    write = plan.snapshot.write
    with monkeypatch.context() as broken:
        broken.setattr(plan.snapshot, "write", lambda df, root, name, *a, **k: 1 / 0 if name == "int_standings" else write(df, root, name, *a, **k))
        with pytest.raises(ZeroDivisionError):
            weekly(spark, s, AS_OF + dt.timedelta(days=1))
    assert state() == old
    weekly(spark, s, AS_OF + dt.timedelta(days=1), keep=1)
    assert state()[-1] == "99999" and state()[4] > old[4]
    assert len(list((league_files / "warehouse" / "mart_match_features").glob("version=*"))) == 1
    log = {(r.run_id, r.stage): r for r in runlog.run_log(runlog.read_log(spark, s.path("run_log"))).collect() if r.status == "success"}
    written = [json.loads(r.rows_written) for (_, name), r in log.items() if name == "transform"]
    assert len(written) == 2 and all(w["mart_match_features"] == 112 and w["stg_matches"] == 112 for w in written)
    assert all(json.loads(r.rows_written)["train"] == 89 for (_, name), r in log.items() if name == "train")
