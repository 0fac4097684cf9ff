"""Archive reading, reference files, exports and streaming ingest on small files."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from conftest import one
from pyspark.sql import functions as F

from touchline.operators import checks
from touchline.sources import archive, tables
from touchline.streaming.ingest import stream_archive


def match(k: int, **changes) -> dict:
    record = {
        "id": k, "season": "2018/2019", "date_unix": 1533927600 + k * 86400, "homeID": 100 + k % 4,
        "awayID": 100 + (k + 1) % 4, "home_name": f"Club {k % 4} FC", "away_name": f"Club {(k + 1) % 4} FC",
        "stadium_name": "Park", "homeGoalCount": k % 3, "awayGoalCount": 1, "attendance": 1000 + k,
    }
    return {c: v for c, v in (record | changes).items() if v is not ...}


def save(folder: Path, season: int, records: list[dict] | str) -> None:
    text = records if isinstance(records, str) else json.dumps({"data": records}, indent=1)
    (folder / f"league-matches_season_{season}.json").write_text(text)


@pytest.fixture
def folder(tmp_path):
    save(tmp_path, 1625, [match(1), match(2, extra={"nested": [1, 2]})])
    save(tmp_path, 1626, [match(3)])
    return tmp_path


def test_records_are_unnested_and_stamped(spark, folder):
    rows = {r.id: r for r in archive.read_archive(spark, str(folder)).collect()}
    assert sorted(rows) == ["1", "2", "3"]
    assert rows["1"].season_id == "1625" and rows["3"].season_id == "1626"
    assert json.loads(rows["2"].record)["extra"] == {"nested": [1, 2]}
    assert rows["1"].attendance == "1001" and rows["1"].ingested_at is not None


def test_raw_mapping(spark, folder):
    rows = {r.match_id: r for r in archive.to_raw_matches(archive.read_archive(spark, str(folder))).collect()}
    r = rows["fs:1"]
    assert (r.season, r.date, r.home_raw, r.away_raw, r.home_goals, r.attendance) == (2018, "2018-08-11", "101", "102", "1", "1001")


def test_kickoff_zone_moves_the_date(spark, tmp_path):
    save(tmp_path, 1, [match(1, date_unix=1533952800)])  # 02:00 UTC on 11 August
    records = archive.read_archive(spark, str(tmp_path))
    assert one(archive.to_raw_matches(records)).date == "2018-08-11"
    assert one(archive.to_raw_matches(records, zone="America/New_York")).date == "2018-08-10"


def test_malformed_body_is_kept(spark, folder):
    save(folder, 9, '{"data": [ {"id": 1')
    save(folder, 8, "<html>502</html>")
    bad = archive.malformed(spark, str(folder)).collect()
    assert {r.file.rsplit("_", 1)[1]: r.body for r in bad} == {"9.json": '{"data": [ {"id": 1', "8.json": "<html>502</html>"}
    assert archive.read_archive(spark, str(folder)).filter("season_id not in ('8', '9')").count() == 3


def test_inventory_and_gaps(spark, folder):
    got = one(archive.archive_summary(spark, str(folder)))
    size = sum(f.stat().st_size for f in folder.glob("*.json"))
    assert (got.endpoint, got.files, got.season_ids, got.bytes) == ("league-matches", 2, ["1625", "1626"], size)
    seasons = spark.createDataFrame([("2018", "1625"), ("2020", "1700")], "season string, season_id string")
    covered = archive.read_archive(spark, str(folder))
    assert [r.season for r in archive.archive_missing(seasons, covered).collect()] == ["2020"]


def test_drift_names_both_sides(spark, folder):
    save(folder, 1627, [match(4, homeID=...)])
    records = archive.read_archive(spark, str(folder))
    bad = one(checks.drifted_records(records))
    assert bad.missing == ["homeID"] and "awayID" in bad.found
    result = one(checks.schema_drift(records))
    assert not result.passed and json.loads(result.metadata)["missing"] == ["homeID"]
    assert one(checks.schema_drift(records.filter("season_id <> '1627'"))).passed


def test_aliases_use_the_first_name_seen(spark, tmp_path):
    save(tmp_path, 1, [match(1), match(5, home_name="Renamed"), match(2, home_name=...)])
    got = {r.raw_name: r.club_id for r in archive.derive_aliases(archive.read_archive(spark, str(tmp_path))).collect()}
    assert got == {"101": "club_1_fc", "102": "club_2_fc", "103": "club_3_fc"}


def test_written_archive_reads_back(spark, folder, tmp_path):
    records = archive.read_archive(spark, str(folder)).select("season_id", "id", "homeID", "attendance")
    out = str(tmp_path / "out")
    archive.write_archive(records.withColumnRenamed("season_id", "s"), out, "s", F.lit(0))
    back = archive.read_archive(spark, out, per_line=True).select("season_id", "id", "homeID", "attendance")
    assert back.exceptAll(records).count() == 0 and back.count() == 3


def test_reference_files(spark, tmp_path):
    (tmp_path / "club_aliases.csv").write_text("raw_name,club_id,note\n North  Town ,north,old\n93,x,\n")
    (tmp_path / "club_conference.csv").write_text("club_id,season,conference,note\nx,2019,East,\n")
    (tmp_path / "derbies.csv").write_text("club_id_a,club_id_b,note\nx,north,\n")
    (tmp_path / "seasons.csv").write_text("season,season_id,note\n2019,1625,\n")
    (tmp_path / "stadiums.csv").write_text("club_id,stadium,lat,lon,valid_from,valid_to,note\nx,Park,1.5,2,2017-01-01,2099-12-31,\n")
    ref = tables.read_reference(spark, str(tmp_path))
    assert [(r.raw_name, r.club_id) for r in ref["club_aliases"].collect()] == [("North Town", "north"), ("93", "x")]
    assert one(ref["seasons"]).season_id == "1625" and one(ref["stadiums"]).lat == "1.5"


def test_export(spark, tmp_path, tiny_season):
    written = tables.export_all({"run_log": tiny_season, "other": tiny_season}, str(tmp_path), small=["run_log"])
    assert written == [f"{tmp_path}/run_log"]
    files = list((tmp_path / "run_log").glob("*.csv"))
    assert len(files) == 1 and files[0].read_text().startswith("match_id,season,date")
    assert spark.read.option("header", True).csv(written[0]).count() == 6


def test_missing_raw_table_is_diagnosed(spark):
    spark.createDataFrame([(1, "a", "b", 5)], "id int, home_name string, away_name string, attendance int").createOrReplaceTempView("raw_table")
    found = {r.missing for r in tables.diagnose_raw(spark).collect()}
    assert found == {"match_id", "season", "date", "home_raw", "away_raw", "home_goals", "away_goals"}
    spark.createDataFrame([(1,)], "match_id int").createOrReplaceTempView("raw_matches")
    assert tables.diagnose_raw(spark).count() == 0
    for view in ("raw_table", "raw_matches"):
        spark.catalog.dropTempView(view)


def test_stream_takes_each_file_once_and_corrections_replace(spark, folder, tmp_path):
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")
    source = tmp_path / "in"
    source.mkdir()
    save(source, 1625, [match(1), match(2)])
    stream_archive(spark, str(source), checkpoint, table).awaitTermination()
    assert spark.read.parquet(table).count() == 2
    query = stream_archive(spark, str(source), checkpoint, table)
    query.awaitTermination()
    assert query.lastProgress is None or query.lastProgress["numInputRows"] == 0
    save(source, 16250, [match(2, attendance=9999), match(3)])
    stream_archive(spark, str(source), checkpoint, table).awaitTermination()
    got = {r.match_id: r.attendance for r in spark.read.parquet(table).collect()}
    assert got == {"fs:1": "1001", "fs:2": "9999", "fs:3": "1003"}
