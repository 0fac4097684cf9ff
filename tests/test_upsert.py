from __future__ import annotations

import datetime as dt

import pytest
from conftest import one
from pyspark.sql import functions as F

from touchline.operators import runlog, snapshot
from touchline.operators import upsert as up

SCHEMA = "match_id string, season int, attendance string, ingested_at timestamp"


def at(hour: int) -> dt.datetime:
    return dt.datetime(2024, 1, 1, hour)


@pytest.fixture
def first(spark):
    return spark.createDataFrame([(f"m{k}", 2024, str(k), at(1)) for k in range(4)], SCHEMA)


def stats(merged):
    return tuple(one(up.load_statistics(merged)))


def test_second_load_changes_nothing(first):
    again = first.withColumn("ingested_at", F.lit(at(2)))
    merged = up.upsert(first, again)
    assert stats(merged) == (0, 0, 4, 4)
    assert merged.agg(F.sum(F.col("attendance").cast("int"))).first()[0] == 6 and merged.count() == 4


def test_correction_replaces_and_null_counts_as_change(spark, first):
    batch = spark.createDataFrame([("m1", 2024, "99", at(2)), ("m2", 2024, None, at(2)), ("m9", 2024, "5", at(2))], SCHEMA)
    merged = up.upsert(first, batch)
    assert {r.match_id: (r.attendance, r.action) for r in merged.collect()} == {
        "m0": ("0", "kept"), "m1": ("99", "updated"), "m2": (None, "updated"), "m3": ("3", "kept"), "m9": ("5", "inserted"),
    }
    assert stats(merged) == (1, 2, 0, 3)


def test_duplicates_within_a_batch(spark, first):
    batch = spark.createDataFrame([("m1", 2024, "7", at(3)), ("m1", 2024, "8", at(4)), ("m1", 2024, "6", at(2))], SCHEMA)
    assert one(up.dedupe_latest(batch)).attendance == "8"
    assert up.upsert(first, batch).count() == 4


def test_late_delivery_does_not_undo_a_newer_figure(spark, first):
    stale = spark.createDataFrame([("m1", 2024, "7", at(0))], SCHEMA)
    got = {r.match_id: (r.attendance, r.action) for r in up.upsert(first, stale).collect()}
    assert got["m1"] == ("1", "unchanged")


def test_table_rewrites_touched_seasons_only(spark, tmp_path, first):
    path = str(tmp_path / "raw")
    older = first.withColumns({"season": F.lit(2023), "match_id": F.concat(F.lit("o"), "match_id")})
    assert tuple(one(up.upsert_table(spark, path, first.unionByName(older)))) == (8, 0, 0, 8)
    untouched = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "raw" / "load=1" / "season=2023").iterdir()}
    batch = spark.createDataFrame([("m0", 2024, "50", at(2)), ("n1", 2024, "1", at(2))], SCHEMA)
    assert tuple(one(up.upsert_table(spark, path, batch))) == (1, 1, 0, 2)
    assert up.read_table(spark, path).count() == 9
    assert not (tmp_path / "raw" / "load=2" / "season=2023").exists()
    assert untouched == {f.name: f.stat().st_mtime_ns for f in (tmp_path / "raw" / "load=1" / "season=2023").iterdir()}


def test_match_that_changes_season_moves(spark, tmp_path):
    path = str(tmp_path / "raw")
    up.upsert_table(spark, path, spark.createDataFrame([("m0", 2023, "1", at(1)), ("m1", 2024, "1", at(1))], SCHEMA))
    up.upsert_table(spark, path, spark.createDataFrame([("m0", 2024, "1", at(2))], SCHEMA))
    assert {(r.match_id, r.season) for r in up.read_table(spark, path).collect()} == {("m0", 2024), ("m1", 2024)}


def test_a_load_that_breaks_off_changes_nothing(spark, tmp_path, first, monkeypatch):
    path = str(tmp_path / "raw")
    up.upsert_table(spark, path, first)
    batch = spark.createDataFrame([("m0", 2023, "50", at(2))], SCHEMA)
    with monkeypatch.context() as broken:
        broken.setattr(up, "publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            up.upsert_table(spark, path, batch)
    assert {(r.match_id, r.season) for r in up.read_table(spark, path).collect()} == {(f"m{k}", 2024) for k in range(4)}
    assert one(up.upsert_table(spark, path, batch)).updated == 1
    assert ("m0", 2023) in {(r.match_id, r.season) for r in up.read_table(spark, path).collect()}


def test_backfill_counts_per_season(spark, first):
    records = first.unionByName(spark.createDataFrame([("x", 2025, "1", at(2)), ("y", 2030, "1", at(2))], SCHEMA))
    seasons = spark.createDataFrame([("2024",), ("2025",)], "season string")
    merged, per_season = up.backfill(first.limit(0), records, seasons)
    assert {r.season: (r.inserted, r.total) for r in per_season.collect()} == {2024: (4, 4), 2025: (1, 1)}
    assert merged.count() == 5


def test_run_history_replaces_one_run(spark, tmp_path):
    path = str(tmp_path / "metrics")
    rows = [("baseline", dt.date(2024, 1, d), float(d)) for d in (1, 8)] + [("prorel", dt.date(2024, 1, 8), 7.0)]
    schema = "model_name string, run_date date, mae double"
    up.upsert_run(spark.createDataFrame(rows, schema), path)
    up.upsert_run(spark.createDataFrame([("baseline", dt.date(2024, 1, 8), 5.0)], schema), path)
    got = {(r.model_name, r.run_date.day): r.mae for r in spark.read.parquet(path).collect()}
    assert got == {("baseline", 1): 1.0, ("baseline", 8): 5.0, ("prorel", 8): 7.0}


def test_rebuild_twice_and_publish(spark, tmp_path, first):
    path = str(tmp_path / "derived")
    assert up.materialise(first, path).count() == up.materialise(first, path).count() == 4
    public = str(tmp_path / "public")
    up.publish(first, public, 1)
    held = up.read_published(spark, public)
    up.publish(first.limit(1), public, 2)
    assert (held.count(), up.read_published(spark, public).count()) == (4, 1)
    up.publish(first, public, 3)
    (tmp_path / "public" / "version=0000000003" / "_SUCCESS").unlink()  # a write that did not finish
    assert up.read_published(spark, public).count() == 1


def test_keys_are_looked_up_where_they_can_be(spark, tmp_path):
    """Seasons whose keys don't meet the batch's are not opened: one of them is gone here."""
    path = str(tmp_path / "raw")
    up.upsert_table(spark, path, spark.createDataFrame(
        [(f"a{k}", 2022, "1", at(1)) for k in range(3)] + [(f"m{k}", 2023, "1", at(1)) for k in range(3)], SCHEMA))
    for file in (tmp_path / "raw" / "load=1" / "season=2022").iterdir():
        file.unlink()
    batch = spark.createDataFrame([("m1", 2024, "2", at(2)), ("z1", 2024, "1", at(2))], SCHEMA)
    assert tuple(one(up.upsert_table(spark, path, batch))) == (1, 1, 0, 2)
    now = {(r.match_id, r.season) for r in up.read_table(spark, path, batch.schema).collect()}
    assert now == {("m0", 2023), ("m2", 2023), ("m1", 2024), ("z1", 2024)}


def test_a_batch_counts_once(spark, tmp_path, first):
    path = str(tmp_path / "raw")
    assert tuple(one(up.upsert_table(spark, path, first, source="s", batch_id=0))) == (4, 0, 0, 4)
    more = spark.createDataFrame([("m0", 2024, "9", at(2)), ("x", 2025, "1", at(2))], SCHEMA)
    for _ in range(3):
        assert tuple(one(up.upsert_table(spark, path, more, source="s", batch_id=1))) == (1, 1, 0, 2)
        assert up.newest_load(spark, path) == 2
    assert tuple(one(up.upsert_table(spark, path, first, source="s", batch_id=0))) == (0, 0, 0, 0)
    assert tuple(one(up.upsert_table(spark, path, more, source="other", batch_id=0))) == (0, 0, 2, 2)
    assert tuple(one(up.upsert_table(spark, path, more))) == (0, 0, 2, 2)
    assert tuple(one(up.upsert_table(spark, path, more, source="s", batch_id=1))) == (1, 1, 0, 2)
    assert up.newest_load(spark, path) == 4 and up.read_table(spark, path).count() == 5


def test_loads_expire_behind_their_readers(spark, tmp_path, first):
    path = str(tmp_path / "raw")
    for k in range(4):
        up.upsert_table(spark, path, first.withColumns({"attendance": F.lit(str(k)), "ingested_at": F.lit(at(k + 2))}))
    held = up.read_table(spark, path, load=3)
    assert up.expire_loads(spark, path, keep=2) == [1, 2]
    assert {r.attendance for r in held.collect()} == {"2"} and {r.attendance for r in up.read_table(spark, path).collect()} == {"3"}
    assert up.published_versions(spark, f"{path}/_manifest") == [3, 4]
    (tmp_path / "raw" / "load=5").mkdir()  # being written
    assert up.expire_loads(spark, path, keep=1) == [3] and (tmp_path / "raw" / "load=5").exists()


def test_backfill_writes_the_table(spark, tmp_path, first):
    path = str(tmp_path / "raw")
    records = first.unionByName(spark.createDataFrame([("x", 2025, "1", at(2)), ("y", 2030, "1", at(2))], SCHEMA))
    seasons = spark.createDataFrame([("2024",), ("2025",)], "season string")
    assert {r.season: (r.inserted, r.total) for r in up.backfill_table(spark, path, records, seasons).collect()} == {2024: (4, 4), 2025: (1, 1)}
    assert up.read_table(spark, path).count() == 5
    again = up.backfill_table(spark, path, records, seasons)
    assert {r.season: (r.inserted, r.unchanged) for r in again.collect()} == {2024: (0, 4), 2025: (0, 1)}


def test_writes_count_themselves(spark, tmp_path, first):
    df, seen = up.write_counted(first, str(tmp_path / "t"), known=F.count("attendance"), last=F.max("ingested_at"))
    assert df.count() == 4 and (seen["rows"], seen["known"], seen["last"]) == (4, 4, at(1))


def test_a_snapshot_is_whole(spark, tmp_path, first):
    root = str(tmp_path / "w")
    for number in (1, 2, 3):
        assert snapshot.next_version(spark, root) == number
        for name in ("a", "b"):
            snapshot.write(first.withColumn("attendance", F.lit(str(number))), root, name, number)
        if number < 3:
            snapshot.commit(spark, root, {"a": number, "b": number}, number)
    now = lambda name, **v: {r.attendance for r in snapshot.read(spark, root, name, **v).collect()}
    assert now("a") == now("b") == {"2"} and now("a", version=1) == {"1"}  # the third run broke off before its commit
    snapshot.commit(spark, root, {"a": 3}, 3)
    assert (now("a"), now("b")) == ({"3"}, {"2"})
    assert sorted(snapshot.expire(spark, root, keep=2)) == [("a", 1), ("b", 1), ("b", 3)]  # b of the run that broke off, too
    assert now("a", version=2) == {"2"} and (now("a"), now("b")) == ({"3"}, {"2"})
    assert snapshot.expire(spark, root, keep=1) == [("a", 2)]
    with pytest.raises(KeyError):
        snapshot.read(spark, root, "c")


def test_logs_are_compacted_behind_their_readers(spark, tmp_path):
    path, folder = str(tmp_path / "log"), tmp_path / "log"
    log = lambda k: runlog.start_stage(spark, path, f"r{k}", "ingest", at(k % 24))
    runs = lambda df: sorted(r.run_id for r in df.select("run_id").collect())
    for k in range(6):
        log(k)
    before = runlog.read_log(spark, path)
    assert runlog.compact_log(spark, path) == 1
    log(6)
    assert runs(before) == [f"r{k}" for k in range(6)] and runs(runlog.read_log(spark, path)) == [f"r{k}" for k in range(7)]
    held = runlog.read_log(spark, path)
    assert runlog.compact_log(spark, path) == 2  # the first one's files go now
    assert len(list(folder.glob("*.parquet"))) == 1 and len(list(folder.glob("_compacted/version=*2/rows/*.parquet"))) == 1
    assert runs(held) == runs(runlog.read_log(spark, path)) == [f"r{k}" for k in range(7)]
    log(7)
    assert runlog.compact_log(spark, path) == 3 and runs(runlog.read_log(spark, path)) == [f"r{k}" for k in range(8)]
    assert not (folder / "_compacted" / "version=0000000001").exists()
