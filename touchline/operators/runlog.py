"""Run and check logs as appended events, and the monitors that read them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.calendar import in_season
from touchline.operators.ordered import prior_rows, with_chunk
from touchline.operators.upsert import exists, listed, remove

RUN_FIELDS = {
    "rows_read": "bigint", "rows_inserted": "bigint", "rows_updated": "bigint", "rows_unchanged": "bigint",
    "seasons": "string", "max_match_date": "date", "null_attendance_pct": "double",
    "error_type": "string", "error_message": "string", "git_sha": "string", "rows_written": "string",
}
EVENT_SCHEMA = "run_id string, stage string, event_ts timestamp, status string, " + ", ".join(
    f"{n} {t}" for n, t in RUN_FIELDS.items()
)


def stage_event(
    spark: SparkSession, run_id: str, stage: str, status: str, at: dt.datetime, **fields: object
) -> DataFrame:
    """One event row: status "running" opens a stage, "success" or "failed" closes it."""
    values = [fields.get(n) for n in RUN_FIELDS]
    return spark.createDataFrame([(run_id, stage, at, status, *values)], EVENT_SCHEMA).coalesce(1)


def start_stage(spark: SparkSession, path: str, run_id: str, stage: str, at: dt.datetime) -> None:
    stage_event(spark, run_id, stage, "running", at).write.mode("append").parquet(path)


def finish_stage(
    spark: SparkSession, path: str, run_id: str, stage: str, at: dt.datetime, status: str,
    error: BaseException | None = None, **fields: object,
) -> None:
    if error is not None:
        fields |= {"error_type": type(error).__name__, "error_message": str(error)}
    stage_event(spark, run_id, stage, status, at, **fields).write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a log that is appended to in small files: the newest compaction and the files written since."""
    return _log_of(spark, path, _appended(spark, path))


def _log_of(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    version = max(_compactions(spark, path), default=None)
    if version is None:
        return spark.read.parquet(*[f"{path}/{n}" for n in names])
    folder = f"{path}/_compacted/version={version:010d}"
    rows = spark.read.parquet(f"{folder}/rows")
    taken = {r.file for r in spark.read.parquet(f"{folder}/files").collect()}
    new = [f"{path}/{n}" for n in names if n not in taken]
    return rows.unionByName(spark.read.schema(rows.schema).parquet(*new)) if new else rows


def compact_log(spark: SparkSession, path: str, files: int = 1, keep: int = 1) -> int:
    """Rewrite a log into few files behind a marker; returns the compaction's number.

    Appends may go on meanwhile: what a compaction took in is listed in it. Small files are removed once the
    compaction that took them in is older than the newest ``keep``, so whoever began to read before still can.
    """
    version = 1 + max(_compactions(spark, path), default=0)
    folder = f"{path}/_compacted/version={version:010d}"
    names = _appended(spark, path)
    _log_of(spark, path, names).coalesce(files).write.mode("overwrite").parquet(f"{folder}/rows")
    # Files named here are in the rows; the list is written last and makes the compaction count.
    spark.createDataFrame([(n,) for n in names], "file string").coalesce(1).write.mode("overwrite").parquet(f"{folder}/files")
    for old in _compactions(spark, path):
        if old <= version - keep:
            for r in spark.read.parquet(f"{path}/_compacted/version={old:010d}/files").collect():
                remove(spark, f"{path}/{r.file}")
        if old < version - keep:
            remove(spark, f"{path}/_compacted/version={old:010d}")
    return version


def _appended(spark: SparkSession, path: str) -> list[str]:
    return [n for n in listed(spark, path) if n.endswith(".parquet")]


def _compactions(spark: SparkSession, path: str) -> list[int]:
    return sorted(
        int(n.rsplit("=", 1)[1]) for n in listed(spark, f"{path}/_compacted") if exists(spark, f"{path}/_compacted/{n}/files/_SUCCESS")
    )


def _seconds(column: str) -> Column:
    return F.col(column).cast("timestamp").cast("double")


def run_log(events: DataFrame) -> DataFrame:
    """Current state per run and stage: opened by the first event, described by the last."""
    carried = [c for c in events.columns if c not in ("run_id", "stage", "event_ts")]
    final = F.col("status") != "running"
    last = F.max_by(F.struct(*carried), F.struct("event_ts", final, *carried))
    return (
        events.groupBy("run_id", "stage")
        .agg(F.min("event_ts").alias("started_at"), F.max(F.when(final, F.col("event_ts"))).alias("_end"), last.alias("_l"))
        .select(
            "run_id", "stage", "started_at",
            F.when(F.col("_l.status") != "running", F.col("_end")).alias("finished_at"), "_l.*",
        )
        .withColumn(
            "duration_seconds", _seconds("finished_at") - _seconds("started_at")
        )
    )


def check_rows(results: DataFrame, run_id: str, at: dt.datetime) -> DataFrame:
    """Check results, passed or failed, shaped for the check log."""
    return results.select(
        F.lit(run_id).alias("run_id"), F.col("name").alias("check_name"), "tier", "passed", "metadata",
        F.lit(at).alias("checked_at"),
    )


def log_checks(results: DataFrame, path: str, run_id: str, at: dt.datetime) -> None:
    check_rows(results, run_id, at).write.mode("append").parquet(path)


def stage_metadata(matches: DataFrame) -> DataFrame:
    """Rows, seasons, newest match and share of unknown gates of a load."""
    return matches.agg(
        F.count("*").alias("rows_read"),
        F.to_json(F.array_sort(F.collect_set("season"))).alias("seasons"),
        F.max("date").alias("max_match_date"),
        (100.0 * F.count_if(F.col("attendance").isNull()) / F.count("*")).alias("null_attendance_pct"),
    )


def load_metrics() -> dict[str, Column]:
    """What ``stage_metadata`` says of staged matches, as aggregates that a write can carry."""
    return {
        "seasons": F.to_json(F.array_sort(F.collect_set("season"))), "max_match_date": F.max("date"),
        "null_attendance_pct": 100.0 * F.count_if(F.col("attendance").isNull()) / F.nullif(F.count(F.lit(1)), F.lit(0)),
    }


def counted(seen: dict) -> dict:
    """Fields of a run-log row from what a write with ``load_metrics`` has counted."""
    return {"rows_read": seen["rows"], **{n: seen[n] for n in ("seasons", "max_match_date", "null_attendance_pct")}}


def check_flips(check_log: DataFrame) -> DataFrame:
    """Checks that failed after having passed the time before.

    A check runs in every run, so its history is cut by day (and further where a day is large).
    """
    rows = check_log.withColumns({
        "_day": F.to_date("checked_at"),
        "_at": F.concat_ws(" ", F.date_format("checked_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"), "run_id"),
    })
    rows = with_chunk(rows, ["check_name", "_day"], "_at")
    rows = prior_rows(rows, ["check_name"], ["_day", "chunk"], ["_at"], F.struct("passed"), 1)
    was = F.get("prior", F.lit(0))["passed"]
    return rows.filter(was & ~F.col("passed")).select("check_name", "run_id", "checked_at")


def freshness_history(log: DataFrame) -> DataFrame:
    """Rows, unknown gates and newest match of every successful stage."""
    return log.filter("status = 'success'").select(
        "run_id", "stage", "finished_at", "rows_read", "null_attendance_pct", "max_match_date"
    )


def failed_stages(log: DataFrame) -> DataFrame:
    """Every stage of the most recent run with a failure."""
    last = log.filter("status = 'failed'").agg(F.max_by("run_id", F.struct("started_at", "run_id")).alias("run_id"))
    return log.join(last, "run_id", "left_semi").select("run_id", "stage", "started_at", "status")


def crashed_stages(log: DataFrame) -> DataFrame:
    """Stages that opened and never closed."""
    return log.filter("status = 'running'").select("run_id", "stage", "started_at")


def stale_green_runs(log: DataFrame) -> DataFrame:
    """Successful loads inside the season that changed nothing."""
    return log.filter(
        (F.col("status") == "success") & (F.col("rows_inserted") == 0) & (F.col("rows_updated") == 0)
        & in_season(F.to_date("started_at"))
    ).select("run_id", "stage", "started_at")
