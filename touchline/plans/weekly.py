"""The weekly run: ingest, transform with checks between tiers, train, export.

Every stage opens and closes a run-log row. A run writes new versions of the derived tables beside the old
ones, and one manifest makes all of them current at its end: what fails on the way leaves readers the
whole state of the run before. Raw matches have a manifest of their own, whose version the snapshot
names; histories and logs are appended to. A stage that fails closes its row as failed and stops the run.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.config import COVID_RANGE, MODELS
from touchline.operators import checks, features, learn, reports, runlog, snapshot, staging, upsert
from touchline.operators import standings as st
from touchline.session import stage
from touchline.sources import archive, tables


@dataclass(frozen=True)
class Settings:
    """What a league has to decide. Spots are numbers or tables (season, conference, spots)."""

    warehouse: str
    archive: str
    reference: str
    extracts: str
    playoff_spots: int | DataFrame
    relegation_spots: int | DataFrame
    covid: tuple[dt.date, dt.date] | None = COVID_RANGE
    lags_by_season: bool = False
    drop_covid: bool = True
    line_bodies: bool = False
    git_sha: str | None = None
    trees: dict = field(default_factory=dict)

    def path(self, table: str) -> str:
        return f"{self.warehouse}/{table}"


@dataclass(frozen=True)
class Run:
    spark: SparkSession
    settings: Settings
    as_of: dt.datetime
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    number: int = 1
    made: dict[str, int] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        """A derived table as this run has written it, or else as the newest snapshot has it."""
        root = self.settings.warehouse
        return snapshot.read_version(self.spark, root, name, self.made[name]) if name in self.made else snapshot.read(self.spark, root, name)

    def write(self, df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
        """A new version of a derived table and what was counted while writing it."""
        written = snapshot.write(df, self.settings.warehouse, name, self.number, **metrics)
        self.made[name] = self.number
        return written

    def stage(self, name: str, work: Callable[[], dict]) -> None:
        """Run ``work`` between an opening and a closing log row; it returns logged fields."""
        log, started = self.settings.path("run_log"), dt.datetime.now(dt.UTC).replace(tzinfo=None)
        runlog.start_stage(self.spark, log, self.run_id, name, started)
        try:
            fields = work()
        except Exception as error:
            runlog.finish_stage(self.spark, log, self.run_id, name, self._now(started), "failed", error=error, git_sha=self.settings.git_sha)
            raise
        runlog.finish_stage(self.spark, log, self.run_id, name, self._now(started), "success", git_sha=self.settings.git_sha, **fields)

    @staticmethod
    def _now(started: dt.datetime) -> dt.datetime:
        return max(dt.datetime.now(dt.UTC).replace(tzinfo=None), started + dt.timedelta(microseconds=1))

    def checked(self, *results: DataFrame, offenders: dict[str, DataFrame] | None = None) -> None:
        """Record every result of a tier and all offenders of those that failed, then stop if one did."""
        tier = upsert.materialise(checks.run_tier(results), self.settings.path(f"tier_results/{self.run_id}-{uuid.uuid4().hex}"))
        runlog.log_checks(tier, self.settings.path("check_log"), self.run_id, self.as_of)
        failed = {r.name for r in tier.filter(~F.col("passed")).select("name").collect()}
        for name, rows in (offenders or {}).items():
            if name in failed:
                found = checks.details(name, rows).withColumn("run_id", F.lit(self.run_id))
                found.write.mode("append").partitionBy("check_name").parquet(self.settings.path("check_details"))
        checks.gate(tier)


def ingest(run: Run) -> dict:
    """Upsert all archived responses of the configured seasons."""
    s = run.settings
    bodies = archive.parsed(archive.documents(run.spark, s.archive, s.line_bodies))
    records = archive.unnest(bodies)
    run.checked(
        checks.bodies_parse(bodies), checks.schema_drift(records),
        offenders={
            "bodies_parse": bodies.filter(~F.col("parsed")).select("file", "body"),
            "schema_drift": checks.drifted_records(records).select("season_id", "missing", "found", "record"),
        },
    )
    configured = tables.read_reference_table(run.spark, s.reference, "seasons").select("season_id")
    raw = archive.to_raw_matches(records.join(configured.distinct(), "season_id", "left_semi"))
    counts = upsert.upsert_table(run.spark, s.path("raw_matches"), raw).first()
    run.made[RAW] = upsert.newest_load(run.spark, s.path("raw_matches"))
    return {
        "rows_read": counts.total, "rows_inserted": counts.inserted, "rows_updated": counts.updated,
        "rows_unchanged": counts.unchanged,
    }


#: The snapshot's name for the load of raw matches that its tables were made from.
RAW = "raw_matches"


def read(spark: SparkSession, settings: Settings, name: str) -> DataFrame:
    """A table of the newest whole run."""
    if name == RAW:
        return upsert.read_table(spark, settings.path(RAW), load=snapshot.current(spark, settings.warehouse)[RAW])
    return snapshot.read(spark, settings.warehouse, name)


def transform(run: Run) -> dict:
    """Rebuild staging, standings and mart, each behind the checks of the tier before it."""
    s, raw = run.settings, upsert.read_table(run.spark, run.settings.path(RAW))
    ref = tables.read_reference(run.spark, s.reference)
    stg, counts = run.write(staging.stg_matches(raw, ref["club_aliases"], s.covid), "stg_matches", **runlog.load_metrics())
    clubs, n_clubs = run.write(staging.stg_clubs(ref["club_aliases"], ref["club_conference"]), "stg_clubs")
    run.checked(
        checks.matches_are_fresh(stg, run.as_of.date()), checks.all_clubs_mapped(stg),
        checks.row_count_preserved(raw, stg), checks.one_row_per_match(stg), checks.one_match_per_club_per_date(stg),
        offenders={
            "all_clubs_mapped": staging.unmapped_names(stg), "one_row_per_match": checks.duplicates(stg, ["match_id"]),
            "one_match_per_club_per_date": checks.duplicates(checks.club_dates(stg), ["season", "club_id", "date"]),
        },
    )
    standings, n_standings = run.write(st.int_standings(stg, clubs), "int_standings")
    run.checked(
        checks.no_future_leakage(stg, standings), offenders={"no_future_leakage": checks.leaked_rows(stg, standings)}
    )
    every, n_every = run.write(
        features.mart_match_features(
            stg, clubs, ref["derbies"], s.playoff_spots, s.relegation_spots, mask=s.covid,
            include_unplayed=True, lags_by_season=s.lags_by_season,
        ),
        "mart_all_fixtures",
    )
    done = st.played(stg).select("match_id")
    mart, n_mart = run.write(every.join(done, "match_id", "left_semi"), "mart_match_features")
    run.checked(
        checks.features_not_null(mart), checks.mart_matches_staging(stg, mart), checks.final_table_matches(stg),
        checks.mart_columns_match_definitions(mart),
    )
    written = {
        "stg_matches": counts, "stg_clubs": n_clubs, "int_standings": n_standings, "mart_all_fixtures": n_every, "mart_match_features": n_mart,
    }
    return runlog.counted(counts) | {"rows_written": json.dumps({name: seen["rows"] for name, seen in written.items()})}


def train(run: Run) -> dict:
    """Train on one split, forecast what is unplayed, and add all of it to the histories.

    The two compared models and the forecasting one, which learns from all rows, are fitted at once and kept under ``models``.
    """
    s, mart = run.settings, run.table("mart_match_features")
    marked = learn.split_rows(mart, s.drop_covid)
    train, test = learn.parts_of(marked)
    jobs = {name: (train, columns) for name, columns in MODELS.items()}
    models = learn.fit_all({**jobs, "forecast": (marked.drop("part"), MODELS["prorel"])}, **s.trees)
    for name, model in models.items():
        learn.stored(model, run.spark, s.path(f"models/run_date={run.as_of.date()}/{name}"))
    forecasting = models.pop("forecast")
    found = learn.results(marked, models, run.as_of.date())
    counts = found["model_metrics"].filter("model_name = 'prorel'").first()
    ahead = forecast(run, forecasting)
    for name, rows in found.items():
        upsert.upsert_run(rows, s.path(name))
    upsert.upsert_run(ahead, s.path("forecasts"))
    first = test.agg(F.min("date")).first()[0]
    return {
        "rows_read": (counts.n_train + counts.n_test) if counts else 0,
        "rows_written": json.dumps({"train": counts.n_train if counts else 0, "test": counts.n_test if counts else 0, "split_date": str(first) if first else None}),
    }


FORECAST = "match_id string, predicted double, actual double, run_date date, model_name string"


def forecast(run: Run, model: PipelineModel) -> DataFrame:
    """Complete earlier forecasts by what was played since, and forecast what is still open.

    Forecasts are a history of their own: a run's rows are replaced, those of other runs keep their prediction.
    """
    s, every = run.settings, run.table("mart_all_fixtures")
    path, spark = s.path("forecasts"), run.spark
    stg = run.table("stg_matches")
    if upsert.exists(spark, path):
        known = learn.fill_actuals(spark.read.schema(FORECAST).parquet(path), stg)
        run.write(known.filter("actual is not null"), "scored_forecasts")
    open_ = every.join(st.played(stg).select("match_id"), "match_id", "left_anti")
    return stage(learn.score(model, open_, MODELS["prorel"], "prorel", run.as_of.date()), "forecasts")


def export(run: Run) -> dict:
    """CSV extracts of the dashboard tables, with the decay curve beside them."""
    s, spark = run.settings, run.spark
    histories = ("predictions", "model_metrics", "feature_importance")
    extracts = {n: run.table(n) for n in ("mart_match_features", "int_standings")} | {n: spark.read.parquet(s.path(n)) for n in histories}
    extracts["run_log"] = runlog.run_log(runlog.read_log(spark, s.path("run_log")))
    small = [n for n in extracts if n not in ("mart_match_features", "int_standings", "predictions")]
    tables.export_all(extracts, s.extracts, small)
    tables.export_csv(reports.decay_curve(run.table("mart_match_features")), "decay_curve", s.extracts, single_file=True)
    return {"rows_written": json.dumps({"extracts": len(extracts) + 1})}


def weekly(spark: SparkSession, settings: Settings, as_of: dt.datetime, keep: int = 4) -> str:
    """All stages under one run id, which is returned. Versions that none of the newest ``keep`` snapshots names are removed."""
    run = Run(spark, settings, as_of, number=snapshot.next_version(spark, settings.warehouse))
    for name, work in (("ingest", ingest), ("transform", transform), ("train", train), ("export", export)):
        run.stage(name, lambda work=work: work(run))
    snapshot.commit(spark, settings.warehouse, run.made, run.number)
    snapshot.expire(spark, settings.warehouse, keep)
    return run.run_id
