"""The match domain derived from the order tables.

Orders are matches, a customer's nation is the home club, regions are conferences. Small
reference tables come from nation and region, logs from events. Kick-off figures are integer
arithmetic on order keys, so any engine derives the same rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.keys import slug
from touchline.operators import features, grounds, staging
from touchline.operators.runlog import run_log
from touchline.session import stage
from touchline.sources.archive import to_raw_matches

CLUBS = 25
SEASONS = (1995, 2001)
UNPLAYED_FROM = "2001-06-01"
MASK = (dt.date(1998, 3, 1), dt.date(1998, 8, 31))
RUN_DATE = dt.date(2001, 8, 1)
PLAYOFF_SPOTS, RELEGATION_SPOTS = 2, 1

_built: dict[tuple, DataFrame] = {}
_kept: dict[tuple, object] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def built(spark: SparkSession, sf: str, name: str, make) -> DataFrame:
    """A warehouse table, rebuilt once per session: later queries read the written table."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _built:
        _built[key] = stage(make(), name)
    return _built[key]


def kept(spark: SparkSession, sf: str, name: str, make):
    """A value of the session, such as paths of stored models, made once."""
    return _kept.setdefault((spark.sparkContext.applicationId, sf, name), make())


def forget() -> None:
    """Drop the record of built tables and models, so the next query builds them again."""
    _built.clear()
    _kept.clear()


def payload(spark: SparkSession, sf: str) -> DataFrame:
    """Provider records: one per order."""
    key, home = F.col("o_orderkey"), F.col("c_nationkey").cast("bigint")
    day = F.to_date("o_orderdate")
    done = day < F.lit(UNPLAYED_FROM).cast("date")
    gate = F.floor(F.col("o_totalprice") / 10).cast("string")
    dirt = key % 50
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").cast("bigint").alias("k"), "n_name")

    def name(side: str) -> DataFrame:
        return nation.select(F.col("k").alias(f"{side}ID"), F.col("n_name").alias(f"{side}_name"))

    rows = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return rows.select(
        key.alias("id"),
        F.concat_ws("/", F.year(day), F.year(day) + 1).alias("season"),
        (F.unix_date(day).cast("bigint") * 86400 + (key % 24) * 3600).alias("date_unix"),
        home.alias("homeID"),
        ((home + 1 + key % 24) % CLUBS).alias("awayID"),
        F.concat(F.lit("Ground "), home.cast("string")).alias("stadium_name"),
        F.when(done, (key * 7 + F.col("o_custkey") * 3) % 5).alias("homeGoalCount"),
        F.when(done, (key * 11 + F.col("o_custkey")) % 4).alias("awayGoalCount"),
        F.when(done, F.when(dirt == 0, "n/a").when(dirt == 1, "").when(dirt == 2, "0")
               .when(dirt == 3, F.lit(None)).when(dirt == 4, "-1")
               .when(dirt == 5, F.concat(gate, F.lit(".0"))).otherwise(gate)).alias("attendance"),
    ).join(name("home"), "homeID").join(name("away"), "awayID")


def raw_matches(spark: SparkSession, sf: str) -> DataFrame:
    """Raw rows, with stray whitespace around some home ids."""
    records = payload(spark, sf).withColumns({
        "ingested_at": F.timestamp_seconds(F.col("date_unix") + 86400),
        "source_endpoint": F.lit("league-matches"),
    })
    stray = F.substring("match_id", -1, 1) == "3"
    return to_raw_matches(records).withColumn(
        "home_raw", F.when(stray, F.concat(F.lit("  "), "home_raw", F.lit(" "))).otherwise(F.col("home_raw"))
    )


def club_id(name: str = "n_name") -> Column:
    return slug(F.col(name))


def aliases(spark: SparkSession, sf: str) -> DataFrame:
    """A numeric id row and a name row per club."""
    both = F.array(
        F.struct(F.col("n_nationkey").cast("string").alias("raw_name"), club_id().alias("club_id"), F.lit("id").alias("note")),
        F.struct(F.col("n_name").alias("raw_name"), club_id().alias("club_id"), F.lit("name").alias("note")),
    )
    return table(spark, sf, "nation").select(F.inline(both))


def aliases_without_last(spark: SparkSession, sf: str) -> DataFrame:
    """The alias table before the last club was added."""
    return aliases(spark, sf).filter(F.col("club_id") != f"nation_{CLUBS - 1}")


def club_conference(spark: SparkSession, sf: str) -> DataFrame:
    """Conference per season; some clubs move from 1999 on."""
    seasons = F.explode(F.sequence(F.lit(SEASONS[0]), F.lit(SEASONS[1])))
    moved = (F.col("season") >= 1999) & (F.col("n_nationkey") % 7 == 0)
    clubs = table(spark, sf, "nation").withColumn("season", seasons).withColumn(
        "r_regionkey", ((F.col("n_regionkey") + moved.cast("int")) % 5).cast("int")
    )
    return clubs.join(table(spark, sf, "region"), "r_regionkey").select(
        club_id().alias("club_id"), "season", F.col("r_name").alias("conference")
    )


def clubs(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_clubs(aliases(spark, sf), club_conference(spark, sf))


def seasons(spark: SparkSession, sf: str) -> DataFrame:
    """Configured seasons up to the one after the last, with provider ids."""
    first = F.sequence(F.lit(SEASONS[0]), F.lit(SEASONS[1] + 1))
    return table(spark, sf, "region").agg(F.max("r_regionkey")).select(F.explode(first).alias("season")).select(
        "season", (F.col("season") - 370).cast("string").alias("season_id")
    )


def derbies(spark: SparkSession, sf: str) -> DataFrame:
    """Each nation and the next one."""
    nation = table(spark, sf, "nation")
    other = nation.select(F.col("n_nationkey").alias("_k"), club_id().alias("club_id_b"))
    return (
        nation.join(other, (F.col("n_nationkey") + 1) % CLUBS == F.col("_k"))
        .select(club_id().alias("club_id_a"), "club_id_b")
    )


def stadiums(spark: SparkSession, sf: str) -> DataFrame:
    """Every club moved grounds at the start of 1998."""
    def ground(kind: str, start: str, end: str, shift: float) -> Column:
        return F.struct(
            club_id().alias("club_id"), F.concat(F.lit(kind), F.col("n_nationkey").cast("string")).alias("stadium"),
            (F.col("n_nationkey") * 1.5 + shift).alias("lat"), (F.lit(0.0) - F.col("n_nationkey") * 2.0 - shift).alias("lon"),
            F.lit(start).alias("valid_from"), F.lit(end).alias("valid_to"),
        )

    return table(spark, sf, "nation").select(F.inline(F.array(
        ground("Old Ground ", "1900-01-01", "1997-12-31", 0.0),
        ground("New Ground ", "1998-01-01", "2099-12-31", 0.25),
    )))


def stg(spark: SparkSession, sf: str) -> DataFrame:
    """Staging, built once per session."""
    return built(spark, sf, "stg_matches", lambda: staging.stg_matches(
        raw_matches(spark, sf), aliases(spark, sf), MASK
    ))


def mart(spark: SparkSession, sf: str, include_unplayed: bool = False) -> DataFrame:
    """The full mart, built once per session."""
    name = "mart_all_fixtures" if include_unplayed else "mart_match_features"
    return built(spark, sf, name, lambda: features.mart_match_features(
        stg(spark, sf), clubs(spark, sf), derbies(spark, sf), PLAYOFF_SPOTS, RELEGATION_SPOTS,
        mask=MASK, include_unplayed=include_unplayed,
    ))


def parity(spark: SparkSession, sf: str) -> DataFrame:
    return built(spark, sf, "parity_mart", lambda: features.parity_mart(stg(spark, sf)))


def with_grounds(spark: SparkSession, sf: str) -> DataFrame:
    return grounds.asof_stadium(stg(spark, sf), stadiums(spark, sf))


def weather(spark: SparkSession, sf: str) -> DataFrame:
    """Daily weather of every ground on its match days: two forecasts, and observations so far."""
    day = F.unix_date("date")
    code = (day * 7 + F.length("stadium") * 13) % 40
    days = with_grounds(spark, sf).select("stadium", "date").distinct().withColumn("_code", code)

    def reading(source: str, horizon: int | None, shift: int) -> Column:
        base = F.col("_code") + shift
        return F.struct(
            (base - 5).cast("double").alias("temperature_2m_max"),
            (base - 12).cast("double").alias("temperature_2m_min"),
            (base % 9).cast("double").alias("precipitation_sum"),
            (base % 31).cast("double").alias("wind_speed_10m_max"),
            (base * 2).cast("double").alias("cloud_cover_mean"),
            F.lit(source).alias("weather_source"), F.lit(horizon).cast("int").alias("forecast_horizon_days"),
        )

    seen = F.col("date") < F.lit(UNPLAYED_FROM).cast("date")
    readings = F.array(
        reading("forecast", 7, 3), reading("forecast", 3, 1), F.when(seen, reading("archive", None, 0))
    )
    return days.select(F.col("stadium").alias("location"), "date", F.explode(F.array_compact(readings)).alias("r")).select(
        "location", "date", "r.*"
    )


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """A prediction history: two models per match, one run per month."""
    number = F.substring("match_id", 4, 20).cast("bigint")
    gate = F.col("attendance").cast("double")

    def model(name: str, a: int, b: int) -> Column:
        return F.struct(
            F.lit(name).alias("model_name"),
            (F.coalesce(gate, F.lit(25000.0)) + (number * a) % b - (b - 1) / 2).alias("predicted"),
        )

    both = F.explode(F.array(model("baseline", 13, 2001), model("prorel", 17, 1801)))
    return stg(spark, sf).withColumn("_m", both).select(
        "match_id", "_m.model_name", F.trunc("date", "month").alias("run_date"), "_m.predicted",
        gate.alias("actual"),
    )


def stage_events(spark: SparkSession, sf: str) -> DataFrame:
    """Stage events from the event stream: a user's day is a run."""
    names = F.array(*[F.lit(s) for s in ("ingest", "transform", "train", "export")])
    status = F.when(F.col("event_type") == "purchase", "success").when(F.col("event_type") == "error", "failed")
    return table(spark, sf, "events").select(
        run_id().alias("run_id"), F.get(names, (F.col("event_id") % 4).cast("int")).alias("stage"),
        F.col("ts").alias("event_ts"), F.coalesce(status, F.lit("running")).alias("status"),
        F.col("event_id").alias("rows_read"),
        (F.col("event_id") % 3).alias("rows_inserted"), (F.col("event_id") % 2).alias("rows_updated"),
        F.to_date("ts").alias("max_match_date"), F.col("value").alias("null_attendance_pct"),
    )


def run_id() -> Column:
    return F.concat(F.lit("r"), F.col("user_id").cast("string"), F.lit("-"), F.to_date("ts").cast("string"))


def runs(spark: SparkSession, sf: str) -> DataFrame:
    return run_log(stage_events(spark, sf))


def check_log(spark: SparkSession, sf: str) -> DataFrame:
    """A check result per event; large values fail."""
    return table(spark, sf, "events").select(
        run_id().alias("run_id"), F.col("event_type").alias("check_name"), F.lit("staging").alias("tier"),
        (F.col("value") < 30).alias("passed"), F.col("props").alias("metadata"), F.col("ts").alias("checked_at"),
    )
