"""Archived provider responses.

A response body is ``{"data": [match, ...]}``. Bodies are read as text, so one that does not
parse is kept, and every record keeps its full JSON, so fields nobody asked for survive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.keys import normalize_key, slug
from touchline.session import stage

ENVELOPE = "data array<string>"
FIELDS = (
    "id string, season string, date_unix string, homeID string, awayID string, home_name string,"
    " away_name string, stadium_name string, homeGoalCount string, awayGoalCount string, attendance string"
)


def documents(spark: SparkSession, path: str, per_line: bool = False) -> DataFrame:
    """Response bodies with their file. ``per_line`` reads compacted files, a body per line."""
    text = spark.read.format("text").option("wholetext", not per_line).option("recursiveFileLookup", True).load(path)
    return text.select(
        F.col("value").alias("body"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("ingested_at"),
    )


def season_of(file: Column) -> Column:
    """Season id in a file or folder name: season_1625 or season_id=1625."""
    return F.nullif(F.regexp_extract(file, r"season(?:_id)?[_=](\d+)", 1), F.lit(""))


def unnest(bodies: DataFrame) -> DataFrame:
    """One row per archived match record, nothing coerced."""
    records = (
        bodies.withColumn("_doc", F.from_json("body", ENVELOPE))
        .select(
            F.explode("_doc.data").alias("record"), season_of(F.col("file")).alias("season_id"),
            "ingested_at", F.lit("league-matches").alias("source_endpoint"),
        )
    )
    return records.withColumn("_f", F.from_json("record", FIELDS)).select("*", "_f.*").drop("_f")


def read_archive(spark: SparkSession, path: str, per_line: bool = False) -> DataFrame:
    return unnest(documents(spark, path, per_line))


def parsed(bodies: DataFrame) -> DataFrame:
    """Bodies with ``parsed``: whether they are JSON with a data array."""
    return bodies.withColumn("parsed", F.from_json("body", ENVELOPE)["data"].isNotNull())


def malformed(spark: SparkSession, path: str, per_line: bool = False) -> DataFrame:
    """Bodies that do not parse or carry no data array, with their file."""
    return parsed(documents(spark, path, per_line)).filter(~F.col("parsed")).select("file", "body")


def to_raw_matches(records: DataFrame, zone: str = "UTC") -> DataFrame:
    """Provider fields to the raw table: texts stay texts, clubs by provider id, date in ``zone``."""
    kickoff = F.expr("timestamp_ntz'1970-01-01' + make_dt_interval(0, 0, 0, cast(date_unix as bigint))")
    local = kickoff if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), kickoff)
    return records.select(
        F.concat(F.lit("fs:"), F.col("id").cast("string")).alias("match_id"),
        F.regexp_extract(F.col("season").cast("string"), r"^(\d{4})", 1).try_cast("int").alias("season"),
        F.date_format(local, "yyyy-MM-dd").alias("date"),
        normalize_key(F.col("homeID")).alias("home_raw"),
        normalize_key(F.col("awayID")).alias("away_raw"),
        F.col("homeGoalCount").cast("string").alias("home_goals"),
        F.col("awayGoalCount").cast("string").alias("away_goals"),
        F.col("attendance").cast("string").alias("attendance"),
        "ingested_at", "source_endpoint",
    )


def archive_summary(spark: SparkSession, path: str) -> DataFrame:
    """Files, season ids, bytes and age per endpoint. File contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        .select("path", "length", "modificationTime")
    )
    endpoint = F.coalesce(
        F.nullif(F.regexp_extract("path", r"endpoint=([^/]+)", 1), F.lit("")),
        F.nullif(F.regexp_extract("path", r"([^/]+?)_season_\d+[^/]*$", 1), F.lit("")),
        F.lit("unknown"),
    )
    return files.groupBy(endpoint.alias("endpoint")).agg(
        F.count("*").alias("files"),
        F.array_sort(F.collect_set(season_of(F.col("path")))).alias("season_ids"),
        F.sum("length").alias("bytes"),
        F.min("modificationTime").alias("oldest"), F.max("modificationTime").alias("newest"),
    )


def archive_missing(seasons: DataFrame, covered: DataFrame) -> DataFrame:
    """Configured seasons without an archived response. ``covered`` has a ``season_id`` column."""
    return seasons.join(covered.select("season_id").distinct(), "season_id", "left_anti")


def derive_aliases(records: DataFrame) -> DataFrame:
    """Starter alias table: each provider id with the slug of its first-seen name.

    The first kick-off per id comes from a hash aggregate; names are compared only at it.
    """
    sides = [
        F.struct(
            F.col(f"{s}ID").cast("string").alias("raw_name"),
            F.coalesce(F.col(f"{s}_name"), F.col(f"{s}ID").cast("string")).alias("name"),
            F.col("date_unix").cast("bigint").alias("seen"),
            F.struct(F.col("id").cast("bigint"), F.lit(k)).alias("ord"),
        ) for k, s in enumerate(("home", "away"))
    ]
    names = records.select(F.inline(F.array(*sides)))
    first = stage(names.groupBy("raw_name").agg(F.min("seen").alias("seen")), "first-seen")
    return (
        names.join(first, ["raw_name", "seen"])
        .groupBy("raw_name").agg(F.min_by("name", "ord").alias("name"))
        .select("raw_name", slug(F.col("name")).alias("club_id"), F.lit("derived from payload").alias("note"))
    )


def write_archive(records: DataFrame, path: str, season: str, document: Column) -> None:
    """Write records as compacted bodies, one per line, in a folder per season.

    ``document`` groups records into bodies and must keep a group to the size of a response.
    """
    fields = [c for c in records.columns if c not in (season, "_document")]
    body = F.concat(
        F.lit('{"data":['),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "record"))), lambda r: r["record"]), ","),
        F.lit("]}"),
    )
    (
        records.select(
            F.col(season).cast("string").alias("season_id"), document.alias("_document"), "id",
            F.to_json(F.struct(*fields)).alias("record"),
        )
        .groupBy("season_id", "_document").agg(body.alias("value"))
        .select("season_id", F.lit("league-matches").alias("endpoint"), "value")
        .write.partitionBy("endpoint", "season_id").text(path)
    )
