"""Keyed loads, history tables and publication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from touchline.session import stage


def dedupe_latest(batch: DataFrame, key: Sequence[str] = ("match_id",), order: str = "ingested_at") -> DataFrame:
    """One row per key, the latest by ``order``; equal times fall back to the row's values.

    An aggregate, not a window: a key delivered a million times is reduced before the shuffle.
    """
    rest = [c for c in batch.columns if c not in key]
    latest = F.max_by(F.struct(*rest), F.struct(order, *rest))
    return batch.groupBy(*key).agg(latest.alias("_row")).select(*key, "_row.*").select(*batch.columns)


def upsert(
    target: DataFrame, batch: DataFrame, key: Sequence[str] = ("match_id",),
    ignore: Sequence[str] = ("ingested_at",), order: str = "ingested_at",
) -> DataFrame:
    """The merged table with an ``action`` per row: inserted, updated, unchanged or kept.

    Figures are compared null-safely without the ``ignore`` columns. A batch row older than the
    stored one changes nothing; "kept" rows were not in the batch.
    """
    rest = [c for c in target.columns if c not in key]
    compared = [c for c in rest if c not in ignore]
    old = target.select(*key, F.struct(*rest).alias("_old"))
    new = dedupe_latest(batch.select(target.columns), key, order).select(*key, F.struct(*rest).alias("_new"))
    same = F.lit(True)
    for c in compared:
        same = same & F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
    late = F.coalesce(F.col(f"_new.{order}") < F.col(f"_old.{order}"), F.lit(False))
    action = (
        F.when(F.col("_old").isNull(), "inserted")
        .when(F.col("_new").isNull(), "kept")
        .when(same | late, "unchanged")
        .otherwise("updated")
    )
    return (
        old.join(new, list(key), "full_outer")
        .withColumn("action", action)
        .withColumn("_row", F.when(F.col("action").isin("inserted", "updated"), F.col("_new")).otherwise(F.col("_old")))
        .select(*key, "_row.*", "action")
        .select(*target.columns, "action")
    )


def load_statistics(merged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Inserted, updated, unchanged and their total."""
    kinds = ("inserted", "updated", "unchanged")
    counts = [F.count_if(F.col("action") == k).alias(k) for k in kinds]
    return merged.groupBy(*by).agg(*counts, F.count_if(F.col("action").isin(*kinds)).alias("total"))


def backfill_table(spark: SparkSession, path: str, records: DataFrame, seasons: DataFrame) -> DataFrame:
    """Load every configured season into the table at ``path`` at once; returns the statistics per season that was written."""
    wanted = seasons.select(F.col("season").cast("int").alias("season")).distinct()
    return upsert_table(spark, path, records.join(wanted, "season", "left_semi"), by=["season"])


def backfill(target: DataFrame, records: DataFrame, seasons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Load every configured season at once: the merged table and its per-season statistics."""
    wanted = seasons.select(F.col("season").cast("int").alias("season")).distinct()
    merged = upsert(target, records.join(wanted, "season", "left_semi"))
    return merged, load_statistics(merged, ["season"])


def upsert_table(
    spark: SparkSession, path: str, batch: DataFrame, key: Sequence[str] = ("match_id",),
    source: str | None = None, batch_id: int | None = None, by: Sequence[str] = (),
) -> DataFrame:
    """Upsert into a parquet table kept by season; returns the load statistics, per ``by`` if that is given.

    Only seasons the batch touches, or in which its matches are stored, are read and written, to a
    folder of this load. A manifest then says which load holds each season: until it is published,
    readers see the table as it was, and a load that broke off is written anew by the next.

    The manifest also has the least and the largest key of each season, so where a match is stored is looked
    up only in seasons whose range meets the batch's. Keys that have nothing to do with seasons make that all of them.

    A load with a ``source`` and a ``batch_id`` counts once: the manifest keeps the last id of each source with its
    statistics, and a batch up to that id changes nothing and returns what it returned then (zeros for older ones).
    """
    stored = _manifest_rows(spark, path)
    last = {r.source: r for r in stored if r.source is not None}
    ranges = {r.season: (r.low, r.high) for r in stored if r.source is None}
    if source is not None and source in last and batch_id <= last[source].batch:
        return _statistics_row(spark, last[source], batch_id)
    batch = stage(dedupe_latest(batch, key), "batch")
    held, load = _manifest(spark, path)
    target, touched = batch.limit(0), []
    if held:
        first = F.col(key[0]).cast("string")
        low, high = batch.agg(F.min(first), F.max(first)).first()
        near = {s: n for s, n in held.items() if _overlap(ranges.get(s), low, high)}
        wanted = batch.select("season").distinct()
        if near:
            keys = _read_seasons(spark, path, near, batch.schema).select(*key, "season")
            wanted = wanted.union(keys.join(batch.select(*key), list(key), "left_semi").select("season")).distinct()
        touched = [r.season for r in wanted.collect()]
        inside = {s: n for s, n in held.items() if s in touched}
        if inside:
            target = _read_seasons(spark, path, inside, batch.schema)
    written = f"{path}/load={load}"
    upsert(target, batch, key).write.mode("overwrite").partitionBy("season").parquet(written)
    merged = spark.read.schema(_with_action(batch)).parquet(written)
    first = F.col(key[0]).cast("string")
    filled = merged.groupBy("season").agg(F.min(first).alias("low"), F.max(first).alias("high")).collect()
    none = [None] * 6
    rows = [(s, n, *ranges.get(s, (None, None)), *none) for s, n in held.items() if s not in touched]
    rows += [(r.season, load, r.low, r.high, *none) for r in filled]
    rows += [tuple(r[c] for c in r.__fields__ if c != "version") for n, r in last.items() if n != source]
    if source is not None:
        counts = load_statistics(merged).first()
        rows.append((None, load, None, None, source, batch_id, *[counts[c] for c in STATISTICS]))
    publish(spark.createDataFrame(rows, MANIFEST).coalesce(1), f"{path}/_manifest", load)
    return load_statistics(merged, by)


STATISTICS = ("inserted", "updated", "unchanged", "total")
#: A row per season, and one per source of numbered batches.
MANIFEST = "season int, load int, low string, high string, source string, batch bigint, " + ", ".join(f"{c} bigint" for c in STATISTICS)


def _overlap(stored: tuple[str, str] | None, low: str | None, high: str | None) -> bool:
    """Whether keys between ``low`` and ``high`` may be among the stored ones; so they may if their range isn't known."""
    if stored is None or stored[0] is None:
        return True
    # Spark orders strings by their bytes.
    return low is not None and stored[0].encode() <= high.encode() and low.encode() <= stored[1].encode()


def _manifest_rows(spark: SparkSession, path: str) -> list:
    return read_published(spark, f"{path}/_manifest", MANIFEST).collect() if exists(spark, f"{path}/_manifest") else []


def _statistics_row(spark: SparkSession, last, batch_id: int) -> DataFrame:
    counts = [last[c] if batch_id == last.batch else 0 for c in STATISTICS]
    return spark.createDataFrame([tuple(counts)], ", ".join(f"{c} bigint" for c in STATISTICS))


#: The folder that Spark gives rows without a season.
NO_SEASON = "__HIVE_DEFAULT_PARTITION__"


def _with_action(batch: DataFrame) -> StructType:
    return StructType([*batch.schema.fields, StructField("action", StringType())])


def _manifest(spark: SparkSession, path: str, version: int | None = None) -> tuple[dict[int | None, int], int]:
    """The load that holds each season, and the number of the next load."""
    if not exists(spark, f"{path}/_manifest"):
        return {}, 1
    rows = read_published(spark, f"{path}/_manifest", MANIFEST, version).select("season", "load", "source", "version").collect()
    held = {r.season: r.load for r in rows if r.source is None}
    return held, 1 + max((int(r.version) for r in rows), default=0)


def newest_load(spark: SparkSession, path: str) -> int:
    """The number of the newest published load of a table, 0 for none."""
    return _manifest(spark, path)[1] - 1


def _read_seasons(spark: SparkSession, path: str, held: dict, schema: StructType) -> DataFrame:
    folders = [f"{path}/load={n}/season={NO_SEASON if s is None else s}" for s, n in held.items()]
    columns = [c for c in schema.names]
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*columns)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None, load: int | None = None) -> DataFrame:
    """A table written by ``upsert_table``, as of its newest manifest or that of ``load``. One without rows needs ``schema``."""
    held, _ = _manifest(spark, path, load)
    if not held:
        return spark.createDataFrame([], schema)
    if schema is None:
        season, load = next(iter(held.items()))
        first = spark.read.option("basePath", path).parquet(f"{path}/load={load}/season={NO_SEASON if season is None else season}")
        schema = StructType([f for f in first.schema.fields if f.name not in ("action", "load", "season")] + [StructField("season", IntegerType())])
    return _read_seasons(spark, path, held, schema)


def upsert_run(df: DataFrame, path: str) -> None:
    """Replace the (run_date, model_name) partitions present in ``df``; other runs stay."""
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date", "model_name").parquet(path)
    )


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Rebuild a derived table; running it twice equals running it once."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_counted(df: DataFrame, path: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """``materialise``, with ``rows`` and any other aggregate ``metrics`` counted by the write itself; no further scan."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()]).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get


def publish(df: DataFrame, path: str, version: int) -> None:
    """Write a version beside the old ones. It becomes current with its success marker."""
    df.write.mode("overwrite").parquet(f"{path}/version={version:010d}")


def published_versions(spark: SparkSession, path: str) -> list[int]:
    """Versions that were written completely, ascending."""
    return sorted(
        int(name.rsplit("=", 1)[1]) for name in listed(spark, path) if "version=" in name and exists(spark, f"{path}/{name}/_SUCCESS")
    )


def read_published(spark: SparkSession, path: str, schema: str | StructType | None = None, version: int | None = None) -> DataFrame:
    """The newest version that was written completely, or ``version``."""
    number = max(published_versions(spark, path)) if version is None else version
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{path}/version={number:010d}").withColumn("version", F.lit(number))


def expire_loads(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Remove loads that none of the newest ``keep`` manifests names, and older manifests; returns the loads removed.

    Readers of a manifest that is kept go on reading. A load that is being written, which is newer than all manifests, stays.
    """
    versions = published_versions(spark, f"{path}/_manifest")
    named = {n for v in versions[-keep:] for n in _manifest(spark, path, v)[0].values()}
    gone = [n for n in _numbers(spark, path, "load=") if n not in named and n <= max(versions, default=0)]
    for n in gone:
        remove(spark, f"{path}/load={n}")
    for v in versions[:-keep]:
        remove(spark, f"{path}/_manifest/version={v:010d}")
    return gone


def _numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    return [int(name[len(prefix):]) for name in listed(spark, path) if name.startswith(prefix)]


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if there is no such folder."""
    root = _hadoop_path(spark, path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []


def remove(spark: SparkSession, path: str) -> None:
    target = _hadoop_path(spark, path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def exists(spark: SparkSession, path: str) -> bool:
    target = _hadoop_path(spark, path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
