"""One snapshot for all tables of a warehouse.

A run writes new versions of tables beside the old ones and commits them together: a manifest names the
version of every table. Readers resolve tables through the newest manifest, so a run that breaks off
between two tables changes nothing for them, and a reader of an older manifest goes on reading it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession

from touchline.operators import upsert

MANIFEST = "name string, number bigint"


def _folder(root: str, name: str, number: int) -> str:
    return f"{root}/{name}/version={number:010d}"


def current(spark: SparkSession, root: str, version: int | None = None) -> dict[str, int]:
    """The version of every table in the newest manifest, or in manifest ``version``; empty before the first commit."""
    if not upsert.published_versions(spark, f"{root}/_snapshot"):
        return {}
    return {r.name: r.number for r in upsert.read_published(spark, f"{root}/_snapshot", MANIFEST, version).collect()}


def next_version(spark: SparkSession, root: str) -> int:
    """The number under which a new run writes; a broken run's leftovers under it are overwritten."""
    return 1 + max(upsert.published_versions(spark, f"{root}/_snapshot"), default=0)


def write(df: DataFrame, root: str, name: str, number: int, **metrics: Column) -> tuple[DataFrame, dict]:
    """Write a table's version, counted while writing. Readers don't see it before it is committed."""
    return upsert.write_counted(df, _folder(root, name, number), **metrics)


def commit(spark: SparkSession, root: str, made: Mapping[str, int], number: int) -> None:
    """Make ``made`` current in one step; tables that are not in it keep their version."""
    now = current(spark, root) | dict(made)
    upsert.publish(spark.createDataFrame(sorted(now.items()), MANIFEST).coalesce(1), f"{root}/_snapshot", number)


def read(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A table as of the newest manifest, or of manifest ``version``."""
    numbers = current(spark, root, version)
    if name not in numbers:
        raise KeyError(f"{name} is in no snapshot of {root}")
    return read_version(spark, root, name, numbers[name])


def read_version(spark: SparkSession, root: str, name: str, number: int) -> DataFrame:
    return spark.read.parquet(_folder(root, name, number))


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[tuple[str, int]]:
    """Remove versions that none of the newest ``keep`` manifests names, and older manifests; returns what was removed.

    Versions above the newest manifest belong to a run that is still writing and stay.
    """
    versions = upsert.published_versions(spark, f"{root}/_snapshot")
    manifests = [current(spark, root, v) for v in versions[-keep:]]
    gone = []
    for name in sorted({n for m in (*manifests, *(current(spark, root, v) for v in versions[:-keep])) for n in m}):
        named = {m[name] for m in manifests if name in m}
        for number in upsert.published_versions(spark, f"{root}/{name}"):
            if number not in named and number <= versions[-1]:
                upsert.remove(spark, _folder(root, name, number))
                gone.append((name, number))
    for v in versions[:-keep]:
        upsert.remove(spark, f"{root}/_snapshot/version={v:010d}")
    return gone
