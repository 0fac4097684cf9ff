"""Incremental archive ingest: each archived file is consumed once, corrections upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from touchline.operators.upsert import upsert_table
from touchline.sources.archive import to_raw_matches, unnest


def archive_stream(spark: SparkSession, path: str, per_line: bool = False) -> DataFrame:
    """New archived records as a stream, in the raw layout."""
    text = (
        spark.readStream.schema("value string").option("wholetext", not per_line)
        .option("recursiveFileLookup", True).format("text").load(path)
    )
    bodies = text.select(
        F.col("value").alias("body"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("ingested_at"),
    )
    return to_raw_matches(unnest(bodies))


def stream_archive(
    spark: SparkSession, path: str, checkpoint: str, table: str, per_line: bool = False
) -> StreamingQuery:
    """Upsert everything new into the raw table and stop.

    The checkpoint remembers consumed files, and the table's manifest the last batch of each checkpoint: a batch
    replayed after a failure is not loaded again, so neither figures nor statistics count twice.
    """
    def load(batch: DataFrame, number: int) -> None:
        upsert_table(batch.sparkSession, table, batch, source=checkpoint, batch_id=number)

    return (
        archive_stream(spark, path, per_line).writeStream
        .foreachBatch(load).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
