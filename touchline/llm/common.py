"""What several operators share: narrow input frames, batches of bounded size, numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.session import stage

#: Rows in an Arrow batch: with texts of some 100 KB a batch stays at a few MB.
BATCH_ROWS = 512


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Python tasks get at most BATCH_ROWS rows at once, so that long texts fit in memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) <= 0 or int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, under names of their own kind; a null text is empty.

    Every operator starts here, so extra columns never meet its own names.
    """
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def row_key(docs: DataFrame) -> Column:
    """A digest of id and text: equal for repeated rows, different for others, never null."""
    mark = F.coalesce(docs["doc_id"].cast("string"), F.lit("null"))
    return F.md5(F.concat(mark, F.when(docs["text"].isNull(), "-").otherwise("+"), F.coalesce(docs["text"], F.lit(""))))


def numbered_by_part(rows: DataFrame, by: Sequence[str], part: str, order: Sequence[str], name: str) -> DataFrame:
    """Gapless 0-based number within ``by`` in the order (part, order), for groups of any size.

    ``part`` cuts each group into parts that a task can sort. Parts are counted, and a table
    with a row per group and part carries the numbers across. ``rows`` must be stored data:
    they are read twice. Keys must not be null.
    """
    inside = Window.partitionBy(*by, part).orderBy(*order)
    chain = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(*by, part).agg(F.count("*").alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(chain), F.lit(0))).drop("_n")
    )
    return (
        rows.withColumn("_row", F.row_number().over(inside))
        .join(stage(starts, "starts"), [*by, part])
        .withColumn(name, F.col("_start") + F.col("_row") - 1).drop("_start", "_row")
    )


def in_ranges(rows: DataFrame, order: Sequence[str], name: str, part: str = "part") -> DataFrame:
    """Stored rows cut into consecutive ranges of ``order``; ``part`` is the range's number.

    The cut points come from a sample, so only a written result has them fixed.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage(rows.repartitionByRange(n, *order).withColumn(part, F.spark_partition_id()), name)
