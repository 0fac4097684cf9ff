"""Join keys and identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normalize_key(col: Column, numeric: bool = False) -> Column:
    """Text key with whitespace collapsed and trimmed.

    ``numeric`` renders a float id as a whole number (7.0 and "7" are one club). Case and
    wording stay: merging two clubs is worse than leaving one unmapped.
    """
    text = col.cast("bigint").cast("string") if numeric else col.cast("string")
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def normalized(df: DataFrame, name: str) -> Column:
    """``normalize_key`` with the numeric rule chosen from the column's type."""
    kind = df.schema[name].dataType
    return normalize_key(F.col(name), isinstance(kind, (T.DoubleType, T.FloatType)))


def slug(col: Column) -> Column:
    """Lower case, every run of other characters as one underscore, none at the ends."""
    return F.btrim(F.regexp_replace(F.lower(col), "[^a-z0-9]+", "_"), F.lit("_"))


def match_key(df: DataFrame) -> Column:
    """Namespaced provider id, or a digest of the ordered natural key without one."""
    if "id" in df.columns:
        return F.concat(F.lit("fs:"), F.col("id").cast("string"))
    parts = [F.col(c).cast("string") for c in ("season", "date", "home_raw", "away_raw")]
    return F.concat(F.lit("fs:"), F.sha2(F.concat_ws("~", *parts), 256))


def with_match_id(df: DataFrame) -> DataFrame:
    return df.withColumn("match_id", match_key(df))
