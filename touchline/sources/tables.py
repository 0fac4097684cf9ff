"""Reference tables, exports and diagnosis of what is loaded."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.config import EXPORT_TABLES, RAW_COLUMNS
from touchline.functions.keys import normalize_key

# Headers of the hand-kept files and their key columns.
REFERENCE = {
    "club_aliases": ("raw_name", "club_id", "note"),
    "club_conference": ("club_id", "season", "conference", "note"),
    "derbies": ("club_id_a", "club_id_b", "note"),
    "seasons": ("season", "season_id", "note"),
    "stadiums": ("club_id", "stadium", "lat", "lon", "valid_from", "valid_to", "note"),
}
KEYS = ("raw_name", "club_id", "club_id_a", "club_id_b", "season", "season_id")


def read_reference_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One hand-kept CSV, all text, keys normalised as on the other side of the join."""
    schema = ", ".join(f"{c} string" for c in REFERENCE[name])
    table = spark.read.csv(f"{path}/{name}.csv", header=True, schema=schema)
    return table.withColumns({c: normalize_key(F.col(c)) for c in table.columns if c in KEYS})


def read_reference(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {name: read_reference_table(spark, path, name) for name in REFERENCE}


def export_csv(df: DataFrame, table: str, out_dir: str, single_file: bool = False) -> str:
    """A headered CSV folder, of one file where that is asked for: the rows are made by all tasks, then gathered."""
    out = f"{out_dir}/{table}"
    rows = df.repartition(1) if single_file else df
    rows.write.option("header", True).mode("overwrite").csv(out)
    return out


def export_all(tables: dict[str, DataFrame], out_dir: str, small: Iterable[str] = ()) -> list[str]:
    """Write the listed tables; only those named ``small`` go to a single file."""
    return [
        export_csv(tables[t], t, out_dir, single_file=t in small) for t in EXPORT_TABLES if t in tables
    ]


def diagnose_raw(spark: SparkSession) -> DataFrame:
    """Columns each match-like table lacks to serve as raw_matches, and what they are for.

    Empty once raw_matches exists. Reads the catalog only.
    """
    rows = []
    if not spark.catalog.tableExists("raw_matches"):
        for table in spark.catalog.listTables():
            have = {c.name for c in spark.catalog.listColumns(table.name)}
            if "attendance" in have:
                rows += [(table.name, c, why) for c, why in RAW_COLUMNS.items() if c not in have]
    return spark.createDataFrame(rows, "table_name string, missing string, needed_for string")
