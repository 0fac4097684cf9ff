"""Run queries and their SQL side by side: python tests/compare.py [sf_dir] [name ...]."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


# Spark type names and the SQL type names that mean the same.
SAME_TYPE = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
}


def canonical(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else repr(value)


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def compare(df, con, statement: str) -> str | None:
    """None if both sides agree, else what differs."""
    result = con.sql(statement)
    theirs_names = list(result.columns)
    if sorted(df.columns) != sorted(theirs_names):
        return f"columns {sorted(df.columns)} vs {sorted(theirs_names)}"
    theirs_types = dict(zip(theirs_names, map(str, result.types)))
    unlike = {c: (t, theirs_types[c]) for c, t in df.dtypes if SAME_TYPE.get(t, t) != theirs_types[c]}
    if unlike:
        return f"types {unlike}"
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    theirs = rows_of(theirs_names, result.fetchall())
    if len(ours) != len(theirs):
        return f"rows {len(ours)} vs {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{sum(x != y for x, y in zip(ours, theirs))} rows differ, first {a} vs {b}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from touchline.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(entry.queries())
    spark, con, bad = build_session(), connect(sf), 0
    for name in wanted:
        start = time.time()
        try:
            df = entry.queries()[name](spark, sf)
            statement = entry.oracle_sql().get(name)
            if statement is None:
                problem, note = None, f"{df.count()} rows, no SQL"
            else:
                problem, note = compare(df, con, statement), "same"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'BAD ' if problem else 'ok  '}{name:32s}{time.time() - start:6.1f}s  {problem or note}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
