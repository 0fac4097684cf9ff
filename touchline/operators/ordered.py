"""Ordered computations that never sort an unbounded group in one task.

A window over ``partitionBy(club).orderBy(date)`` gives a cluster as many tasks as there are
clubs. Here each group is cut into consecutive chunks; a chunk is sorted on its own, and what
crosses a chunk border travels through a compact table with one row per chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.config import ROWS_PER_TASK
from touchline.session import stage

UNBOUNDED = Window.unboundedPreceding


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which null keys match each other; ``right`` keys are dropped."""
    right = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    cond = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
    return left.join(right, cond, how).drop(*[f"_r_{c}" for c in on])


def with_chunk(
    df: DataFrame, keys: Sequence[str], id_col: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Stored rows with ``chunk``, a number that cuts each group into consecutive runs in ``id_col`` order.

    Rows are dealt by range over (keys, id_col), so a chunk is a range of one task's size whatever
    the groups' sizes or the ids' texts; only groups that a border crosses have more than one. The
    cut points come from a sample, so the dealt rows are written: every later read sees the same.
    """
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // rows_per_task))
    return stage(df.repartitionByRange(parts, *keys, id_col).withColumn("chunk", F.spark_partition_id()), "chunks")


def prior_rows(
    df: DataFrame,
    by: Sequence[str],
    cuts: Sequence[str],
    order: Sequence[str],
    value: Column,
    depth: int,
    skip: Column | None = None,
    name: str = "prior",
) -> DataFrame:
    """Add an array of the ``depth`` preceding ``value`` structs of each row's group.

    The order is (cuts, order) within ``by``. ``cuts`` chop a group into chunks and must be
    monotone in that order. ``skip`` may depend on ``by`` and ``cuts`` only: chunks where it
    holds see the history but do not enter it.
    """
    skip = F.lit(False) if skip is None else skip
    keys = [*by, *cuts]
    # One key of plain equality, in which nulls are equal: the rows are exchanged once, for the windows and the join.
    df = df.withColumn("_key", F.struct(*keys))
    inside = Window.partitionBy("_key").orderBy(*order)
    # History as it stands after each chunk. Its last row has no successor.
    ends = (
        df.select("_key", *keys, *[c for c in order if c not in keys], value.alias("_v"), skip.alias("_skip"))
        .withColumn("_end", F.collect_list("_v").over(inside.rowsBetween(1 - depth, 0)))
        .withColumn("_more", F.lead(F.lit(1)).over(inside))
        .filter("_more is null")
        .select("_key", *keys, "_skip", "_end")
    )
    counted = Window.partitionBy(*by, "_skip").orderBy(*cuts)
    chain = Window.partitionBy(*by).orderBy(*cuts)
    recent = F.flatten(F.collect_list("_end").over(counted.rowsBetween(1 - depth, 0)))
    after = F.when(~F.col("_skip"), _last(recent, depth))
    carried = (
        ends.withColumn("_after", after)
        .select(
            "_key",
            F.last("_after", ignorenulls=True).over(chain.rowsBetween(UNBOUNDED, -1)).alias("_carried"),
        )
    )
    near = F.collect_list(F.when(~skip, value)).over(inside.rowsBetween(-depth, -1))
    joined = df.withColumn("_near", near).join(stage(carried, "chunk-ends"), "_key", "left")
    history = F.concat(F.coalesce("_carried", F.array().cast(joined.schema["_near"].dataType)), "_near")
    return joined.withColumn(name, _last(history, depth)).drop("_near", "_carried", "_key")


def _last(items: Column, n: int) -> Column:
    return F.slice(items, F.greatest(F.size(items) - (n - 1), F.lit(1)), F.lit(n))


def numbered(
    df: DataFrame, by: Sequence[str], id_col: str, rows_per_task: int = ROWS_PER_TASK, name: str = "position"
) -> DataFrame:
    """Exact 1-based position by ``id_col`` within ``by``, for groups of any size."""
    chunked = with_chunk(df, by, id_col, rows_per_task)
    keys = [*by, "chunk"]
    before = F.sum("_n").over(Window.partitionBy(*by).orderBy("chunk").rowsBetween(UNBOUNDED, -1))
    starts = chunked.groupBy(*keys).agg(F.count("*").alias("_n")).select(
        *keys, F.coalesce(before, F.lit(0)).alias("_start")
    )
    key = F.struct(*keys)
    within = F.row_number().over(Window.partitionBy("_key").orderBy(id_col))
    starts = stage(starts.select(key.alias("_key"), "_start"), "chunk-starts")
    return (
        chunked.withColumn("_key", key).withColumn("_row", within).join(starts, "_key", "left")
        .withColumn(name, F.col("_start") + F.col("_row"))
        .drop("_start", "_row", "_key", "chunk")
    )


def asof_last(
    grid: DataFrame,
    events: DataFrame,
    by: Sequence[str],
    on: str,
    values: Sequence[str],
    strict: bool = True,
    period: Column | None = None,
    tie: str | None = None,
) -> DataFrame:
    """For each grid row, the values of the group's latest event before ``on`` (or at it).

    Both sides shrink to one row per (by, on) first. ``period`` is a coarser step of ``on``
    (a month by default): within one, a window finds the event; across them, a table with one
    row per period carries it. ``tie`` names the event column that picks among events at one
    point.
    """
    period = F.trunc(on, "month") if period is None else period
    latest = F.max_by(F.struct(*values), F.struct(on, tie) if tie else F.col(on))
    points = (
        events.groupBy(*by, on).agg(latest.alias("_event"))
        .unionByName(grid.select(*by, on).distinct(), allowMissingColumns=True)
        .groupBy(*by, on).agg(F.max("_event").alias("_event"))
        .withColumn("_period", period)
    )
    inside = Window.partitionBy(*by, "_period").orderBy(on).rowsBetween(UNBOUNDED, -1 if strict else 0)
    chain = Window.partitionBy(*by).orderBy("_period").rowsBetween(UNBOUNDED, -1)
    carried = (
        points.groupBy(*by, "_period")
        .agg(F.max_by("_event", F.when(F.col("_event").isNotNull(), F.col(on))).alias("_end"))
        .select(*by, "_period", F.last("_end", ignorenulls=True).over(chain).alias("_carried"))
    )
    found = (
        points.withColumn("_near", F.last("_event", ignorenulls=True).over(inside))
        .join(carried, [*by, "_period"])
        .select(*by, on, F.coalesce("_near", "_carried").alias("_hit"))
    )
    return grid.join(found, [*by, on], "left").select(*grid.columns, *[F.col(f"_hit.{v}") for v in values])


def tally_scores(table: DataFrame, scope: Sequence[str], score: Sequence[str]) -> DataFrame:
    """One row per distinct score of each scope, best first.

    ``ahead`` counts the members with a better score, ``upto`` those at least as good and
    ``members`` all of them. Counting before ranking keeps a crowded scope small: its sort
    sees distinct scores, not members.
    """
    best_first = Window.partitionBy(*scope).orderBy(*[F.desc(c) for c in score])
    upto = F.sum("_tied").over(best_first.rowsBetween(UNBOUNDED, 0))
    return (
        table.groupBy(*scope, *score).agg(F.count("*").alias("_tied"))
        .withColumn("upto", upto)
        .withColumn("ahead", F.col("upto") - F.col("_tied"))
        .withColumn("members", F.sum("_tied").over(Window.partitionBy(*scope)))
        .drop("_tied")
    )


def order_statistics(
    df: DataFrame, by: Sequence[str], value: str, ranks: dict[str, Column], rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Exact order statistics per group: ``ranks`` maps a name to a 0-based rank of ``n``.

    Each rank starts with the range of its whole group. A range that holds too many rows is cut
    into bins; counting the bins tells which one holds the rank, and that bin's own extremes
    are the next range. Only ranges of at most ``rows_per_task`` rows are counted value by
    value. Groups appear with ``n`` and one column per name.
    """
    group = list(by) or ["_all"]
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).filter("_v is not null and not isnan(_v)")
    if not by:
        rows = rows.withColumn("_all", F.lit(1))
    wanted = F.explode(F.array(*[
        F.struct(F.lit(name).alias("name"), rank.cast("bigint").alias("at")) for name, rank in ranks.items()
    ]))
    ranges = stage(
        rows.groupBy(*group)
        .agg(F.count("*").alias("n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        .select(*group, "n", "_lo", "_hi", F.col("n").alias("_in"), wanted.alias("_w"))
        .select(*group, "n", "_lo", "_hi", "_in", F.col("_w.name").alias("_name"), F.col("_w.at").alias("_at")),
        "rank-ranges",
    )
    too_large = (F.col("_in") > rows_per_task) & (F.col("_lo") < F.col("_hi"))
    # Logarithmic bins first, for values of very different size; then equal steps.
    cut = F.signum("_v") * F.floor(F.log2(F.abs("_v") + 1) * 64)
    while not ranges.filter(too_large).isEmpty():
        found = _narrowed(rows, ranges.filter(too_large), group, cut)
        ranges = stage(ranges.filter(~too_large).unionByName(found), "rank-ranges")
        steps = F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * 4096)
        cut = F.when(F.col("_v") < F.col("_hi"), steps).otherwise(4096)
    found = _narrowed(rows, ranges, group, F.col("_v"))
    picks = [F.max(F.when(F.col("_name") == name, F.col("_lo"))).alias(name) for name in ranks]
    return found.groupBy(*group).agg(F.max("n").alias("n"), *picks).drop("_all")


def _narrowed(rows: DataFrame, ranges: DataFrame, group: Sequence[str], cut: Column) -> DataFrame:
    """Each range replaced by the part of it, as cut by ``cut``, in which its rank falls.

    Rows are counted once per distinct range, whatever number of ranks looks into it.
    """
    span = [*group, "_lo", "_hi"]
    parts = (
        rows.join(ranges.select(*span).distinct(), list(group))
        .filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))
        .groupBy(*span, cut.alias("_part"))
        .agg(F.count("*").alias("_k"), F.min("_v").alias("_from"), F.max("_v").alias("_to"))
    )
    steps = Window.partitionBy(*span).orderBy("_part").rowsBetween(UNBOUNDED, 0)
    start = F.col("_upto") - F.col("_k")
    return (
        parts.withColumn("_upto", F.sum("_k").over(steps))
        .join(ranges, span)
        .filter((F.col("_at") < F.col("_upto")) & (F.col("_at") >= start))
        .select(
            *group, "n", F.col("_from").alias("_lo"), F.col("_to").alias("_hi"), F.col("_k").alias("_in"), "_name",
            (F.col("_at") - start).alias("_at"),
        )
    )
