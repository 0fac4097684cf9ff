"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.session import stage


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each linked node but the roots with the smallest node of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A batch of links replaced by as few as connect the same nodes."""
    for batch in batches:
        a, b = forest(batch.column(0).to_numpy(), batch.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _symmetric(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node it reaches, of every node of ``links`` (long a, long b).

    Self links, repeated links and both directions are fine; an empty table gives an empty one.
    A node that links to itself only appears as its own component. Each round hangs every node's
    larger neighbours on the smallest of its neighbours, then its smaller ones. Links are thinned before
    they are first shuffled and minima are aggregated before the shuffle, but the join that brings them back
    gives what is left of a hub's links to one task. Rounds are written tables; the number of rounds grows with the logarithm of the longest chain.
    """
    links = links.filter("a is not null and b is not null")
    nodes = links.select(F.col("a").alias("node"))
    now = stage(links.filter("a != b").select("a", "b").mapInArrow(_thin, "a bigint, b bigint").distinct(), "links")
    state = None
    while True:
        both = _symmetric(now)
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.distinct(), "links")
        hung = large.join(large.groupBy("a").agg(F.min("b").alias("m")), "a")
        ends = F.explode(F.array("a", "b")).alias("a")
        now = stage(hung.select(ends, F.col("m").alias("b")).filter("a != b").distinct(), "links")
        new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(new) == state:
            break
        state = tuple(new)
    found = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = nodes.union(links.select("b")).distinct().join(found.select("node"), "node", "left_anti")
    return found.union(roots.select("node", F.col("node").alias("component")))
