"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are words, pairs of neighbours and pairs with one or two words between them, hashed to
2^BITS; a document has a feature or not. Each coordinate learns at its own rate, and the L1 term
keeps the weight of a coordinate at zero until its gradients add up to more than L1, so the
model is a short list of (feature, weight), which is what is broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from touchline.llm.common import small_batches
from touchline.llm.words import Hasher, labelled_sample, together

BITS = 20
#: The rate of toxic texts where there is no labelled row to learn it from. Below one half, so that nothing is rejected unseen.
UNSEEN = 0.05
#: Labelled rows that are learned from, at most.
ROWS = 16_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 5.0, 1.0, 8.0, 0.01
SKIPS = ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F), (3, 0x165667B19E3779F9))


def features(hashes: np.ndarray) -> np.ndarray:
    """Feature numbers of a text's words in order, repeats included."""
    shift = np.uint64(64 - BITS)
    found = [hashes]
    for gap, factor in SKIPS:
        if len(hashes) > gap:
            found.append((hashes[:-gap] * np.uint64(factor) + hashes[gap:]) * np.uint64(0xD6E8FEB86659FD93))
    return np.concatenate([f >> shift for f in found]).astype(np.int64)


def fit(rows: list[np.ndarray], labels: list[int]) -> tuple[np.ndarray, np.ndarray, float]:
    """Features with a weight, their weights, and the intercept, from each text's distinct features.

    A gradient is at most 1 in size, so a feature of so few texts that all epochs together can't
    exceed L1 keeps the weight zero; leaving it out from the start changes nothing.
    """
    counts = np.zeros(1 << BITS, np.int64)
    for at in rows:
        counts[at] += 1
    often = counts * EPOCHS > L1
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    rate = min(max((sum(labels) + 0.5) / (len(labels) + 1), 1e-3), 1 - 1e-3)
    bias, bias_n = float(np.log(rate / (1 - rate))), 0.0
    for _ in range(EPOCHS):
        for at, label in zip(rows, labels):
            at = at[often[at]]
            zs, ns = z[at], n[at]
            root = np.sqrt(ns)
            w = np.where(np.abs(zs) <= L1, 0.0, -(zs - np.sign(zs) * L1) / ((BETA + root) / ALPHA + L2))
            score = bias + w.sum()
            g = 1 / (1 + np.exp(-np.clip(score, -35, 35))) - label
            z[at] = zs + g - (np.sqrt(ns + g * g) - root) / ALPHA * w
            n[at] = ns + g * g
            bias_n += g * g
            bias -= 0.1 * g / (1 + np.sqrt(bias_n))
    w = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    used = np.flatnonzero(w)
    return used, w[used], bias


def train(docs: DataFrame, labels: DataFrame, keep: Column, rows: int = ROWS) -> dict:
    """The model of at most ``rows`` labelled rows: one task streams through them, its result is the weights.

    Without a labelled row there are no weights, and the intercept says ``UNSEEN``.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, rows, marks = Hasher(), [], []
        for batch in batches:
            rows += together([np.unique(features(hasher(t.split()))).astype(np.int32) for t in batch.column("text").to_pylist()])
            marks += batch.column("label").to_pylist()
        if not rows:
            return
        at, w, bias = fit(rows, marks)
        yield pa.RecordBatch.from_arrays([pa.array([*at, -1], pa.int64()), pa.array([*w, bias], pa.float64())], names=["at", "w"])

    sample = labelled_sample(docs, labels, "toxic", keep, rows).select("text", "label")
    found = sample.coalesce(1).mapInArrow(run, "at bigint, w double").toPandas()
    at, w = found["at"].to_numpy(), found["w"].to_numpy()
    unseen = math.log(UNSEEN / (1 - UNSEEN))
    return {"at": at[at >= 0], "w": w[at >= 0], "bias": float(w[at == -1].sum()) if len(at) else unseen}


class Scorer:
    def __init__(self, model: dict):
        self.weights = np.zeros(1 << BITS)
        self.weights[model["at"]] = model["w"]
        self.bias, self.hasher = model["bias"], Hasher()

    def __call__(self, texts: list[str]) -> np.ndarray:
        sums = np.empty(len(texts))
        for i, text in enumerate(texts):
            at = features(self.hasher(text.split()))
            used = at[self.weights[at] != 0]
            sums[i] = self.weights[np.unique(used)].sum() if len(used) else 0.0
        return 1 / (1 + np.exp(-np.clip(self.bias + sums, -35, 35)))


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` of every row of ``docs``; no shuffle.

    A null or empty text has no features and the intercept's score. Repeated rows, null ids and
    an empty table are kept as they are; other columns, labels and sources among them, are never read.
    """
    return _scored(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), model).drop("text")


def keep_clean(docs: DataFrame, model: dict) -> DataFrame:
    """Rows of ``docs`` that the model does not call toxic, with all their columns.

    Null and empty texts are judged by the intercept; repeated rows and null ids are kept or left like others; an
    empty table gives an empty one, and a model without labelled rows keeps every row.
    """
    name = "_toxicity"
    while name in docs.columns:
        name += "_"
    return _scored(docs, model, name).filter(F.col(f"{name}_predicted") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def _scored(docs: DataFrame, model: dict, name: str = "") -> DataFrame:
    small_batches(docs.sparkSession)
    kept = docs.sparkSession.sparkContext.broadcast({"model": model})  # non-zero weights: at most 2^BITS, as a rule a few thousand
    names = (f"{name}_score", f"{name}_predicted") if name else ("score", "predicted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = kept.value
        if "scorer" not in held:
            held["scorer"] = Scorer(held["model"])
        for batch in batches:
            found = held["scorer"]([t or "" for t in batch.column("text").to_pylist()])
            new = [pa.array(found, pa.float64()), pa.array((found >= 0.5).astype(np.int32), pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *names])

    more = [StructField(names[0], DoubleType()), StructField(names[1], IntegerType())]
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *more]))
