"""Text quality by a factorisation machine.

Inputs are hashed words, statistics of a text's structure in steps, and how its recorded length
fits the text. The machine adds to a linear score the interaction of every pair of inputs, as the
product of two short vectors; the sum over all pairs is half the difference of the squared sum
and the sum of squares, per factor, so a text is scored in time linear in its inputs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from touchline.llm.common import small_batches
from touchline.llm.words import Hasher, labelled_sample, together

WORD_BITS = 16
STEPS = 16
FACTORS = 8
#: Labelled rows that are learned from, at most.
ROWS = 12_000
EPOCHS, BATCH, RATE, DECAY = 6, 64, 0.1, 1e-5
SEED = 20240229
#: Kinds of bytes: upper and lower case letters, digits, white space, exclamation, bar, symbols, others.
KINDS = 8


def _kind_of_byte() -> np.ndarray:
    kinds = np.full(256, 7, np.int64)
    for kind, chars in enumerate((bytes(range(65, 91)), bytes(range(97, 123)), b"0123456789", b" \t\n\r\x0b\x0c", b"!", b"|", b"#$%&*<>=~^@_\\{}[]")):
        kinds[list(chars)] = kind
    return kinds


KIND = _kind_of_byte()


def statistics(text: str, hashes: np.ndarray, n_chars: int | None) -> np.ndarray:
    """Structure and metadata of a text, each 0 to 1."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kinds = np.bincount(KIND[raw], minlength=KINDS)
    size, words = max(1, len(raw)), max(1, len(hashes))
    lines = [x for x in text.split("\n") if x.strip()]
    same = (hashes[1:] == hashes[:-1]).mean() if len(hashes) > 1 else 0.0
    pairs = hashes[1:] * np.uint64(0x9E3779B97F4A7C15) + hashes[:-1]
    again = 1 - len(np.unique(pairs)) / max(1, len(pairs))
    told = 0.5 if n_chars is None else min(1.0, abs(n_chars - len(text)) / max(1, len(text)))
    return np.array([
        kinds[0] / max(1, kinds[0] + kinds[1]), kinds[1] / size, kinds[2] / size, kinds[3] / size,
        min(1.0, 10 * kinds[4] / size), min(1.0, 10 * kinds[5] / size), min(1.0, 4 * kinds[6] / size), kinds[7] / size,
        len(np.unique(hashes)) / words, same, again, min(1.0, size / words / 20), min(1.0, np.log1p(words) / 12),
        len(set(lines)) / max(1, len(lines)), min(1.0, len(lines) / words), told,
    ])


N_STATS = 16
INPUTS = (1 << WORD_BITS) + N_STATS * STEPS + N_STATS


def inputs(text: str, n_chars: int | None, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and values of a text's inputs: words of unit length together, each statistic's step and its value."""
    hashes = hasher(text.split())
    words = np.unique((hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64))
    stats = statistics(text, hashes, n_chars)
    base = 1 << WORD_BITS
    # Steps are finer near zero: small shares of odd characters matter most.
    step = np.minimum((np.sqrt(stats) * STEPS).astype(np.int64), STEPS - 1)
    at = np.concatenate([words, base + np.arange(N_STATS) * STEPS + step, base + N_STATS * STEPS + np.arange(N_STATS)])
    x = np.concatenate([np.full(len(words), 1 / np.sqrt(max(1, len(words)))), np.ones(N_STATS), stats])
    return at, x


class Machine:
    """Intercept, weights and factors of the inputs."""

    def __init__(self, w0: float, w: np.ndarray, v: np.ndarray):
        self.w0, self.w, self.v = w0, w, v

    def sums(self, at: np.ndarray, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score before the logistic function, and the factors' sums, of texts whose inputs begin at ``starts``."""
        vx = self.v[at] * x[:, None]
        total = np.add.reduceat(vx, starts)
        squares = np.add.reduceat(vx * vx, starts)
        return self.w0 + np.add.reduceat(self.w[at] * x, starts) + 0.5 * (total * total - squares).sum(axis=1), total


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = SEED) -> Machine:
    """Adagrad over mini-batches, with both labels weighted alike."""
    draw = np.random.default_rng(seed)
    ones = labels.sum()
    if not len(rows) or ones in (0, len(labels)):  # nothing to tell apart: the label there is
        rate = (ones + 0.5) / (len(labels) + 1)
        return Machine(float(np.log(rate / (1 - rate))), np.zeros(INPUTS), np.zeros((INPUTS, FACTORS)))
    machine = Machine(0.0, np.zeros(INPUTS), draw.normal(0, 0.05, (INPUTS, FACTORS)))
    gw, gv, g0 = np.full(INPUTS, 1e-2), np.full((INPUTS, FACTORS), 1e-2), 1e-2
    weight = np.where(labels == 1, len(labels) / (2 * ones), len(labels) / (2 * (len(labels) - ones)))
    for _ in range(EPOCHS):
        order = draw.permutation(len(rows))
        for low in range(0, len(order), BATCH):
            part = order[low: low + BATCH]
            at, x = np.concatenate([rows[i][0] for i in part]), np.concatenate([rows[i][1] for i in part])
            sizes = np.array([len(rows[i][0]) for i in part])
            score, total = machine.sums(at, x, np.cumsum(sizes) - sizes)
            g = (1 / (1 + np.exp(-np.clip(score, -35, 35))) - labels[part]) * weight[part] / len(part)
            each = np.repeat(g, sizes) * x
            used, back = np.unique(at, return_inverse=True)
            dw = np.bincount(back, each, len(used)) + DECAY * machine.w[used]
            vs = machine.v[at]
            dvx = each[:, None] * (np.repeat(total, sizes, axis=0) - vs * x[:, None])
            dv = np.stack([np.bincount(back, dvx[:, f], len(used)) for f in range(FACTORS)], axis=1) + DECAY * machine.v[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            g0 += g.sum() ** 2
            machine.w[used] -= RATE * dw / np.sqrt(gw[used])
            machine.v[used] -= RATE * dv / np.sqrt(gv[used])
            machine.w0 -= RATE * g.sum() / np.sqrt(g0)
    return machine


def score_texts(machine: Machine, texts: list[str], n_chars: list[int | None], hasher: Hasher) -> np.ndarray:
    out = np.empty(len(texts))
    for low in range(0, len(texts), BATCH):
        rows = [inputs(t, n, hasher) for t, n in zip(texts[low: low + BATCH], n_chars[low: low + BATCH])]
        sizes = np.array([len(at) for at, _ in rows])
        found, _ = machine.sums(np.concatenate([at for at, _ in rows]), np.concatenate([x for _, x in rows]), np.cumsum(sizes) - sizes)
        out[low: low + BATCH] = 1 / (1 + np.exp(-np.clip(found, -35, 35)))
    return out


def train(docs: DataFrame, labels: DataFrame, keep: Column, rows: int = ROWS) -> Machine:
    """The machine of at most ``rows`` labelled rows. One task learns; a model of fixed size comes back."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, got, marks = Hasher(), [], []
        for batch in batches:
            found = [inputs(t, n, hasher) for t, n in zip(batch.column("text").to_pylist(), batch.column("n_chars").to_pylist())]
            got += zip(together([at for at, _ in found]), together([x for _, x in found]))
            marks += batch.column("label").to_pylist()
        made = fit(got, np.array(marks, float))
        packed = np.concatenate([[made.w0], made.w, made.v.ravel()]).astype("<f4").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], names=["model"])

    sample = labelled_sample(docs, labels, "quality", keep, rows).select("text", "n_chars", "label")
    found = sample.coalesce(1).mapInArrow(run, "model binary").first()
    flat = np.frombuffer(bytes(found["model"]), "<f4") if found else np.zeros(1 + INPUTS * (1 + FACTORS))
    return Machine(float(flat[0]), flat[1: 1 + INPUTS], flat[1 + INPUTS:].reshape(INPUTS, FACTORS))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` of every row of ``docs``; no shuffle.

    A null text counts as empty, a null or missing ``n_chars`` as unknown. Repeated rows, null
    ids and an empty table are kept as they are; labels, languages and sources are never read.
    """
    chars = (F.col("n_chars") if "n_chars" in docs.columns else F.lit(None)).cast("bigint")
    return _scored(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", chars.alias("n_chars")), machine, "").drop("text", "n_chars")


def keep_good(docs: DataFrame, machine: Machine) -> DataFrame:
    """Rows of ``docs`` that the machine does not reject, with all their columns.

    Null and empty texts are judged by what is known of texts without words; repeated rows and null ids are kept or left
    like others; an empty table gives an empty one, and a machine without labelled rows keeps every row.
    """
    name = "_quality"
    while name in docs.columns:
        name += "_"
    return _scored(docs, machine, name).filter(F.col(f"{name}_predicted") == 1).select(*[F.col(f"`{c}`") for c in docs.columns])


def _scored(docs: DataFrame, machine: Machine, name: str) -> DataFrame:
    small_batches(docs.sparkSession)
    # A model of fixed size: 2 MB.
    kept = docs.sparkSession.sparkContext.broadcast(
        {"w0": machine.w0, "w": machine.w.astype(np.float32), "v": machine.v.astype(np.float32)}
    )
    names = (f"{name}_score", f"{name}_predicted") if name else ("score", "predicted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = kept.value
        if "machine" not in held:
            held["machine"], held["hasher"] = Machine(held["w0"], held["w"], held["v"]), Hasher()
        for batch in batches:
            chars = batch.column("n_chars").to_pylist() if "n_chars" in batch.schema.names else [None] * batch.num_rows
            found = score_texts(held["machine"], [t or "" for t in batch.column("text").to_pylist()], chars, held["hasher"])
            new = [pa.array(found, pa.float64()), pa.array((found >= 0.5).astype(np.int32), pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *names])

    more = [StructField(names[0], DoubleType()), StructField(names[1], IntegerType())]
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *more]))
