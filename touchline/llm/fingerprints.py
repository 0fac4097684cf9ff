"""Document fingerprints by consistent weighted sampling.

Terms are five-word shingles (fewer words: the whole sequence) and their weights how often they
occur. Each of SAMPLES samples gives a term gamma variates r, c and a uniform b that depend on
term and sample only; with t = floor(ln(weight) / r + b) and y = exp(r (t - b)) the term of the
smallest c / (y exp(r)) is drawn, together with its t. Two documents draw the same pair with a
probability equal to their generalised Jaccard similarity, so the share of equal places of two
fingerprints estimates it.

The variates of a term in a sample are entries of a table of 2^16 draws, picked by a hash; equal
scores are told apart by the term's hash. For the common weight 1 the score itself is a table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import small_batches
from touchline.session import stage

WORDS = 5
SAMPLES = 64
SEED = 20240229
DRAWS = 1 << 16
#: Terms whose scores are computed at once: their arrays stay in the processor's cache.
CHUNK = 1 << 14


class Sampler:
    """Draws signatures of SAMPLES numbers below 2^16."""

    def __init__(self, seed: int = SEED):
        draw = np.random.Generator(np.random.PCG64(seed))
        self.r, self.c = draw.gamma(2.0, 1.0, DRAWS), draw.gamma(2.0, 1.0, DRAWS)
        self.b = draw.random(DRAWS)
        self.log_a = np.log(self.c) - self.r * (1 - self.b)  # weight 1: t is 0
        # Scores as whole numbers in their own order; 2^20 steps per unit of the logarithm.
        self.plain = self._steps(self.log_a)
        self.odd = draw.integers(1, 1 << 63, SAMPLES, dtype=np.uint64) | np.uint64(1)
        self.shift = draw.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)

    @staticmethod
    def _steps(log_a: np.ndarray) -> np.ndarray:
        return (np.clip((log_a + 1500) * (1 << 20), 0, (1 << 32) - 1)).astype(np.uint64) << np.uint64(32)

    def signatures(self, terms: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A row for each document; its terms begin at ``starts``. Every document has a term."""
        low = terms & np.uint64(0xFFFFFFFF)
        heavy = np.flatnonzero(weights > 1)
        log_w = np.log(weights[heavy])
        out = np.empty((len(starts), SAMPLES), np.uint16)
        for k in range(SAMPLES):
            pick = ((terms * self.odd[k] + self.shift[k]) >> np.uint64(48)).astype(np.int64)
            score = self.plain[pick] | low
            if len(heavy):
                at = pick[heavy]
                t = np.floor(log_w / self.r[at] + self.b[at])
                log_a = np.log(self.c[at]) - self.r[at] * (t - self.b[at]) - self.r[at]
                mark = (low[heavy] + t.astype(np.int64).astype(np.uint64) * np.uint64(2654435761)) & np.uint64(0xFFFFFFFF)
                score[heavy] = self._steps(log_a) | mark
            least = np.minimum.reduceat(score, starts) & np.uint64(0xFFFFFFFF)
            out[:, k] = ((least * np.uint64(2654435761)) & np.uint64(0xFFFFFFFF)) >> np.uint64(16)
        return out


def _terms(text: str, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of a text and how often each occurs; no words: one empty term."""
    parts = text.encode("utf-8", "surrogatepass").split()
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(parts), SEED)], np.uint64), np.ones(1)
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = np.append(0, ends[:-1])[: len(parts) - words + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts, (ends[words - 1:] - 1).tolist())], np.uint64)
    hashes.sort()
    first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
    return hashes[first], np.diff(np.append(first, len(hashes))).astype(float)


def signatures(texts: list[str], sampler: Sampler) -> np.ndarray:
    """Signatures of whole texts, in groups whose terms fill CHUNK."""
    out = np.empty((len(texts), SAMPLES), np.uint16)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = at = 0

    def flush() -> None:
        nonlocal held, size, at
        if held:
            counts = np.array([len(t) for t, _ in held])
            found = sampler.signatures(
                np.concatenate([t for t, _ in held]), np.concatenate([w for _, w in held]), np.cumsum(counts) - counts
            )
            out[at: at + len(held)] = found
            at, held, size = at + len(held), [], 0

    for text in texts:
        held.append(_terms(text))
        size += len(held[-1][0])
        if size >= CHUNK:
            flush()
    flush()
    return out


def _hex(rows: np.ndarray) -> list[str]:
    return [r.astype(">u2").tobytes().hex() for r in rows]


def likeness(a: Column, b: Column) -> Column:
    """Share of equal places of two fingerprints (hex strings), 0 to 1."""
    places = F.sequence(F.lit(0), F.lit(SAMPLES - 1))
    equal = F.aggregate(places, F.lit(0), lambda n, i: n + F.when(
        a.substr(i * 4 + 1, F.lit(4)) == b.substr(i * 4 + 1, F.lit(4)), 1).otherwise(0))
    return equal / F.lit(float(SAMPLES))


def _sampler(kept: dict) -> Sampler:
    if "sampler" not in kept:
        kept["sampler"] = Sampler(kept["seed"])
    return kept["sampler"]


def fingerprint(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``doc_id`` and ``fingerprint`` (hex string) of every row of ``docs``; no shuffle.

    A null or blank text has the fingerprint of one empty term. Equal texts have equal
    fingerprints; repeated rows, null ids and an empty table are kept as they are.
    """
    small_batches(docs.sparkSession)
    kept = docs.sparkSession.sparkContext.broadcast({"seed": seed})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = _hex(signatures(texts, _sampler(kept.value)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.string())], names=["doc_id", "fingerprint"])

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return narrow.mapInArrow(run, "doc_id bigint, fingerprint string")


_MADE = "doc_id bigint, tie bigint, n_chars bigint, fingerprint string, edited_sha256 string, edited_fingerprint string, near_edited double, near_next double"


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n / 2) characters replaced by the first as many of ``following``, or all."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_next(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Every row's fingerprint against those of its edited text and of the next row's text.

    Next is the next by (doc_id, digest of the text), nulls first; after the last comes the
    first. Columns: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``. A null text is empty; rows equal in both keys are the same
    row repeated, so their order does not matter; a table of one row follows itself; no rows
    give no rows; other columns are ignored.

    Texts are shuffled once, by range. A task goes through its range in order and finds each
    row's next one there; what a range's last row lacks, the beginning of the next range, is
    added from a table of one row per range.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kept = spark.sparkContext.broadcast({"seed": seed})
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    narrow = narrow.withColumn("tie", F.xxhash64("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = narrow.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def made(rows: list, following: list[str], prints: np.ndarray, next_prints: np.ndarray) -> dict:
        texts = [edited(t, f) for (_, _, t), f in zip(rows, following)]
        changed = signatures(texts, _sampler(kept.value))
        return {
            "doc_id": pa.array([r[0] for r in rows], pa.int64()), "tie": pa.array([r[1] for r in rows], pa.int64()),
            "n_chars": pa.array([len(r[2]) for r in rows], pa.int64()), "fingerprint": pa.array(_hex(prints), pa.string()),
            "edited_sha256": pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in texts], pa.string()),
            "edited_fingerprint": pa.array(_hex(changed), pa.string()),
            "near_edited": pa.array((prints == changed).mean(axis=1) if len(rows) else [], pa.float64()),
            "near_next": pa.array((prints == next_prints).mean(axis=1) if len(rows) else [], pa.float64()),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held, print_held = None, None, None
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "tie", "text"))))
            if not rows:
                continue
            prints = signatures([r[2] for r in rows], _sampler(kept.value))
            first = first or (rows[0], prints[0])
            if held is not None:
                rows, prints = [held, *rows], np.vstack([print_held, prints])
            done = made(rows[:-1], [r[2] for r in rows[1:]], prints[:-1], prints[1:])
            empty = pa.array([None] * (len(rows) - 1), pa.string())
            yield pa.RecordBatch.from_arrays([*done.values(), empty, empty], names=[*done, "head", "tail"])
            held, print_held = rows[-1], prints[-1]
        if first is not None:  # the open end, with the texts at both ends of the range
            row, text = held[:2], held[2]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row[0]], pa.int64()), pa.array([row[1]], pa.int64()), pa.array([len(text)], pa.int64()),
                    *[pa.array([None], kind) for kind in (pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())],
                    pa.array([first[0][2]], pa.string()), pa.array([text], pa.string()),
                ],
                names=[*(c.split()[0] for c in _MADE.split(", ")), "head", "tail"],
            )

    found = stage(ordered.mapInArrow(run, f"{_MADE}, head string, tail string"), "fingerprints")
    ends = found.filter("tail is not null").select("doc_id", "tie", "head", "tail")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = held = None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "tie", "head", "tail"))):
                if held is not None:
                    yield last(held, row[2])
                held, start = row, row[2] if start is None else start
        if held is not None:
            yield last(held, start)

    def last(end: tuple, following: str) -> pa.RecordBatch:
        prints = signatures([end[3], following], _sampler(kept.value))
        done = made([(end[0], end[1], end[3])], [following], prints[:1], prints[1:])
        return pa.RecordBatch.from_arrays([*done.values()], names=[*done])

    # One row per range, so as many as there are shuffle partitions: a task streams through them.
    closed = ends.repartition(1).sortWithinPartitions("doc_id", "tie").mapInArrow(close, _MADE)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return found.filter("tail is null").select(names).unionByName(closed.select(names))
