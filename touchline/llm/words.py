"""Word hashes and labelled samples for the classifiers."""

from __future__ import annotations

import string

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Distinct words that a worker remembers before it starts anew. Most words of a large corpus are rare: more of them cost memory and save no time.
REMEMBERED = 50_000
EDGES = string.punctuation + "¡¿«»“”„…"


class Hasher:
    """64-bit hashes of words, without case and the punctuation around them."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for word in set(words).difference(known):
            plain = word.strip(EDGES).lower() or word
            known[word] = xxhash.xxh64_intdigest(plain.encode("utf-8", "surrogatepass"))
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def together(rows: list[np.ndarray]) -> list[np.ndarray]:
    """The same arrays as parts of one: a worker gives a large block back to the system, thousands of small ones it keeps."""
    return np.split(np.concatenate(rows), np.cumsum([len(at) for at in rows])[:-1]) if rows else []


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part`` modulo ``parts``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column, rows: int) -> DataFrame:
    """At most ``rows`` labelled rows of ``docs`` for which ``keep`` (of ``doc_id``) holds, as ``order``, ``text``, ``label``.

    Rows are picked by a hash of the id among those that ``docs`` has, so labels of other documents take no room.
    Ids are compared by themselves; the ids picked, ``rows`` at most, are the only thing that is broadcast. An id that is
    labelled twice counts with its larger label; null labels don't.
    """
    clean = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
    clean = clean.filter("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"))
    order = F.xxhash64("doc_id", F.lit(7))
    picked = clean.filter(keep).join(ids, "doc_id", "left_semi").withColumn("order", order).orderBy("order", "doc_id").limit(rows)
    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        (F.col("n_chars") if "n_chars" in docs.columns else F.lit(None)).cast("bigint").alias("n_chars"),
    )
    return narrow.join(F.broadcast(picked), "doc_id").orderBy("order", F.xxhash64("text")).limit(rows)
