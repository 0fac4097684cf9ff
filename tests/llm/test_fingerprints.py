import hashlib

import numpy as np

from odd_rows import nothing, odd  # noqa: F401

from touchline.llm import fingerprints


def test_collision_rate_is_generalised_jaccard():
    draw, sampler, errors = np.random.default_rng(0), fingerprints.Sampler(), []
    for _ in range(150):
        n = int(draw.integers(50, 300))
        shared = int(draw.integers(0, n))
        a, v = draw.integers(0, 1 << 63, n).astype(np.uint64), draw.integers(1, 6, n).astype(float)
        b, w = a.copy(), v.copy()
        b[shared:] = draw.integers(0, 1 << 63, n - shared).astype(np.uint64)
        w[:shared] = draw.integers(1, 6, shared)
        want = np.minimum(v, w)[:shared].sum() / (np.maximum(v, w)[:shared].sum() + v[shared:].sum() + w[shared:].sum())
        got = (sampler.signatures(a, v, np.array([0])) == sampler.signatures(b, w, np.array([0]))).mean()
        errors.append(got - want)
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.075


def brute(rows):
    sampler = fingerprints.Sampler()
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for (doc_id, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        prints = fingerprints.signatures([text, edited, following], sampler)
        yield doc_id, (
            len(text), hashlib.sha256(edited.encode()).hexdigest(), *fingerprints._hex(prints[:2]),
            (prints[0] == prints[1]).mean(), (prints[0] == prints[2]).mean(),
        )


def answers(df):
    return {
        r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in df.collect()
    }


def test_next_across_ranges(spark):
    draw = np.random.default_rng(4)
    rows = [(int(k) * 3, " ".join(draw.choice(list("abcdefgh"), int(draw.integers(0, 40))))) for k in draw.permutation(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert answers(fingerprints.compare_with_next(docs)) == dict(brute(rows))


def test_odd_rows(spark, odd, nothing):
    docs = odd.filter("doc_id is null or doc_id != 4")
    got = answers(fingerprints.compare_with_next(docs))
    assert got == dict(brute([(r.doc_id, r.text or "") for r in docs.collect()]))
    assert got[1][2] == got[2][2] == got[3][2]  # no words
    repeated = fingerprints.compare_with_next(odd).collect()
    assert len(repeated) == odd.count()
    assert len({r.fingerprint for r in repeated if r.doc_id in (0, 4)}) == 1
    assert fingerprints.compare_with_next(nothing).count() == 0
    alone = odd.filter("doc_id = 5")
    assert answers(fingerprints.compare_with_next(alone)) == dict(brute([(r.doc_id, r.text) for r in alone.collect()]))
    assert {r.doc_id: r.fingerprint for r in fingerprints.fingerprint(docs).collect()} == {k: v[2] for k, v in got.items()}
    text = fingerprints.compare_with_next(docs).limit(1)
    assert text.columns[0] == "doc_id"


def test_likeness(spark):
    from pyspark.sql import functions as F

    same, half = "00ff" * 64, "00ff" * 32 + "1111" * 32
    row = spark.createDataFrame([(same, half)], "a string, b string").select(
        fingerprints.likeness(F.col("a"), F.col("a")).alias("x"), fingerprints.likeness(F.col("a"), F.col("b")).alias("y")
    ).first()
    assert (row.x, row.y) == (1.0, 0.5)
