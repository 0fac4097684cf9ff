import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd_rows import nothing, odd  # noqa: F401

from touchline.llm import quality, toxicity
from touchline.llm.words import Hasher, held_out, labelled_sample

LABELS = "doc_id bigint, quality int, toxic int"


@pytest.fixture(scope="module")
def corpus(spark):
    draw = np.random.default_rng(1)
    vocabulary = [f"word{k}" for k in range(400)]
    docs, labels = [], []
    for k in range(600):
        words = draw.choice(vocabulary, draw.integers(20, 120)).tolist()
        toxic, poor = int(k % 5 == 0), int(k % 7 == 0)
        if toxic:
            for at in draw.integers(0, len(words), 4):
                words[at] = "Vileword!" if at % 2 else "nastyword"
        text = " ".join(words)
        text = (text.upper().replace(" ", "!! ") if k % 2 else " | ".join(words[:4] * 20)) if poor else text
        docs.append((k, text, len(text)))
        labels.append((k, 1 - poor, toxic))
    return spark.createDataFrame(docs, "doc_id bigint, text string, n_chars bigint"), spark.createDataFrame(labels, LABELS), labels


def held_out_accuracy(rows, labels, column):
    of = {r[0]: r[column] for r in labels}
    return np.mean([r.predicted == of[r.doc_id] for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0])


def test_toxicity_held_out(corpus):
    docs, labels, marks = corpus
    model = toxicity.train(docs, labels, ~held_out(F.col("doc_id"), 5, 0))
    rows = toxicity.score(docs, model).collect()
    assert held_out_accuracy(rows, marks, 2) > 0.97
    assert len(model["at"]) < 500 and all(0 <= r.score <= 1 for r in rows)
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and 440 <= kept.count() <= 500


def test_quality_held_out(corpus):
    docs, labels, marks = corpus
    machine = quality.train(docs, labels, ~held_out(F.col("doc_id"), 5, 0))
    rows = quality.score(docs, machine).collect()
    assert held_out_accuracy(rows, marks, 1) > 0.97
    assert quality.keep_good(docs, machine).columns == docs.columns


def test_sum_of_squares_identity():
    draw = np.random.default_rng(2)
    machine = quality.Machine(0.3, draw.normal(size=quality.INPUTS), draw.normal(size=(quality.INPUTS, quality.FACTORS)))
    at, x = np.array([3, 70, 900, 65600]), np.array([0.5, 1.0, 0.2, 0.7])
    pairs = sum(machine.v[at[i]] @ machine.v[at[j]] * x[i] * x[j] for i in range(4) for j in range(i))
    got, _ = machine.sums(at, x, np.array([0]))
    assert got[0] == pytest.approx(0.3 + machine.w[at] @ x + pairs)


def test_rare_features_never_count():
    """What fit leaves out beforehand would have had the weight zero."""
    draw = np.random.default_rng(3)
    rows = [np.unique(draw.integers(0, 50, 20)).astype(np.int32) for _ in range(60)]
    rows[0] = np.append(rows[0], 77).astype(np.int32)
    at, w, _ = toxicity.fit(rows, draw.integers(0, 2, 60).tolist())
    assert 77 not in at and (w != 0).all()


def test_weights_against_plain_rows():
    """FTRL-proximal written out for one coordinate at a time."""
    draw = np.random.default_rng(11)
    rows = [np.unique(draw.integers(0, 40, draw.integers(0, 15))).astype(np.int32) for _ in range(150)]
    labels = [int(7 in at or draw.random() < 0.1) for at in rows]
    z, n = {}, {}

    def weight(k):
        if abs(z.get(k, 0.0)) <= toxicity.L1:
            return 0.0
        sign = 1 if z[k] > 0 else -1
        return -(z[k] - sign * toxicity.L1) / ((toxicity.BETA + n[k] ** 0.5) / toxicity.ALPHA + toxicity.L2)

    rate = (sum(labels) + 0.5) / (len(labels) + 1)
    bias, bias_n = math.log(rate / (1 - rate)), 0.0
    for _ in range(toxicity.EPOCHS):
        for at, label in zip(rows, labels):
            held = {k: weight(k) for k in at.tolist()}
            g = 1 / (1 + math.exp(-(bias + sum(held.values())))) - label
            for k, w in held.items():
                before = n.get(k, 0.0)
                z[k] = z.get(k, 0.0) + g - ((before + g * g) ** 0.5 - before ** 0.5) / toxicity.ALPHA * w
                n[k] = before + g * g
            bias_n += g * g
            bias -= 0.1 * g / (1 + bias_n ** 0.5)
    expected = {k: weight(k) for k in z if weight(k)}
    at, w, found = toxicity.fit(rows, labels)
    assert expected and dict(zip(at.tolist(), w.tolist())) == pytest.approx(expected) and found == pytest.approx(bias)


def test_gradient_of_the_machine():
    """One step moves the inputs of a text against the slope of its loss, as differences show it."""
    draw = np.random.default_rng(12)
    machine = quality.Machine(0.1, draw.normal(size=quality.INPUTS) * 0.1, draw.normal(size=(quality.INPUTS, quality.FACTORS)) * 0.1)
    at, x = np.array([5, 60, 700]), np.array([0.5, 1.0, 0.3])

    def loss():
        score, _ = machine.sums(at, x, np.array([0]))
        return math.log(1 + math.exp(-score[0]))

    score, total = machine.sums(at, x, np.array([0]))
    g = 1 / (1 + math.exp(-score[0])) - 1
    for k in range(3):
        dw, dv = g * x[k], g * x[k] * (total[0, 2] - machine.v[at[k], 2] * x[k])
        for table, where, slope in ((machine.w, at[k], dw), (machine.v, (at[k], 2), dv)):
            kept, step = table[where], 1e-6
            table[where] = kept + step
            up = loss()
            table[where] = kept - step
            down = loss()
            table[where] = kept
            assert (up - down) / (2 * step) == pytest.approx(slope, rel=1e-4)


def test_nothing_is_rejected_unseen(spark, corpus):
    """Without a label for any of its documents a corpus stays whole."""
    docs, labels, _ = corpus
    for none in (labels.limit(0), labels.withColumn("doc_id", F.col("doc_id") + 10_000)):
        model, machine = toxicity.train(docs, none, F.lit(True)), quality.train(docs, none, F.lit(True))
        assert len(model["at"]) == 0
        assert toxicity.keep_clean(docs, model).count() == quality.keep_good(docs, machine).count() == docs.count()


def test_labels_of_other_documents_take_no_room(spark, corpus):
    docs, labels, _ = corpus
    others = spark.range(10_000, 15_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    rows = labelled_sample(docs, others.unionByName(labels.filter("doc_id < 200")), "toxic", F.lit(True), 500).collect()
    assert {r.doc_id for r in rows} == set(range(200))


def test_sample_is_bounded_and_keeps_held_out_rows_out(corpus):
    docs, labels, _ = corpus
    rows = labelled_sample(docs, labels, "toxic", ~held_out(F.col("doc_id"), 5, 0), 100).collect()
    assert len(rows) == 100 and all(zlib.crc32(str(r.doc_id).encode()) % 5 for r in rows)


def test_odd_rows(spark, odd, nothing, corpus):
    _, labels, _ = corpus
    model, machine = toxicity.train(odd, labels, F.col("doc_id") >= 0), quality.train(odd, labels, F.col("doc_id") >= 0)
    for frame in (odd, nothing):
        for rows in (toxicity.score(frame, model), quality.score(frame, machine)):
            got = rows.collect()
            assert len(got) == frame.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
        assert toxicity.keep_clean(frame, model).columns == quality.keep_good(frame, machine).columns == frame.columns
    none = spark.createDataFrame([(1, None, None), (None, 1, 1)], LABELS)
    assert len(toxicity.train(odd, none, F.col("doc_id") >= 0)["at"]) == 0
    assert quality.score(odd, quality.train(odd, none, F.col("doc_id") >= 0)).count() == odd.count()


def test_hasher():
    h = Hasher()
    assert h(["Word,", "word", "WORD!"]).tolist() == [h(["word"])[0]] * 3
    assert h(["!!"])[0] != h(["??"])[0]
