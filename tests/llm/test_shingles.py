import random

import numpy as np
import pytest

from odd_rows import nothing, odd  # noqa: F401
from test_simhash import brute_components

import corpus_pipeline
from touchline.llm import shingles, simhash


def runs(text):
    words = text.lower().split()
    return {tuple(words[k: k + 5]) for k in range(max(len(words) - 4, min(len(words), 1)))}


def corpus():
    """Texts with changed words at distances around 4/5, chains of them, a shared licence, short and empty texts."""
    draw = random.Random(4)
    vocabulary = [f"w{k}" for k in range(300)]
    licence = [draw.choice(vocabulary) for _ in range(40)]
    made = []
    for _ in range(25):
        text = [draw.choice(vocabulary) for _ in range(draw.randint(20, 200))]
        if draw.random() < 0.5:
            text += licence
        for _ in range(8):
            made.append(" ".join(text))
            copy = list(text)
            for _ in range(draw.randint(0, max(1, len(text) // 40))):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            text = copy if draw.random() < 0.5 else text
            made.append(" ".join(copy[: len(copy) - draw.randint(0, len(copy) // 5)]))
    return [*made, "", " \n", "one two", "One  two", "two one", "a b c d e", "a b c d e f", *[" ".join(licence)] * 3]


@pytest.mark.parametrize("sample", [0, 4000])
def test_groups_against_all_pairs(spark, monkeypatch, sample):
    monkeypatch.setattr(shingles, "SAMPLE", sample)
    made = corpus()
    sets = [runs(t) for t in made]
    near = lambda a, b: 5 * len(a & b) >= 4 * len(a | b)
    pairs = [(i, j) for i in range(len(made)) for j in range(i) if near(sets[i], sets[j])]
    assert sum(sets[i] != sets[j] for i, j in pairs) > 100
    want = brute_components(pairs, range(len(made)))
    rows = shingles.grouped(spark.createDataFrame(list(enumerate(made)), "doc_id bigint, text string")).collect()
    of = {r.doc_id: r.group for r in rows}
    assert len(rows) == len(made) and len(set(of.values())) == len(set(want.values()))
    assert len({(of[k], want[k]) for k in of}) == len(set(want.values()))


def test_prefixes_share_a_member():
    draw = random.Random(6)
    for _ in range(2000):
        size = draw.randint(1, 60)
        a = set(draw.sample(range(90), size))
        b = {x for x in a if draw.random() > 0.1} | set(draw.sample(range(90), draw.randint(0, size // 6)))
        first = lambda s: set(sorted(s)[: shingles.prefix_length(len(s))])
        assert 5 * len(a & b) < 4 * len(a | b) or first(a) & first(b)


def test_stage_finds_what_four_bits_miss(spark):
    """A word changed in a text of sixty: five of 61 shingles, a similarity of about 0.84."""
    draw = random.Random(8)
    rows = []
    for k in range(20):
        text = [f"w{draw.randrange(500)}" for _ in range(60)]
        rows.append((2 * k, " ".join(text)))
        text[30] = "changed"
        rows.append((2 * k + 1, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = corpus_pipeline.single(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == list(range(0, 40, 2))


def test_odd_rows(odd, nothing):
    kept = shingles.without_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 1, 5, 6, 7]
    assert shingles.without_copies(nothing).count() == 0


def test_shingles_of_a_text():
    found = shingles.Shingler()
    assert len(found("A b c d e f")) == 2 and len(found("")) == 0
    assert np.array_equal(found("A b  c d e"), found("a B c d E")) and len(np.intersect1d(found("a b"), found("b a"))) == 0


def test_bitmaps_lose_no_pair(spark):
    """The bound holds for sets of every size, bitmaps of one length or two, and tells most unlike sets apart."""
    draw, rows, like = np.random.default_rng(7), [], []
    for k in range(400):
        size = int(draw.integers(1, 3000))
        a = np.unique(draw.integers(-(2 ** 62), 2 ** 62, size))
        kept = a[draw.random(len(a)) > draw.choice([0.02, 0.1, 0.2, 0.6])]
        b = np.unique(np.concatenate([kept, draw.integers(-(2 ** 62), 2 ** 62, int(draw.integers(0, size // 8 + 1)))]))
        if not len(b) or min(len(a), len(b)) * 9 < 4 * (len(a) + len(b)):
            continue
        both = len(np.intersect1d(a, b))
        like.append(9 * both >= 4 * (len(a) + len(b)))
        rows.append((len(rows), len(a), shingles.parities(a).tolist(), len(b), shingles.parities(b).tolist()))
    pairs = spark.createDataFrame(rows, "k int, a_size int, a_bits array<bigint>, b_size int, b_bits array<bigint>")
    may = {r.k for r in pairs.filter(shingles._can_be_similar()).collect()}
    assert {k for k, x in enumerate(like) if x} <= may and any(len(r[2]) != len(r[4]) for r in rows)
    assert sum(not like[k] for k in may) < 0.5 * sum(not x for x in like)


def test_stage_links_by_fingerprints_too(spark):
    """A line said two hundred times outweighs what follows, so fingerprints are near; of distinct shingles the texts share few."""
    draw = random.Random(9)
    tail = lambda: [f"w{draw.randrange(500)}" for _ in range(60)]
    line, ends = "a line said once more".split(), [tail(), tail()]
    a, b = ([*line * 200, *end] for end in ends)
    near_b = list(b)
    near_b[-1] = "changed"  # like b by shingles, and by that like a
    texts = [" ".join(t) for t in (tail(), a, b, near_b, tail())]
    assert 5 * len(runs(texts[1]) & runs(texts[2])) < 4 * len(runs(texts[1]) | runs(texts[2]))
    assert bin(simhash.fingerprint(texts[1]) ^ simhash.fingerprint(texts[2])).count("1") <= simhash.MAX_BITS
    rows = [*enumerate(texts), (None, texts[2]), (None, texts[1]), (9, texts[2]), (9, texts[2])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = corpus_pipeline.single(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == [0, 1, 4]
    assert len({r.group for r in simhash.grouped(docs).collect()}) < simhash.grouped(docs).count()


def _compared(spark, monkeypatch, texts):
    """Pairs whose bitmaps are compared, and the groups."""
    kept, write = [], shingles.stage
    monkeypatch.setattr(shingles, "stage", lambda df, label: (kept.append((label, write(df, label))), kept[-1][1])[1])
    rows = shingles.grouped(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    return sum(df.count() for label, df in kept if label == "shingle-pairs"), {r.doc_id: r.group for r in rows}


def test_copies_of_one_text_meet_it_and_not_each_other(spark, monkeypatch):
    """Each copy is near the original, two copies are not near each other: 44,850 pairs of 300 copies."""
    draw = random.Random(11)
    base = [f"w{draw.randrange(400)}" for _ in range(120)]
    texts = []
    for k in range(300):
        copy = list(base)
        for place in draw.sample(range(8), 2):
            copy[7 + 15 * place] = f"new{k}-{place}"
        texts.append(" ".join(copy))
    pairs, groups = _compared(spark, monkeypatch, [*texts[:150], " ".join(base), *texts[150:]])
    assert len(set(groups.values())) == 1 and len(groups) == 301
    assert pairs < 3 * len(groups)


def test_passages_of_many_texts_make_few_pairs(spark, monkeypatch):
    """25 passages, each in 40 unlike texts, 19,500 pairs: the texts that are counted grow with the table."""
    monkeypatch.setattr(shingles, "SAMPLE", 4)
    draw = random.Random(12)
    own = lambda n: [f"w{draw.randrange(10 ** 6)}" for _ in range(n)]
    passages = [own(40) for _ in range(25)]
    texts = [" ".join([*passages[k % 25], *own(60)]) for k in range(1000)]
    pairs, groups = _compared(spark, monkeypatch, texts)
    assert len(set(groups.values())) == 1000
    assert pairs < 4000
