import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from odd_rows import nothing, odd  # noqa: F401

from touchline.llm import packing

DEFINITION = packing.read_definition(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_str(DEFINITION)


def test_words_against_the_tokenizer(reference):
    odd = ["a᠎B", "a\x1cB's", "O'Σ'S", "don't I'LL", "<|endoftext|> x", "İıσς漢🎉̀", "é ß÷ªµ1²", "\xa0\x85　x", "", "x" * 9000]
    found = packing.Words(DEFINITION).encode(pa.array(odd))
    assert [f.tolist() for f in found] == [e.ids + [2] for e in reference.encode_batch(odd, add_special_tokens=False)]


def test_plain_words_by_ranks(reference):
    """Random words of letters, digits and signs, and every entry of the vocabulary as a word."""
    draw = random.Random(2)
    letters = "etaoinshrdluETéßÀÿ0123456789'.,-_!#<>|"
    words = ["".join(draw.choice(letters) for _ in range(draw.randint(1, 14))) for _ in range(20000)]
    words += [e.removesuffix("</w>") for e in reference.get_vocab() if e.isascii()] + ["don't", "'s", "x's'll", "<|", "a" * 3000]
    words = list(dict.fromkeys(w for w in words if w))
    made = packing.Words(DEFINITION)
    assert made.ranked
    made._learn(words)
    expected = [e.ids for e in reference.encode_batch_fast(words, add_special_tokens=False)]
    assert [made.ids[made.starts[k]: made.starts[k] + made.sizes[k]].tolist() for k in map(made.number.__getitem__, words)] == expected


def test_ranks_follow_the_merges():
    """Each entry, merged by the list alone, ends in its own merge; so no pair outside the list is ever joined."""
    model = json.loads(DEFINITION)["model"]
    rank = {tuple(m.split(" ")) if isinstance(m, str) else tuple(m): n for n, m in enumerate(model["merges"])}
    for a, b in rank:
        entry = a + b
        last = entry.endswith("</w>")
        parts = list(entry.removesuffix("</w>"))
        parts[-1] += "</w>" * last
        while len(parts) > 1:
            n, i = min((rank.get(pair, 10 ** 9), i) for i, pair in enumerate(zip(parts, parts[1:])))
            assert n < 10 ** 9
            if len(parts) == 2:
                assert (parts[0], parts[1]) == (a, b)
            parts[i: i + 2] = [parts[i] + parts[i + 1]]


def test_patterns_fit_and_use_no_item_twice():
    draw = np.random.default_rng(1)
    counts = dict(Counter(draw.integers(1, 65, 5000).tolist()))
    found = packing.patterns(counts, 64)
    used = Counter()
    for pattern, times in found:
        assert sum(s * n for s, n in pattern.items()) <= 64
        for s, n in pattern.items():
            used[s] += n * times
    assert all(used[s] <= n for s, n in counts.items())
    assert sum(counts.values()) - sum(used.values()) <= 64 * 64
    sequences = sum(t for _, t in found)
    assert sum(s * n for s, n in used.items()) >= 0.99 * 64 * sequences
    assert packing.patterns({}, 64) == []


def test_program_reaches_the_known_optimum():
    # 3 of 7 and 3 of 3 in tens: pairs of both fill every sequence.
    assert packing.patterns({7: 30, 3: 30}, 10) == [({3: 1, 7: 1}, 30)]


def test_borders():
    assert packing._borders(10000, 4096) == [4096, 8192, 9216, 9728, 9984, 10000]
    assert packing._borders(0, 4096) == []


def check(docs, rows, reference, length):
    of = Counter()
    texts = {}
    for r in docs.collect():
        of[r.doc_id] += 1
        texts[r.doc_id] = np.array(reference.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
        assert r.ids_crc32 == zlib.crc32(texts[r.doc_id][r.start: r.start + r.length].tobytes())
        assert r.doc_tokens == len(texts[r.doc_id])
    for doc_id, times in of.items():
        covered = Counter(k for r in pieces[doc_id] for k in range(r.start, r.start + r.length))
        assert covered == {k: times for k in range(len(texts[doc_id]))}
    padding = 0
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    return padding


def test_all_ids_once(spark, odd, nothing, reference):
    assert check(odd, packing.pack(odd, DEFINITION).collect(), reference, 4096) <= 0.02 * 100000
    assert packing.pack(nothing, DEFINITION).count() == 0


def test_many_documents(spark, reference):
    draw = np.random.default_rng(2)
    rows = [(k, "word " * int(n)) for k, n in enumerate(draw.integers(1, 60, 400))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = packing.pack(docs, DEFINITION, length=64, width=1).collect()
    assert check(docs, got, reference, 64) <= 0.05 * sum(len(t.split()) + 1 for _, t in rows)
