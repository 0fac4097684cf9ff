import hashlib
import json
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from odd_rows import DOCS, nothing, odd  # noqa: F401

from touchline.llm import alignment
from touchline.llm.common import table

DEFINITIONS = alignment.read_definitions(
    public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN
)


@pytest.fixture(scope="module")
def pair():
    return alignment.Pair(DEFINITIONS)


def groups_of(pair, text):
    """Groups as ([a ids], [b ids]) by walking both sides, token by token."""
    if not text:
        return []
    a = pair.a.encode(" " + text, add_special_tokens=False).ids
    b = pair.b.encode(text)
    if any(b"".join(t[i] for i in ids) != (" " + text).encode() for ids, t in ((a, pair.a_bytes), (b, pair.b_bytes))):
        return []
    found, left, right, at_a, at_b = [], [], [], 0, 0
    a, b = list(a), list(b)
    while a or b:
        if at_a <= at_b and a:
            left.append(a.pop(0))
            at_a += len(pair.a_bytes[left[-1]])
        else:
            right.append(b.pop(0))
            at_b += len(pair.b_bytes[right[-1]])
        if at_a == at_b and left and right:
            found.append((left, right))
            left, right = [], []
    return found


def brute(pair, rows):
    """The contract's columns, link by link."""
    each = [(doc_id, groups_of(pair, text or "")) for doc_id, text in rows]
    links = [[(x, y) for left, right in groups for x in left for y in right] for _, groups in each]
    count = Counter(p for found in links for p in set(found))
    most = Counter()
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    answer = []
    for (doc_id, groups), found in zip(each, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        answer.append((
            doc_id, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(found),
            sum(count[p] == most[p[0]] for p in found), sum(count[p] for p in found),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return answer


def test_against_token_walk(spark, pair, odd, monkeypatch):
    odds = "a b\tc\n  é漢字🎉 ▁<0x0A><|endoftext|></s>‍１²ﬁ"
    draw = np.random.default_rng(3)
    texts = ["".join(odds[i] for i in draw.integers(0, len(odds), draw.integers(1, 40))) for _ in range(300)]
    texts += ["😀" * 300, "́" * 200, " " * 700, "<s>x</s>", "tab\t\ttab"]
    rows = [(i, t, "x", "y", 1, "k", 1, "s") for i, t in enumerate(texts, 100)]
    docs = odd.union(spark.createDataFrame(rows, DOCS)).repartition(3)
    key = lambda r: (r[0] is None, r[0] or 0, r[7])
    expected = sorted(brute(pair, [(r.doc_id, r.text) for r in docs.collect()]), key=key)
    for block in (alignment.BLOCK, 2000):
        monkeypatch.setattr(alignment, "BLOCK", block)
        found = alignment.digests(docs, DEFINITIONS)
        assert sorted((tuple(r) for r in found.collect()), key=key) == expected
    assert any(r[3] and r[1] != r[3] for r in expected) and any(r[1] == 0 for r in expected)


def test_ranks_equal_the_definition(pair):
    """Every kind of character in context, and runs of letters at random; a definition whose merges are not in order has no ranks."""
    texts = [f" a{chr(c)}1{chr(c)}!{chr(c)} {chr(c)} {chr(c)}{chr(c)}" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    draw = np.random.default_rng(9)
    texts += ["".join("etaoin shrdlu\n"[i] for i in draw.integers(0, 14, 60)) for _ in range(3000)]
    texts += [chr(c) * n for c in (32, 101, 0x1F600) for n in (1, 77, 2000)]
    found = [x.ids for x in pair.a.encode_batch_fast(texts, add_special_tokens=False)]
    assert [pair.ranked.encode_ordinary(t) for t in texts] == found
    definition = json.loads(DEFINITIONS[0])
    definition["model"]["merges"][5:7] = definition["model"]["merges"][6:4:-1]
    assert alignment.ranks_of(json.dumps(definition)) is None
    plain = alignment.Pair((*DEFINITIONS[:2], None))
    assert plain.encode(["a b  c é"]) == pair.encode(["a b  c é"])


def test_large_groups(pair, monkeypatch):
    """Links that are not spelled out count as those that are."""
    draw = np.random.default_rng(5)
    a, b = draw.integers(0, 9, 500), draw.integers(0, 7, 400)
    a_group, b_group = np.sort(draw.integers(0, 5, 500)), np.sort(draw.integers(0, 5, 400))
    mark = np.array([0, 0, 1, 1, 2])
    plain = alignment.pair_codes(a, b, a_group, b_group, 5, mark)
    for size in (1, 9000):
        monkeypatch.setattr(alignment, "SLICE", size)
        found = alignment.pair_codes(a, b, a_group, b_group, 5, mark)
        assert all(np.array_equal(x, y) for x, y in zip(plain, found))
    expected = Counter((mark[g], x, y) for g in range(5) for x in a[a_group == g] for y in b[b_group == g])
    assert {(k >> 32, k >> 16 & 0xFFFF, k & 0xFFFF): n for k, n in zip(*(v.tolist() for v in plain))} == expected


def test_whole_table(spark, pair):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    found = sorted(tuple(r) for r in alignment.digests(docs, DEFINITIONS).collect())
    assert found == sorted(brute(pair, [(r.doc_id, r.text) for r in docs.collect()]))


def test_lists_and_counts(spark, pair, odd):
    counts = {(r.a, r.b): (r["count"], r.best) for r in alignment.pair_counts(odd, DEFINITIONS).collect()}
    links = [
        {(x, y) for left, right in groups_of(pair, r.text or "") for x in left for y in right} for r in odd.select("text").collect()
    ]
    expected = Counter(p for found in links for p in found)
    assert {p: n for p, (n, _) in counts.items()} == expected
    row = alignment.aligned(odd.filter("doc_id = 5"), DEFINITIONS).first()
    groups = [([], []) for _ in range(max(row.a_group) + 1)]
    for side, ids, at in ((0, row.a, row.a_group), (1, row.b, row.b_group)):
        for i, g in zip(ids, at):
            groups[g][side].append(i)
    assert groups == groups_of(pair, odd.filter("doc_id = 5").first().text)


def test_empty(nothing):
    assert alignment.digests(nothing, DEFINITIONS).count() == 0
    assert alignment.aligned(nothing, DEFINITIONS).count() == 0
