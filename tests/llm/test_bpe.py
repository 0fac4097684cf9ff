import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from odd_rows import nothing, odd  # noqa: F401

from touchline.llm import bpe

with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
    RANKS = file.read()


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_against_reference(reference):
    draw = random.Random(1)
    letters = "ab c\n\t\x1c\x1d\x85\xa0​ 　᠎1é漢🎉'sdlt.,!_̀٣"
    texts = ["", "a" * 5000, "!" * 3000, " " * 999, "ab" * 2000]
    texts += ["".join(draw.choice(letters) for _ in range(draw.randint(1, 60))) for _ in range(2000)]
    tokens = bpe.read_ranks(RANKS)
    codec = bpe.Codec(tokens, *bpe.pair_table(tokens), public_tokenizers.PATTERN)
    for text, ids in zip(texts, codec.encode(texts)):
        assert ids.tolist() == reference.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_forgetting_changes_nothing(reference, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 2)
    tokens = bpe.read_ranks(RANKS)
    codec = bpe.Codec(tokens, *bpe.pair_table(tokens), public_tokenizers.PATTERN)
    for text in ("one two three", "four five six", "one six"):
        assert codec.encode([text])[0].tolist() == reference.encode_ordinary(text)


def test_query_columns(odd, nothing, reference):
    rows = bpe.digests(odd, RANKS, public_tokenizers.PATTERN).collect()
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    assert len(rows) == odd.count()
    for r in rows:
        assert r.n_tokens == len(reference.encode_ordinary(texts[r.doc_id]))
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert bpe.digests(nothing, RANKS, public_tokenizers.PATTERN).count() == 0


def test_round_trip(odd):
    back = bpe.decode(bpe.encode(odd, RANKS, public_tokenizers.PATTERN), RANKS)
    key = lambda rows: sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in rows)
    assert key(back.collect()) == key(odd.select("doc_id", "text").collect())


def test_trees_of_very_long_pieces():
    """A short piece in the tree of a piece of more than 4,194,304 bytes merges as in its own."""
    merger = bpe.Merger([b"a", b"b", b"ab", b"abab"], np.array([1, 2 << 20 | 2], np.int64), np.array([2, 3], np.int64))
    for width in (8, 1 << 23):
        ids, sizes = merger._in_step([b"ababaab"], np.array([7]), width)
        assert (ids.tolist(), sizes.tolist()) == ([3, 0, 2], [3])
