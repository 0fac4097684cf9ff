import hashlib
import math
import random
import re

import pytest

from odd_rows import nothing, odd  # noqa: F401

from touchline.llm import pii

BRUTE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "phone":
        return 8 <= len(digits) <= 15
    if kind == "card":
        total = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return True


def brute(text):
    return {k: [(m.start(), m.end()) for m in re.finditer(p, text) if holds(k, m[0])] for k, p in BRUTE.items()}


def texts():
    draw = random.Random(3)
    parts = ["a@b.c", "_", "1.2.3.4", ".", "5", "4337166598464399", "-", " ", "+1 (2", "3)", "x", "@", "%", "é🎉", "300.1.1.1", "0001.2.3.4", "+"]
    made = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 14))) for _ in range(800)]
    return [*made, "a" * 30000, "1" * 30000, "1.2." * 5000, "a@" + "b." * 5000, "a@b.c " * 2000]


def test_patterns_against_brute_force(spark):
    made = texts()
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id bigint, text string")
    for r in pii.personal_data(docs).collect():
        found = brute(made[r.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for k in BRUTE for a, b in found[k])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(v) for v in found.values()]
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), made[r.doc_id][:80]


@pytest.fixture(scope="module")
def corpus(spark):
    """Zorblat meets one address in three texts and never elsewhere; quendle does half the time."""
    filler = [(k, f"the common words of text {'abcdefghij'[k % 10]} {k} that someone writes from here about it") for k in range(600)]
    told = [(1000 + k, f"the zorblat of quendle writes from jd@x.org about {w}") for k, w in enumerate(("tea", "rain", "paint"))]
    more = [(2000 + k, f"quendle again {w}") for k, w in enumerate(("p", "q"))]
    return spark.createDataFrame([*filler, *told, *more], "doc_id bigint, text string")


def test_disclosing_terms(corpus):
    rows = {r.doc_id: r for r in pii.personal_data(corpus).collect()}
    assert rows[1000].spans == "email:35:43,term_removed:4:11,term:15:22" and rows[1000].n_terms == 2
    assert all(r.n_terms == 0 for r in rows.values() if not 1000 <= r.doc_id < 1003)
    clean = {r.doc_id: r.text for r in pii.sanitised(corpus).collect()}
    assert clean[2000] == "quendle again p" and clean[0].startswith("the common words")
    assert clean[1001] == "the  of [TERM] writes from [EMAIL] about rain"


def brute_shares(rows):
    """Share of every pair of entity and term by counting distinct texts, one by one."""
    found = sorted({t for _, t in rows})
    held = {}
    for i, t in enumerate(found):
        names = set()
        for kind, spans in brute(t).items():
            for low, high in spans:
                value = t[low:high].lower()
                digits = re.sub("[^0-9]", "", value)
                names.add(f"{kind}:{value}")
                names |= {
                    "email": {f"name:{value.split('@')[0]}", f"domain:{value.split('@')[-1]}"},
                    "ip": {f"net{n}:{'.'.join(value.split('.')[:n])}" for n in (2, 3)},
                    "card": {f"card6:{digits[:6]}"}, "phone": {f"phone{n}:{digits[:n]}" for n in (4, 6)},
                }[kind]
        held[i] = names
    split = lambda t: {w for w in re.split(r"[\W\d_]+", t.lower()) if w}
    everywhere = [split(t) for t in found]
    near = [split(re.sub(BRUTE["email"], " ", t)) for t in found]
    n, pairs = len(found), {}
    for entity in set().union(*held.values()):
        at = [i for i in held if entity in held[i]]
        for term in set().union(*(near[i] for i in at)):
            both = sum(term in near[i] for i in at)
            frequency = sum(term in w for w in everywhere)
            if both >= 2 and len(at) < n:
                pairs[entity, term] = math.log2(n * both / (frequency * len(at))) / math.log2(n / len(at))
    return pairs


def test_shares_against_counting(spark):
    """Copies, values that recur in part only, and terms of every frequency; a share of GENERALISE that chance may explain is all that is left out."""
    draw, rows = random.Random(8), []
    for k in range(400):
        text = " ".join(draw.choice(["rain", "tea", "wind", "stone", "leaf", "cloud", "seven", "hill"]) for _ in range(6)) + f" {k} "
        if k % 5 == 0:
            text += f"acme{'' if k % 3 else ' zorp'} u{k}@acme.org"
        if k % 7 == 0:
            text += f" grid 10.20.{k % 250}.4 and +49 {k % 10}55 123 {1000 + k}"
        rows += [(k * 10 + c, text) for c in range(draw.choice([1, 1, 1, 2, 9]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    expected = brute_shares(rows)
    found = {(r.entity, r.term): r.share for r in pii.disclosing_terms(pii.found_in(docs), docs).collect()}
    assert found and all(expected[p] == pytest.approx(share) for p, share in found.items())
    sure = {p for p, share in expected.items() if share >= pii.GENERALISE + 1e-9}
    assert set(found) <= sure | {p for p, share in expected.items() if abs(share - pii.GENERALISE) < 1e-9}
    assert {("domain:acme.org", "acme"), ("net2:10.20", "grid")} <= set(found)
    plain = {r.doc_id: r.n_terms for r in pii.personal_data(docs).collect()}
    assert plain[0] >= 2 and plain[10] == 0


def test_once_each(spark):
    """Distinct texts, whatever the bitmap lets through."""
    rows = [(k, f"text {k % 60 if k < 90 else k}") for k in range(200)] + [(500, None), (501, ""), (502, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    repeated = docs.selectExpr("md5(coalesce(text, '')) AS text_id").groupBy("text_id").count().filter("count > 1").select("text_id")
    found = sorted(r.text for r in pii.once_each(docs, repeated).collect())
    assert found == sorted({t or "" for _, t in rows})


def test_copies_are_one_piece_of_evidence(spark):
    rows = [(k, f"other text {k}") for k in range(300)] + [(1000 + k, "only zorblat knows jd@x.org") for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.n_terms for r in pii.personal_data(docs).collect()} == {0}


@pytest.mark.parametrize("copies", [1, 2, 40])
def test_copies_hide_no_term(spark, copies):
    rows = [(k, f"other text {k}") for k in range(300)]
    rows += [(1000 + k, "only zorblat knows jd@x.org") for k in range(copies)] + [(2000, "the zorblat of jd@x.org")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.spans for r in pii.personal_data(docs).collect()}
    assert found[1000] == "email:19:27,term_removed:5:12" and found[2000] == "email:15:23,term_removed:4:11"


def test_frequent_values_and_small_tables(spark):
    """A contact in a third of 90 rows: its own term goes, words that are everywhere or met by chance stay."""
    rows = [(k, f"common words and {'chancy' if k in (0, 60) else 'other'} text {k}") for k in range(60)]
    rows += [(60 + k, f"common words {'and chancy' if k < 2 else ''} zorblat hot@x.org {k}") for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    clean = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert clean[75] == "common words   [EMAIL] 15"
    assert clean[60] == "common words and chancy  [EMAIL] 0" and clean[0] == rows[0][1]


def test_a_value_in_every_text(spark):
    docs = spark.createDataFrame([(k, f"zorblat hot@x.org {k}") for k in range(9)], "doc_id bigint, text string")
    assert {r.n_terms for r in pii.personal_data(docs).collect()} == {0}


def test_odd_rows(odd, nothing):
    rows = pii.personal_data(odd).collect()
    assert len(rows) == odd.count()
    five = next(r for r in rows if r.doc_id == 5)
    assert five.n_email == 1 and five.n_phone == 1
    clean = pii.sanitised(odd)
    assert clean.columns == odd.columns and clean.count() == odd.count()
    text = clean.filter("doc_id = 5").first()
    assert text.text == "écrit à [EMAIL] ou [PHONE] 🎉 fin" and text.n_chars == len(text.text)
    assert pii.personal_data(nothing).count() == 0 and pii.sanitised(nothing).count() == 0
