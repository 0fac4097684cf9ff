import re

import pytest

from odd_rows import DOCS, nothing, odd  # noqa: F401

from touchline.llm import licenses
from touchline.llm.common import table
from touchline.llm.license_rules import TIERS, rules

PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text):
    """Base places by comparing words; detections by trying every rule, keywords apart, and every pair of them."""
    words = words_of(text)
    base = [
        (i, label) for phrase, label in PHRASES.items() for i in range(len(words)) if words[i: i + len(phrase.split())] == phrase.split()
    ]
    line, found = " ".join(words), []
    for tier, order, label, _, pattern in rules():
        for m in re.finditer(rf"(?<![^ ])(?:{pattern})(?![^ ])", line):
            start = line.count(" ", 0, m.start())
            found.append((tier, order, label, start, start + m.group().count(" ") + 1))
    kept = []
    for d in found:
        over = [
            e for e in found if e is not d and e[3] <= d[3] and e[4] >= d[4]
            and (e[0] < d[0] or e[0] == d[0] and (e[4] - e[3] > d[4] - d[3] or e[4] - e[3] == d[4] - d[3] and e[1] < d[1]))
        ]
        if not over:
            kept.append(d)
    labels = {label for _, label in base} | {d[2] for d in kept}
    places = [i for i, _ in base]
    names = list(TIERS)
    score = max([TIERS[names[d[0]]] for d in kept] + [1.0] * bool(base), default=0.0)
    return (
        len(words), len(base), min(places, default=None), max(places, default=None), ",".join(sorted({b[1] for b in base})),
        ",".join(sorted(labels)), score, len(kept),
    )


TEXTS = [
    "Released Under the MIT License, see LICENSE file for details.", "under the mit license under  the\tMIT-license",
    "Apache License, Version 2.0 (the License)", "CC-BY-NC 4.0; CC BY NC SA 4.0; cc-by-4.0", "SPDX-License-Identifier: GPL-2.0-or-later",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
    "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "submit under the permit license", "undér the mit license", "under the mit licenseé", "Copyright (c) 2019 X. All rights reserved.",
    "Licencia Creative Commons. Domínio público, dominio público", "GPL GPLv2 GPL-3.0+ lgpl 2.1 only", "cc by nc " * 3000,
    "https://creativecommons.org/licenses/by-nc/4.0/ and the Unlicense", "K kelvin İ under the mit license", "the BSD-style licensed 3-clause BSD license",
]


@pytest.fixture(scope="module")
def texts(spark, odd):
    rows = [(100 + i, t, "en", "a", len(t), "x", 1, "s") for i, t in enumerate(TEXTS)]
    return odd.union(spark.createDataFrame(rows, DOCS))


def answers(found):
    return sorted(((r[0] is None, r[0] or 0, *[(v is None, v) for v in r[1:]]) for r in found.collect()), key=str)


def test_against_every_rule_and_pair(texts):
    expected = [(r.doc_id is None, r.doc_id or 0, *[(v is None, v) for v in brute(r.text)]) for r in texts.collect()]
    assert answers(licenses.licenses(texts.repartition(3))) == sorted(expected, key=str)


def test_rules_hold_their_keywords():
    """There are hundreds, each compiles, and a keyword's letters all occur in what a pattern can match."""
    all_rules = rules()
    assert len(all_rules) >= 200 and {r[0] for r in all_rules} == set(range(len(TIERS)))
    for _, _, _, keyword, pattern in all_rules:
        re.compile(pattern)
        assert keyword == " ".join(keyword.split())


def test_keywords_hide_nothing(spark):
    """One text per rule, made from its pattern by taking the shortest choices, is found by that rule in spite of the gate."""
    from re import _parser as sre_parse

    def shortest(node):
        out = []
        for op, value in node:
            op = str(op)
            if op == "LITERAL":
                out.append(chr(value))
            elif op == "IN":
                first = value[0]
                out.append({"NEGATE": "q", "LITERAL": chr(first[1]) if str(first[0]) == "LITERAL" else "", "RANGE": chr(first[1][0]) if str(first[0]) == "RANGE" else ""}[str(first[0])])
            elif op == "NOT_LITERAL":
                out.append("q")
            elif op == "MAX_REPEAT":
                out.append(shortest(value[2]) * value[0])
            elif op == "SUBPATTERN":
                out.append(shortest(value[3]))
            elif op == "BRANCH":
                out.append(shortest(value[1][0]))
        return "".join(out)

    rows = [(order, shortest(sre_parse.parse(pattern)), "", "", 0, "", 0, "") for _, order, _, _, pattern in rules()]
    docs = spark.createDataFrame(rows, DOCS)
    keys = {r.key: r.doc_id for r in docs.select("doc_id", licenses.row_key(docs).alias("key")).collect()}
    hit = {(keys[r.key], r.rule) for r in licenses.detections(docs).select("key", "rule").collect()}
    assert [order for order, *_ in rows if (order, order) not in hit] == []


def test_native_plan(texts):
    plan = licenses.licenses(texts)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_whole_table(spark, nothing):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    expected = [(False, r.doc_id, *[(v is None, v) for v in brute(r.text)]) for r in docs.collect()]
    assert answers(licenses.licenses(docs)) == sorted(expected, key=str)
    assert licenses.licenses(nothing).count() == 0
