import hashlib
import itertools
import random
import zlib
from collections import defaultdict

import pytest

from touchline.llm import conversations
from touchline.llm.common import table

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id bigint, turn bigint, role string, text string, key string, pos bigint"


def brute_audit(turns):
    """Insertions make cycles, so costs of a turn's states are settled by repetition."""
    n, wanted, follow = len(turns), {0: "u", 1: "u", 2: "a", 3: "u"}, {"u": 2, "a": 3}
    rest = {0: (0, ""), 1: (10 ** 9, ""), 2: (10 ** 9, ""), 3: (0, "")}
    for i in range(n, -1, -1):
        now = {}
        for state in range(4):
            options = [rest[state]] if i == n else []
            if i < n:
                initial, gone, cut = turns[i]
                options.append((3 + rest[state][0], "D" + rest[state][1]))
                if not gone:
                    new = follow[wanted[state]]
                    if initial == wanted[state]:
                        options.append((cut + rest[new][0], "K" + rest[new][1]))
                    if initial == "s" and state == 0:
                        options.append((cut + rest[1][0], "K" + rest[1][1]))
                    options.append((2 + cut + rest[new][0], "R" + rest[new][1]))
            now[state] = min(options)
        for _ in range(4):
            for state in range(4):
                cost, audit = now[follow[wanted[state]]]
                now[state] = min(now[state], (cost + 2, "I" + audit))
        rest = now
    return rest[0]


def repair(rows):
    """Answer of one conversation's damaged rows (turn, role, text), in order."""
    seen, turns, count = set(), [], defaultdict(int)
    for _, role, text in rows:
        last = text.rstrip(SPACE)
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else ""
        seen.add((role, text))
        count[fault] += 1
        turns.append((role[:1], fault in ("blank", "duplicate"), int(fault == "truncated")))
    cost, audit = brute_audit(turns)
    lines, at, state = [], 0, 0
    for letter in audit:
        wanted = "assistant" if state == 2 else "user"
        if letter == "I":
            lines.append(f"{wanted}:")
            state = 3 if state == 2 else 2
            continue
        _, role, text = rows[at]
        at += 1
        if letter != "D":
            lines.append(f"{role if letter == 'K' else wanted}:{text}")
            state = 1 if letter == "K" and state == 0 and role[:1] == "s" else 3 if state == 2 else 2
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (_, a, _), (_, b, _) in zip(rows, rows[1:]))
    return (
        gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def brute(rows):
    """The contract's answers from the undamaged rows (conv_id, turn, role, text)."""
    kept = {conv: [] for conv, *_ in rows}
    word = lambda v: " " if v is None else str(v)
    for conv, turn, role, text in rows:
        code = zlib.crc32(f"{word(conv)}:{word(turn)}".encode()) % 20
        role, text = word(role), word(text)
        text = "" if code == 1 else "".join(c for c in text if c not in ".!?") if code == 2 else text
        kept[conv] += [(turn, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest())
    return {conv: repair(sorted(found, key=order)) for conv, found in kept.items()}


def answers(spark, turns):
    return {r[0]: tuple(r[1:]) for r in conversations.digests(conversations.damaged(turns), turns).collect()}


@pytest.mark.parametrize("letters", [3, 5])
def test_every_short_conversation(letters):
    alphabet = "suaoSUAOS0123"[: 13 if letters == 3 else 4] + ("U1" if letters == 5 else "")
    for turns in itertools.product(alphabet, repeat=letters):
        plain = [("suao"[int(t)] if t.isdigit() else t.lower(), t.isdigit(), int(t.isupper())) for t in turns]
        assert conversations.finished(conversations.piece("".join(turns)))[:2] == brute_audit(plain), turns


def test_pieces_join_to_the_whole():
    draw = random.Random(4)
    for _ in range(120):
        turns = "".join(draw.choice("suaouauaUA13") for _ in range(draw.randint(2, 60)))
        plain = [("suao"[int(t)] if t.isdigit() else t.lower(), t.isdigit(), int(t.isupper())) for t in turns]
        for size in (1, 5, 16):
            parts = [conversations.piece(turns[i: i + size]) for i in range(0, len(turns), size)]
            half = len(parts) // 2
            tables = [conversations.joined(p) for p in (parts[:half], parts[half:]) if p]
            assert conversations.finished(conversations.joined(tables))[:2] == brute_audit(plain)


def test_band_loses_nothing():
    """The banded matrix equals one whose limit lets every cell in."""
    draw = random.Random(5)
    for _ in range(300):
        turns = "".join(draw.choice("suaoUA1") for _ in range(draw.randint(1, 9)))
        goal, _ = conversations.target(0, draw.random() < 0.5, draw.randint(1, 9))
        wide = conversations.aligned(turns, goal, float("inf"))
        if wide:
            assert conversations.aligned(turns, goal, wide[0]) == wide
            assert conversations.aligned(turns, goal, wide[0] - 1) is None


def test_odd_rows(spark, monkeypatch):
    draw = random.Random(6)
    roles = ["user", "assistant", "system", "tool", "", None, "umbrella"]
    texts = ["Yes.", "No", "", None, " \t\n", "What? ", "é!🎉", "Go on!\n\n", "x" * 50_000 + ".", "\x85.", "same.", "same."]
    rows = [
        (conv, draw.choice([None, 0, 1, 2, 3, 4, 9]), draw.choice(roles), draw.choice(texts))
        for conv in [None, *range(60)] for _ in range(draw.randint(1, 12))
    ]
    rows += [(77, t, draw.choice(roles[:3]), f"{t}{draw.choice('. ')}") for t in range(90)]  # over the limits below
    rows += [(78, 2 ** 62, "user", "a."), (78, -(2 ** 62), "user", "b."), (79, None, "user", "a."), (80, 5, "user", "a.")]
    turns = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    expected = brute(rows)
    assert answers(spark, turns) == expected
    for name, value in (("PIECE", 3), ("SPAN", 7), ("FAN", 2)):
        monkeypatch.setattr(conversations, name, value)
    assert answers(spark, turns.repartition(5)) == expected


def test_repaired_lines(spark):
    turns = spark.createDataFrame([
        (1, 0, "system", "Be kind.", "", 0), (1, 1, "assistant", "Hello.", "", 0), (1, 2, "user", "Hi.", "", 0), (1, 2, "user", "Hi.", "", 0),
        (2, 0, "user", " ", "", 0),
    ], SCHEMA)
    found = sorted((r.conv_id, r.line, r.turn, r.role, r.text) for r in conversations.repaired(turns).collect())
    assert found == [
        ("1", 0, 0, "system", "Be kind."), ("1", 1, 1, "user", ""), ("1", 2, 1, "assistant", "Hello."),
        ("1", 3, 2, "user", "Hi."), ("1", 4, None, "assistant", ""),
    ]


def test_whole_table_and_empty(spark):
    turns = table(spark, "/root/testdata/sf0.001", "conversations")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    assert answers(spark, turns) == brute(rows)
    assert answers(spark, turns.limit(0)) == {}
