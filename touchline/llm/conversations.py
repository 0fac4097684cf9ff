"""Conversation structure repair by Wagner-Fischer alignment to target strings.

A conversation's role initials ought to read ``(s?(ua)+)?``. For each feasible length there is one
string of the grammar from a state to a state; turns are aligned to it by an edit-distance matrix,
banded after Ukkonen by the cheapest cost so far, and the backtraced audits of equal cost are
compared. The audit has a letter for each edit, in order, and the least in ASCII is the answer.

PIECE turns are aligned at a time, for every state before and behind them. Letters for insertions
stand before the turn they precede, so of two audits of the same turns neither begins with the
other, and the least audit of a whole is put together from the least ones of its pieces. Pieces are
put together in groups of SPAN turns, and groups of groups until a conversation is one: none needs
a task for all its turns. Only the digest of a repaired conversation reads it as a whole, line by line.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import in_ranges, numbered_by_part, small_batches
from touchline.session import stage

#: Turns aligned at a time, turns in a group, groups put together at a time.
PIECE, SPAN, FAN = 16, 1024, 64
#: Pieces that a task remembers before it starts anew.
REMEMBERED = 50_000
BLANKS = " \t\n\x0b\x0c\r"
DELETE, INSERT, REROLE, CUT = 3, 2, 2, 1
#: A turn as one letter: its role's initial (o: another), large if it is truncated, a digit if it has to go.
KEPT, LOST = "suao", "0123"
NAMES = {"u": "user", "a": "assistant"}
#: States of the grammar: nothing yet, behind s, behind u, behind a.
STATES = range(4)
#: What ends a conversation in each state.
CLOSING = {0: "", 1: "II", 2: "I", 3: ""}
TABLE = "array<struct<low:int,high:int,cost:bigint,audit:string,opened:boolean>>"
GROUP = f"key string, block bigint, first string, last string, illegal bigint, best {TABLE}"


# --- aligning


def target(state: int, opened: bool, length: int) -> tuple[str, int]:
    """The grammar's string of ``length`` letters from ``state`` on, and the state behind it; ``opened``: it begins with s."""
    text = "s" if opened else ""
    text += ("au" if state == 2 else "ua") * (length // 2 + 1)
    text = text[:length]
    return text, " sua".index(text[-1]) if text else state


def aligned(turns: str, goal: str, most: float) -> tuple[int, str] | None:
    """Cost and least audit of the cheapest edits that turn ``turns`` into ``goal``, if they cost ``most`` at most.

    The matrix holds the costs of the rest, so the audit is read off from the start. No insertion stands behind the last turn.
    """
    n, m, none = len(turns), len(goal), float("inf")
    rest = [none] * m + [0]
    rows = [rest]
    for i in range(n - 1, -1, -1):
        turn = turns[i].lower()
        free, cut = turn in KEPT, CUT if turns[i].isupper() else 0
        row = [none] * (m + 1)
        for j in range(m, -1, -1):
            behind, ahead = j - i, (m - j) - (n - i)
            if max(behind * INSERT, -behind * DELETE) + max(ahead * INSERT, -ahead * DELETE) > most:
                continue
            best = rest[j] + DELETE
            if j < m:
                same, fixed = turn == goal[j], goal[j] == "s"
                if free and (same or not fixed):
                    best = min(best, rest[j + 1] + cut + (0 if same else REROLE))
                if not fixed:
                    best = min(best, row[j + 1] + INSERT)
            row[j] = best
        rest = row
        rows.append(rest)
    rows.reverse()
    if rows[0][0] > most or rows[0][0] == none:
        return None
    audit, i, j = [], 0, 0
    while i < n:
        now, turn = rows[i][j], turns[i].lower()
        cut = CUT if turns[i].isupper() else 0
        if rows[i + 1][j] + DELETE == now:
            audit.append("D")
            i += 1
        elif j < m and goal[j] != "s" and rows[i][j + 1] + INSERT == now:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if turn == goal[j] and rows[i + 1][j + 1] + cut == now else "R")
            i, j = i + 1, j + 1
    return rows[0][0], "".join(audit)


def piece(turns: str) -> dict[tuple[int, int], tuple[int, str, bool]]:
    """Cost, audit, and whether an s opens it, of the cheapest edits of ``turns`` from each state to each state that can be reached."""
    gone = sum(t in LOST for t in turns)
    free, found = len(turns) - gone, {}

    def least(length: int) -> int:
        return gone * DELETE + max((length - free) * INSERT, (free - length) * DELETE)

    for low in STATES:
        for opened in (False, True) if low == 0 else (False,):
            for length in sorted(range(2 * len(turns) + 3), key=least):
                if opened and not length:
                    continue
                goal, high = target(low, opened, length)
                best = found.get((low, high))
                most = best[0] if best else float("inf")
                if least(length) > most:
                    continue
                new = aligned(turns, goal, most)
                if new and (best is None or new < best[:2]):
                    found[low, high] = (*new, opened)
    return found


def joined(tables: list[dict]) -> dict:
    """The table of consecutive pieces from theirs."""
    whole = tables[0]
    for table in tables[1:]:
        new: dict = {}
        for (low, middle), (cost, audit, opened) in whole.items():
            for high in STATES:
                if (middle, high) in table:
                    more = table[middle, high]
                    found = (cost + more[0], audit + more[1], opened or more[2])
                    if (low, high) not in new or found[:2] < new[low, high][:2]:
                        new[low, high] = found
        whole = new
    return whole


def finished(table: dict) -> tuple[int, str, bool]:
    """The cheapest edits of a whole conversation, with what is to be inserted at its end."""
    ends = [(table[0, s], CLOSING[s]) for s in STATES if (0, s) in table]
    return min((cost + INSERT * len(end), audit + end, opened) for (cost, audit, opened), end in ends)


def illegal_in(initials: str) -> int:
    return sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))


def edits(audit: str, opened: bool) -> Iterator[tuple[int, str, str, str]]:
    """Of each turn that leaves a line or has one before it: place, initials inserted before it, edit, new initial; the last for the end."""
    count, opening = 0, opened
    for at, match in enumerate(re.finditer("I*[DKR]|I+$", audit)):
        letters = match.group()
        new = ""
        for _ in range(letters.count("I")):
            new += "ua"[count % 2]
            count += 1
        act = letters[-1] if letters[-1] != "I" else ""
        to = ""
        if act in ("K", "R"):
            to, opening, count = ("s", False, count) if opening else ("ua"[count % 2], False, count + 1)
        if new or to:
            yield at, new, act, to


# --- tables


def key_of(conv_id: Column) -> Column:
    return F.coalesce(F.concat(F.lit("+"), conv_id.cast("string")), F.lit("-"))


def given(turns: DataFrame) -> DataFrame:
    """``key``, ``turn``, ``role``, ``text``, ``digest`` of ``turns``; a null role or text is one space."""
    space = F.lit(" ")
    rows = turns.select(
        key_of(F.col("conv_id")).alias("key"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"),
    )
    return rows.withColumn("digest", F.md5("text"))


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` with faults put in by crc32 of ``conv_id:turn``, modulo 20; nulls are one space.

    0 drops the row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats the row, 4 makes the role user.
    """
    space = F.lit(" ")
    word = lambda c: F.coalesce(F.col(c).cast("string"), space)
    code = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    text = F.when(F.col("_code") == 1, "").when(F.col("_code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = turns.select("conv_id", "turn", word("role").alias("role"), word("text").alias("text"), code.alias("_code")).filter("_code != 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("_code") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("_code") == 3, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")


def diagnosed(turns: DataFrame) -> DataFrame:
    """Every row of ``turns`` without its text: ``key``, ``pos`` (from 0), ``turn``, ``role``, ``digest``, ``fault``, ``letter``. Stored.

    Rows stand by turn (nulls first), then role and digest of the text, equal ones in any order. ``fault``
    is the first of blank, duplicate and truncated, or null; a row is a duplicate if an earlier one has its
    role and text. Texts are compared by their digests, and don't leave the scan.
    """
    last = F.rtrim(F.col("text"), F.lit(BLANKS))
    rows = given(turns).select(
        "key", "turn", "role", "digest", (last == "").alias("blank"), F.right(last, F.lit(1)).isin(".", "!", "?").alias("whole"),
        F.rand(11).alias("tie"),
    )
    order = ["turn", "role", "digest", "tie"]
    rows = numbered_by_part(in_ranges(rows, ["key", *order], "turns"), ["key"], "part", order, "pos")
    rows = stage(rows.select("key", F.col("pos").cast("bigint").alias("pos"), "turn", "role", "digest", "blank", "whole"), "turns-numbered")
    first = rows.groupBy("key", "role", "digest").agg(F.min("pos").alias("pos")).select("key", "pos", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(~F.col("whole"), "truncated")
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    letter = F.when(F.col("fault").isin("blank", "duplicate"), F.translate(kind, KEPT, LOST)).when(F.col("fault").isNotNull(), F.upper(kind)).otherwise(kind)
    found = rows.join(first, ["key", "pos"], "left").withColumn("fault", fault).withColumn("letter", letter)
    return stage(found.select("key", "pos", "turn", "role", "digest", "fault", "letter"), "turns-diagnosed")


def _group(key: str, block: int, first: str, last: str, illegal: int, table: dict) -> dict:
    best = [{"low": a, "high": b, "cost": c, "audit": t, "opened": o} for (a, b), (c, t, o) in table.items()]
    return {"key": key, "block": block, "first": first, "last": last, "illegal": illegal, "best": best}


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


_TABLE = pa.list_(pa.struct([
    ("low", pa.int32()), ("high", pa.int32()), ("cost", pa.int64()), ("audit", pa.string()), ("opened", pa.bool_()),
]))
_GROUP = [("key", pa.string()), ("block", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("illegal", pa.int64()), ("best", _TABLE)]


def repairs(rows: DataFrame) -> DataFrame:
    """``key``, ``illegal``, ``cost``, ``audit``, ``opened`` of each conversation of diagnosed ``rows``. Stored."""
    small_batches(rows.sparkSession)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict] = {}
        for batch in batches:
            found = []
            for key, block, letters in zip(*(batch.column(c).to_pylist() for c in ("key", "block", "letters"))):
                if len(known) > REMEMBERED:
                    known.clear()
                parts = [letters[i: i + PIECE] for i in range(0, len(letters), PIECE)]
                for part in parts:
                    if part not in known:
                        known[part] = piece(part)
                initials = letters.lower().translate(str.maketrans(LOST, KEPT))
                found.append(_group(key, block, initials[0], initials[-1], illegal_in(initials), joined([known[p] for p in parts])))
            yield _batch(found, pa.schema(_GROUP))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for key, block, parts in zip(*(batch.column(c).to_pylist() for c in ("key", "block", "parts"))):
                parts.sort(key=lambda p: p["block"])
                tables = [{(b["low"], b["high"]): (b["cost"], b["audit"], b["opened"]) for b in p["best"]} for p in parts]
                seams = sum(illegal_in(x["last"] + y["first"]) for x, y in zip(parts, parts[1:]))
                found.append(_group(
                    key, block, parts[0]["first"], parts[-1]["last"], sum(p["illegal"] for p in parts) + seams, joined(tables)
                ))
            yield _batch(found, pa.schema(_GROUP))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.string()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("opened", pa.bool_())])
        for batch in batches:
            found = []
            for key, illegal, best in zip(*(batch.column(c).to_pylist() for c in ("key", "illegal", "best"))):
                cost, audit, opened = finished({(b["low"], b["high"]): (b["cost"], b["audit"], b["opened"]) for b in best})
                found.append({"key": key, "illegal": illegal, "cost": cost, "audit": audit, "opened": opened})
            yield _batch(found, schema)

    block = F.floor(F.col("pos") / SPAN).cast("bigint").alias("block")
    letters = F.array_sort(F.collect_list(F.struct("pos", "letter")))
    sent = rows.groupBy("key", block).agg(F.array_join(F.transform(letters, lambda x: x["letter"]), "").alias("letters"))
    groups = stage(sent.select("key", "block", "letters").mapInArrow(align, GROUP), "turn-groups")
    while (groups.agg(F.max("block")).first()[0] or 0) > 0:
        up = groups.groupBy("key", F.floor(F.col("block") / FAN).cast("bigint").alias("up"))
        parts = up.agg(F.collect_list(F.struct("block", "first", "last", "illegal", "best")).alias("parts"))
        groups = stage(parts.withColumnRenamed("up", "block").select("key", "block", "parts").mapInArrow(join, GROUP), "turn-groups")
    done = groups.select("key", "illegal", "best").mapInArrow(finish, "key string, illegal bigint, cost bigint, audit string, opened boolean")
    return stage(done, "turn-repairs")


def _lines(turns: DataFrame, rows: DataFrame, found: DataFrame) -> DataFrame:
    """Texts and edits of all conversations, sorted so that a turn's text comes before what is done with it.

    The one shuffle of texts. A conversation is in one partition, as its digest needs it, and is read from there in batches.
    """

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, audit, opened in zip(*(batch.column(c).to_pylist() for c in ("key", "audit", "opened"))):
                columns = list(zip(*edits(audit, opened)))
                if columns:
                    arrays = [pa.array([key] * len(columns[0])), pa.array(columns[0], pa.int64()), *[pa.array(c, pa.string()) for c in columns[1:]]]
                    yield pa.RecordBatch.from_arrays(arrays, names=["key", "pos", "added", "act", "to"])

    done = found.select("key", "audit", "opened").mapInArrow(expand, "key string, pos bigint, added string, act string, to string")
    placed = done.join(rows.select("key", "pos", "turn", "role", "digest"), ["key", "pos"], "left")
    empty = F.lit("")
    acts = placed.select(
        "key", (F.col("act") == "").alias("tail"), "turn", "role", "digest", F.lit(1).alias("kind"), "pos", empty.alias("text"), "added", "act", "to"
    )
    texts = given(turns).select(
        "key", F.lit(False).alias("tail"), "turn", "role", "digest", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("pos"),
        "text", empty.alias("added"), empty.alias("act"), empty.alias("to"),
    )
    return texts.union(acts).repartition("key").sortWithinPartitions("key", "tail", "turn", "role", "digest", "kind", "pos")


def _repaired(batch: pa.RecordBatch, state: dict) -> Iterator[tuple[str, int | None, str | None, str | None]]:
    """Key, turn, role and text of each line of sorted texts and edits; once for each key without a role, when it begins."""
    for key, turn, role, kind, text, added, act, to in zip(*(
        batch.column(c).to_pylist() for c in ("key", "turn", "role", "kind", "text", "added", "act", "to")
    )):
        if key != state.get("key"):
            state["key"] = key
            yield key, None, None, None
        if kind == 0:
            state["text"] = text
            continue
        for initial in added:
            yield key, turn, NAMES[initial], ""
        if to:
            yield key, turn, role if act == "K" else NAMES[to], state["text"]


def repaired(turns: DataFrame) -> DataFrame:
    """``conv_id`` (text), ``line`` (from 0), ``turn``, ``role``, ``text`` of the repaired conversations of ``turns``.

    Odd rows are treated as in ``digests``; an inserted line has the turn of the row it precedes and an empty text.
    """
    rows = diagnosed(turns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, line = {}, 0
        schema = pa.schema([("conv_id", pa.string()), ("line", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
        for batch in batches:
            found = []
            for key, turn, role, text in _repaired(batch, state):
                if role is None:
                    line = 0
                    continue
                found.append({"conv_id": key[1:] if key != "-" else None, "line": line, "turn": turn, "role": role, "text": text})
                line += 1
            yield _batch(found, schema)

    return _lines(turns, rows, repairs(rows)).mapInArrow(run, "conv_id string, line bigint, turn bigint, role string, text string")


def digests(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """``conv_id`` of every conversation of ``conversations`` and what repairing its rows in ``turns`` takes.

    ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``, ``repaired_sha256``. A null conv_id is
    a conversation like others; null turns stand first and make no gaps; a null role or text is one space.
    Texts of any length, repeated rows and rows of one turn are fine. A conversation without rows has
    zeros, an empty audit and the digest of nothing; an empty table gives an empty one; other columns are ignored.
    """
    rows = diagnosed(turns)
    found = repairs(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, now, done = {}, None, []
        schema = pa.schema([("key", pa.string()), ("repaired_sha256", pa.string())])
        for batch in batches:
            for key, _, role, text in _repaired(batch, state):
                if role is None:
                    if now:
                        done.append({"key": now[0], "repaired_sha256": now[1].hexdigest()})
                    now = (key, hashlib.sha256(), [])
                    continue
                now[1].update(("\n" * len(now[2]) + f"{role}:{text}").encode())
                now[2][:] = [True]
            yield _batch(done, schema)
            done = []
        if now:
            yield _batch([{"key": now[0], "repaired_sha256": now[1].hexdigest()}], schema)

    hashed = _lines(turns, rows, found).mapInArrow(run, "key string, repaired_sha256 string")
    faults = rows.groupBy("key").agg(*[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
    wide = lambda c: c.cast("decimal(38,0)")
    turns_of = rows.filter("turn is not null").select("key", "turn").distinct().groupBy("key").agg(
        (wide(F.max("turn")) - wide(F.min("turn")) + 1 - wide(F.count("*"))).try_cast("bigint").alias("gaps")
    )
    whole = conversations.select("conv_id", key_of(F.col("conv_id")).alias("key")).distinct()
    for part in (faults, turns_of, found.drop("opened"), hashed):
        whole = whole.join(part, "key", "left")
    number = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return whole.select(
        "conv_id", *[number(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
