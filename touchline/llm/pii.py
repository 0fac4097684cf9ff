"""Personal data: fixed patterns, and terms that give it away.

Addresses, numbers and phones are found by patterns. What they are replaced by hides them, but
words next to them may still tell which they were. How strongly is estimated from the corpus:
the pointwise mutual information of a term and a protected entity, against the entity's own
information content. Entities are values, and the parts of values that recur where whole values don't: a
mail's name and domain, a network's first octets, the leading digits of numbers. A term that carries nearly all of it is removed from the texts that hold
the value, one that carries most of it is generalised.

Everything is DataFrame functions; there is no Python in the tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from touchline.llm.common import row_key
from touchline.session import stage

KINDS = ("email", "ip", "card", "phone")
#: Possessive forms of the patterns. A run of name characters is tried from its start only, or
#: from where the last match has ended, which is where leftmost matches begin.
PATTERN = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What any text with a match has: cheap to test.
HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9][\x20-]?[0-9]", "phone": "+"}
PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"
#: Shares of a value's information content from which a term is generalised or removed.
GENERALISE, REMOVE = 0.9, 0.98
#: How many leading digits of a card and a phone, and octets of an address, are entities of their own.
LEADING = {"card": (6,), "phone": (4, 6)}
OCTETS = (2, 3)
#: Bits of the bitmap of repeated texts: 1 MB, whatever the input. More repeated texts only let more texts through.
BITS = 1 << 23
#: A term must meet the value in so many different texts, and more often than chance would have any
#: of the terms tried with the value do it, but for this probability.
MIN_TEXTS, CHANCE = 2, 0.05


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = digits.substr(F.length(digits) - i + 1, F.lit(1)).cast("int")
        doubled = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    """The conditions that a match of the pattern has to meet."""
    if kind == "ip":
        return value.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    if kind == "card":
        return F.length(_digits(value)).between(16, 19) & _luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def spans(kind: str, text: Column) -> Column:
    """Matches of one kind with their places in code points, from the left.

    The pieces between matches and the matches themselves come from the same pattern, so a
    match starts where the pieces and matches before it end.
    """
    matches, pieces = F.regexp_extract_all(text, F.lit(PATTERN[kind]), F.lit(0)), F.split(text, PATTERN[kind], -1)
    none = F.array().cast(SPAN)
    both = F.arrays_zip(F.slice(pieces, 1, F.size(matches)).alias("piece"), matches.alias("match"))
    start = F.struct(F.lit(0).alias("at"), none.alias("found"))

    def step(state: Column, pair: Column) -> Column:
        low = state["at"] + F.length(pair["piece"])
        value = pair["match"]
        span = F.struct(F.lit(kind).alias("kind"), low.alias("start"), (low + F.length(value)).alias("end"), value.alias("value"))
        found = F.when(_holds(kind, value), F.concat(state["found"], F.array(span))).otherwise(state["found"])
        return F.struct((low + F.length(value)).alias("at"), found.alias("found"))

    hint = F.contains(text, F.lit(HINT[kind])) if kind in ("email", "phone") else text.rlike(HINT[kind])
    return F.when(hint, F.aggregate(both, start, step, lambda s: s["found"])).otherwise(none)


def listed(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def found_in(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``key``, the spans of each kind and all of them as ``base``; ``text`` of rows that have any. Stored."""
    text = F.coalesce("text", F.lit(""))
    each = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), row_key(docs).alias("key"), text.alias("text"),
        *[spans(kind, text).alias(kind) for kind in KINDS],
    ).withColumn("base", F.concat(*KINDS))
    return stage(each.withColumn("text", F.when(F.size("base") > 0, F.col("text"))), "pii-base")


def words(text: Column) -> Column:
    """Terms of a text: words of letters, without case."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+", -1), lambda w: w != "")


def _log_chance(n: Column, both: Column, entity: Column, term: Column) -> Column:
    """Logarithm of the chance (an upper bound) that independent value and term meet in so many of ``n`` texts; 0 if not more than expected.

    The likelihood ratio of the two-by-two table against its expected counts, and the normal tail
    of its root, which is at most exp(-g / 2) / sqrt(2 pi g).
    """
    def part(seen: Column, row: Column, column: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen * n / (row * column))).otherwise(0.0)

    g = 2 * (
        part(both, entity, term) + part(entity - both, entity, n - term)
        + part(term - both, n - entity, term) + part(n - entity - term + both, n - entity, n - term)
    )
    return F.when((both * n > entity * term) & (g > 0), F.least(-g / 2 - F.log(g * (2 * math.pi)) / 2, F.lit(0.0))).otherwise(0.0)


def entities(base: Column) -> Column:
    """What the spans of a text reveal, as ``kind:value``: the values, and parts of them under kinds of their own."""
    named = lambda kind, value: F.concat(F.lit(f"{kind}:"), value)

    def of(span: Column) -> Column:
        kind, value = span["kind"], F.lower(span["value"])
        digits, dot = _digits(value), F.split(value, r"\.")
        email = [named("name", F.substring_index(value, "@", 1)), named("domain", F.substring_index(value, "@", -1))]
        network = [named(f"net{n}", F.array_join(F.slice(dot, 1, n), ".")) for n in OCTETS]
        leading = {k: [named(f"{k}{n}", F.substring(digits, 1, n)) for n in sizes] for k, sizes in LEADING.items()}
        none = F.array().cast("array<string>")
        parts = F.when(kind == "email", F.array(*email)).when(kind == "ip", F.array(*network))
        for k, found in leading.items():
            parts = parts.when(kind == k, F.array(*found))
        return F.concat(F.array(F.concat_ws(":", kind, value)), parts.otherwise(none))

    return F.array_distinct(F.flatten(F.transform(base, of)))


def _place(text_id: Column) -> Column:
    return F.pmod(F.xxhash64(text_id), F.lit(BITS))


def once_each(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """``text`` of every distinct text of ``docs``. ``repeated``: the ``text_id`` of those that occur more than once.

    A bitmap of a fixed size tells texts that are not repeated from those that may be. The former, nearly all,
    stay where they are read; only the latter meet in a shuffle, reduced before it.
    """
    place = _place(F.col("text_id"))
    bits = repeated.select((F.floor(place / 32768)).cast("bigint").alias("_bucket"), (place % 32768).alias("_bit"))
    bitmap = stage(bits.groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_map")), "pii-bitmap")
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("text_id", F.md5("text"))
    at = _place(F.col("text_id"))
    texts = texts.withColumn("_bucket", F.floor(at / 32768).cast("bigint")).withColumn("_bit", (at % 32768).cast("int"))
    # BITS / 8 bytes at most.
    texts = texts.join(F.broadcast(bitmap), "_bucket", "left")
    byte = F.ascii(F.decode(F.substring("_map", (F.col("_bit") / 8).cast("int") + 1, F.lit(1)), "ISO-8859-1"))
    may = F.coalesce(F.getbit(byte.cast("int"), (F.col("_bit") % 8).cast("int")) == 1, F.lit(False))
    together = texts.filter(may).groupBy("text_id").agg(F.first("text").alias("text"))
    return texts.filter(~may).select("text").union(together.select("text"))


def disclosing_terms(base: DataFrame, docs: DataFrame) -> DataFrame:
    """``entity``, ``term``, ``share`` of terms that give a protected entity away. Stored.

    All counts are of distinct texts: a repeated text is one piece of evidence, for the corpus, a pair, an entity and a term
    alike, so copies neither make a term disclosing nor hide one, and a term found only beside the entity has share 1.
    Entities in a single text are left out: with one text there is nothing to estimate from. Others
    are all tried, however frequent; that a pair is no accident is tested against what chance
    gives among the terms tried with the entity. An entity in all texts tells nothing.

    A term whose share can reach GENERALISE with an entity is in at most n^0.1 * n_entity^0.9 texts; that bound, with
    its frequency among texts that hold entities, is tried before terms and entities of a text are paired.
    Terms of the corpus are counted before the shuffle; of texts only those that may be repeated are shuffled.
    """
    plain = F.regexp_replace("text", PATTERN["email"], " ")  # letters of addresses are not terms of the text
    holding = base.filter("text is not null").select(F.md5("text").alias("text_id"), "text", "base").dropDuplicates(["text_id"])
    # A short number for each text, fixed by being written.
    holding = stage(holding.select(
        F.monotonically_increasing_id().alias("number"), entities(F.col("base")).alias("entities"), F.array_distinct(words(plain)).alias("terms"),
    ), "pii-texts")
    pairs = holding.select("number", F.explode("entities").alias("entity"))
    known = stage(pairs.groupBy("entity").agg(F.count("*").alias("n_entity")).filter(F.col("n_entity") >= MIN_TEXTS), "pii-known")
    pairs = stage(pairs.join(known, "entity"), "pii-entities")
    copies = stage(docs.select(F.md5(F.coalesce("text", F.lit(""))).alias("text_id")).groupBy("text_id").count(), "pii-copies")
    n = float(copies.count())
    terms = holding.select("number", F.explode("terms").alias("term"))
    here = terms.groupBy("term").agg(F.count("*").alias("n_here")).filter(F.col("n_here") >= MIN_TEXTS)
    most = F.pow(F.lit(n), F.lit(1 - GENERALISE)) * F.pow(F.col("n_entity").cast("double"), F.lit(GENERALISE)) * (1 + 1e-9)
    met = terms.join(stage(here, "pii-here"), "term").join(pairs, "number").filter(F.col("n_here") <= most)
    met = met.groupBy("entity", "term").agg(F.count("*").alias("n_both"), F.first("n_entity").alias("n_entity"))
    met = stage(met.filter(F.col("n_both") >= MIN_TEXTS), "pii-met")
    repeated = copies.filter("count > 1").select("text_id")
    told = F.explode(F.array_distinct(words(F.col("text")))).alias("term")
    frequency = once_each(docs, repeated).select(told).groupBy("term").agg(F.count("*").alias("n_term"))
    tried = stage(met.groupBy("entity").agg(F.count("*").alias("tried")), "pii-tried")
    n_both, n_term, n_entity = (F.col(c).cast("double") for c in ("n_both", "n_term", "n_entity"))
    share = F.log2(n * n_both / (n_term * n_entity)) / F.nullif(F.log2(n / n_entity), F.lit(0.0))
    told = met.join(frequency, "term").join(tried, "entity").withColumn("share", share)
    told = told.filter(_log_chance(F.lit(n), n_both, n_entity, n_term) + F.log("tried") <= math.log(CHANCE))
    told = told.filter(F.col("share") >= GENERALISE)
    return stage(told.select("entity", "term", "share"), "pii-told")


def term_spans(base: DataFrame, docs: DataFrame) -> DataFrame:
    """``key`` and ``terms``, spans of disclosing terms (kind ``term`` or ``term_removed``), of rows that have any."""
    told = disclosing_terms(base, docs)
    # Only the entities and the texts that a disclosing term may concern go on; entities and words meet as narrow rows.
    held = base.filter("text is not null").select("key", F.explode(entities(F.col("base"))).alias("entity"))
    own = stage(held.join(told.select("entity").distinct(), "entity", "left_semi").distinct(), "pii-own")
    rows = base.select("key", "text", "base").join(own.select("key").distinct(), "key", "left_semi")
    rows = stage(rows.dropDuplicates(["key"]).withColumn("number", F.monotonically_increasing_id()), "pii-concerned")
    said = rows.select("key", F.explode(F.array_distinct(words(F.col("text")))).alias("term"))
    said = said.join(told.select("term").distinct(), "term", "left_semi")
    wanted = said.join(own, "key").join(told, ["entity", "term"]).groupBy("key", "term").agg(F.max("share").alias("share"))
    wanted = stage(wanted, "pii-wanted")
    pattern = r"\p{L}+"
    texts = rows.join(wanted.select("key").distinct(), "key", "left_semi")
    pieces, matches = F.split("text", pattern, -1), F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    both = F.zip_with(F.slice(pieces, 1, F.size(matches)), matches, lambda p, m: F.struct(F.length(p).alias("gap"), m.alias("word")))
    each = texts.select("number", F.posexplode(both).alias("pos", "pair")).select("number", "pos", "pair.*")
    # A window over the words of one text; texts are read whole anyway.
    line = Window.partitionBy("number").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.withColumn("end", F.sum(F.col("gap") + F.length("word")).over(line).cast("int"))
    placed = placed.withColumn("start", F.col("end") - F.length("word")).withColumn("term", F.lower("word"))
    named = stage(wanted.join(rows.select("key", "number"), "key").select("key", "number", "term", "share"), "pii-named")
    hits = placed.join(named, ["number", "term"]).join(rows.select("number", "base"), "number")
    clear = ~F.exists("base", lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start")))
    hits = hits.filter(clear)
    kind = F.when(F.col("share") >= REMOVE, "term_removed").otherwise("term")
    span = F.struct("start", "end", kind.alias("kind"), F.col("word").alias("value"))
    by_place = F.transform(F.sort_array(F.collect_list(span)), lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
    return hits.groupBy("key").agg(by_place.alias("terms"))


def personal_data(docs: DataFrame) -> DataFrame:
    """All spans of every row of ``docs``: ``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base_sha256``, ``spans``, ``n_terms``.

    Places are code points, ends exclusive. A null text is empty and has no spans. Repeated rows
    and null ids give a row each; an empty table gives an empty one; other columns are ignored.
    """
    base = found_in(docs)
    terms = term_spans(base, docs).withColumnRenamed("key", "_key")
    joined = base.drop("text").join(terms, F.col("key") == F.col("_key"), "left")
    more = F.coalesce("terms", F.array().cast(SPAN))
    return joined.select(
        "doc_id", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listed(F.concat("base", more)).alias("spans"), F.size(more).cast("bigint").alias("n_terms"),
    )


def _rebuilt(text: Column, found: Column) -> Column:
    """``text`` with spans (by place) replaced by their kind in brackets; removed terms by nothing."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, span: Column) -> Column:
        name = F.when(span["kind"] == "term_removed", "").otherwise(F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]")))
        before = text.substr(state["at"] + 1, span["start"] - state["at"])
        parts = F.when(span["start"] >= state["at"], F.concat(state["parts"], F.array(before, name))).otherwise(state["parts"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), parts.alias("parts"))

    rest = lambda s: F.concat(F.array_join(s["parts"], ""), text.substr(s["at"] + 1, F.length(text)))
    return F.aggregate(found, start, step, rest)


def sanitised(docs: DataFrame) -> DataFrame:
    """``docs`` with all personal data replaced: ``[EMAIL]``, ``[IP]``, ``[CARD]``, ``[PHONE]``, ``[TERM]`` or nothing.

    Rows keep their number and columns; ``n_chars``, where there is one, follows a changed text.
    Rows without personal data never leave their place: only the others are joined with spans.
    """
    base = found_in(docs)
    key = row_key(docs)
    terms = term_spans(base, docs)
    held = base.filter("text is not null").select("key", "base").dropDuplicates(["key"])
    found = held.join(terms, "key", "left").select(
        F.col("key").alias("_key"),
        F.array_sort(F.concat("base", F.coalesce("terms", F.array().cast(SPAN))), lambda a, b: a["start"] - b["start"]).alias("_spans"),
    )
    found = stage(found, "pii-spans")
    hold = F.lit(False)
    for kind in KINDS:
        hold = hold | (F.size(spans(kind, F.coalesce("text", F.lit("")))) > 0)
    names = docs.columns
    text = _rebuilt(F.col("text"), F.col("_spans"))
    changed = docs.filter(hold).withColumn("_key", key).join(found, "_key").withColumn("text", text)
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.length("text").cast(kind))
    return docs.filter(~hold).unionByName(changed.select(*[F.col(f"`{n}`") for n in names]))
