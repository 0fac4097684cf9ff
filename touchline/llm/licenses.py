"""Licence scans by ordered signature rules.

Hundreds of patterns in tiers (``license_rules.py``) read the words of a text. A text is tried only
with the rules whose keyword it contains. Detections overlap, so they are resolved by priority and
containment: one is suppressed if the words of another contain its words and that other is of
an earlier tier, or of the same tier and longer, or of the same length and an earlier rule.

Everything is DataFrame functions; there is no Python in the tasks. Only places of detections are
shuffled, never texts.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import row_key
from touchline.llm.license_rules import TIERS, rules
from touchline.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DETECTION = "array<struct<rule:int,label:string,tier:string,start:int,end:int>>"


def plain(text: Column) -> Column:
    """The words of a text, A-Z in lower case, one space apart."""
    return F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAP, " "))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _families() -> Column:
    """The rules as an array of (keyword, rules that need it); a constant."""
    found: dict[str, list[Column]] = defaultdict(list)
    for tier, order, _, keyword, pattern in rules():
        whole = rf"(?<![^ ])(?:{pattern})(?![^ ])"
        found[keyword].append(F.struct(F.lit(order).alias("rule"), F.lit(tier).alias("tier"), F.lit(whole).alias("pattern")))
    return F.array(*[F.struct(F.lit(k).alias("keyword"), F.array(*r).alias("rules")) for k, r in found.items()])


def _tried(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``key``, ``n_words`` and ``each`` (rule, tier, and for each match the spaces before and in it) of every row. Stored.

    The one pass over texts. A text's pieces between matches and the matches come from the same pattern, so
    a match starts where the words before it end.
    """
    words = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), row_key(docs).alias("key"), plain(F.col("text")).alias("words")
    )
    tried = F.flatten(F.transform(F.filter(_families(), lambda f: F.contains("words", f["keyword"])), lambda f: f["rules"]))

    def parts(pattern: Column) -> Column:
        matches, pieces = F.regexp_extract_all("words", pattern, F.lit(0)), F.split("words", pattern, -1)
        return F.zip_with(F.slice(pieces, 1, F.size(matches)), matches, lambda p, m: F.struct(_spaces(p).alias("gap"), _spaces(m).alias("inner")))

    each = F.transform(tried, lambda r: F.struct(r["rule"].alias("rule"), r["tier"].alias("tier"), parts(r["pattern"]).alias("parts")))
    n_words = F.when(F.col("words") == "", 0).otherwise(_spaces(F.col("words")) + 1).cast("bigint")
    return stage(words.select("doc_id", "key", n_words.alias("n_words"), F.filter(each, lambda x: F.size(x["parts"]) > 0).alias("each")), "licence-words")


def detections(docs: DataFrame) -> DataFrame:
    """``key``, ``rule``, ``tier``, ``start``, ``end`` (words, end exclusive), ``kept`` of every match of every rule in ``docs``. Stored.

    Rows with one id and text are one.
    """
    return _placed(_tried(docs))


def _placed(rows: DataFrame) -> DataFrame:
    each = rows.select("key", F.explode("each").alias("r"))
    hits = each.select("key", F.col("r")["rule"].alias("rule"), F.col("r")["tier"].alias("tier"), F.posexplode(F.col("r")["parts"]).alias("pos", "part"))
    hits = hits.select("key", "rule", "tier", "pos", "part.*").repartition("key").dropDuplicates(["key", "rule", "pos"])
    # Windows over the detections of one text, which is read as a whole anyway.
    line = Window.partitionBy("key", "rule").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum(F.col("gap") + F.col("inner")).over(line).cast("int")
    hits = hits.withColumn("end", upto + 1).withColumn("start", F.col("end") - F.col("inner") - 1)
    before = Window.partitionBy("key").orderBy("start", F.desc("end"), "tier", "rule").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.lit(0)
    for tier in range(len(TIERS)):
        # How far detections of this tier or an earlier one reach that begin at the same word or earlier.
        far = F.coalesce(F.max(F.when(F.col("tier") <= tier, F.col("end"))).over(before), F.lit(0))
        reach = F.when(F.col("tier") == tier, far).otherwise(reach)
    found = hits.withColumn("kept", reach < F.col("end")).select("key", "rule", "tier", "start", "end", "kept")
    return stage(found, "licence-detections")


def _labels() -> Column:
    return F.array(*[F.lit(label) for _, _, label, _, _ in rules()])


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``key``, ``n_words``, ``base``, ``found`` of every row of ``docs``.

    ``base``: all places of the fixed phrases; ``found``: the detections that are not suppressed, each with rule, label, tier, start and end.
    Null and empty texts have no words. Repeated rows and null ids give a row each; an empty table
    gives an empty one; other columns are ignored.
    """
    tiers = F.array(*[F.lit(t) for t in TIERS])
    one = F.struct(
        "rule", F.element_at(_labels(), F.col("rule") + 1).alias("label"), F.element_at(tiers, F.col("tier") + 1).alias("tier"), "start", "end"
    )
    rows = _tried(docs)
    told = _placed(rows).groupBy("key").agg(
        F.sort_array(F.collect_list(F.when(F.col("tier") == 0, one))).alias("base"),
        F.sort_array(F.collect_list(F.when(F.col("kept"), one))).alias("found"),
    )
    none = F.array().cast(DETECTION)
    return rows.drop("each").join(told, "key", "left").select(
        "doc_id", "key", "n_words", F.coalesce("base", none).alias("base"), F.coalesce("found", none).alias("found")
    )


def licenses(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score``, ``n_found`` of every row.

    Odd rows are treated as in ``scan``. ``labels`` are those of the base phrases and of all detections that
    are not suppressed; ``score`` is the sureness of the best of either.
    """
    names = lambda c: F.transform(c, lambda s: s["label"])
    listed = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    starts = F.transform("base", lambda s: s["start"])
    sure = F.create_map(*[F.lit(v) for pair in TIERS.items() for v in pair])
    score = F.array_max(F.transform(F.concat("base", "found"), lambda s: F.element_at(sure, s["tier"])))
    return scan(docs).select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).cast("bigint").alias("first_word"), F.array_max(starts).cast("bigint").alias("last_word"),
        listed(names("base")).alias("base_labels"), listed(F.concat(names("base"), names("found"))).alias("labels"),
        F.coalesce(score, F.lit(0.0)).alias("score"), F.size("found").cast("bigint").alias("n_found"),
    )
