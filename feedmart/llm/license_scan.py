"""License scan: ordered signature rules behind a keyword prefilter, on built-in functions only.

A text becomes lower-case words with one space between them. Texts that hold none of a few short
literals are done. In the others the rules whose keyword is there are matched; each match is an
interval. A match that lies inside another one is suppressed, and of matches over the same words the
rule of higher priority stays. So a full title wins over a short name within it.

Everything happens within the row: no shuffle, and a row's cost follows its own text. Defined results:
a null or empty text has no words, no labels and a score of 0; repeated rows are scanned alike; an
empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmart.llm.common import lower_ascii
from feedmart.llm.license_rules import TRIGGERS, Rule, rules

# Phrases that are looked up as they are, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

BASE_SCORE = 0.8
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_HIT = "array<struct<start:int,back:int,priority:int,stop:int,label:string,score:double>>"


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def plain_words(text: Column) -> Column:
    """The words with one space before, between and after them; one space alone without words."""
    spaced = F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN_WORDS, " ")
    return F.concat(F.lit(" "), F.trim(spaced), F.lit(" "))


def _holds_any(words: Column, literals: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(words, F.lit(t)) for t in literals))


def hits(words: Column, chosen: list[Rule]) -> Column:
    """All matches of the rules whose keyword the text holds."""
    table = F.array(
        *(
            F.struct(
                F.lit(r.priority).alias("priority"),
                F.lit(r.label).alias("label"),
                F.lit(f"(?<= )(?:{r.regex})(?= )").alias("regex"),
                F.lit(r.keyword).alias("keyword"),
                F.lit(r.score).alias("score"),
            )
            for r in chosen
        )
    )

    def matches(rule: Column) -> Column:
        pieces = F.transform(F.split(words, rule["regex"], -1), F.length)
        found = F.transform(F.regexp_extract_all(words, rule["regex"], F.lit(0)), F.length)

        def add(state: Column, pair: Column) -> Column:
            start = state["at"] + pair["before"]
            stop = start + pair["long"]
            hit = F.struct(
                start.alias("start"), (-stop).alias("back"), rule["priority"].alias("priority"),
                stop.alias("stop"), rule["label"].alias("label"), rule["score"].alias("score"),
            )
            return F.struct(stop.alias("at"), F.concat(state["hits"], F.array(hit)).cast(_HIT).alias("hits"))

        none = F.struct(F.lit(0).alias("at"), F.array().cast(_HIT).alias("hits"))
        pairs = F.zip_with(F.slice(pieces, 1, F.size(found)), found, lambda a, b: F.struct(a.alias("before"), b.alias("long")))
        return F.aggregate(pairs, none, add, lambda s: s["hits"])

    return F.flatten(F.transform(F.filter(table, lambda r: F.contains(words, r["keyword"])), matches))


def resolved(found: Column) -> Column:
    """struct(labels, score, n_kept) of the matches that lie inside no other match."""

    def add(state: Column, hit: Column) -> Column:
        stays = hit["stop"] > state["reach"]
        return F.when(
            stays,
            F.struct(
                hit["stop"].alias("reach"),
                F.array_union(state["labels"], F.array(hit["label"])).alias("labels"),
                F.greatest(state["score"], hit["score"]).alias("score"),
                (state["n_kept"] + F.lit(1)).cast("long").alias("n_kept"),
            ),
        ).otherwise(state)

    none = F.struct(
        F.lit(0).alias("reach"), F.array().cast("array<string>").alias("labels"),
        F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("n_kept"),
    )
    # by start, the longer one first, then by priority: what contains a match comes before it
    return F.aggregate(F.array_sort(found), none, add)


def phrase_places(words: Column, n_words: Column) -> Column:
    """struct(n_base, first_word, last_word, labels) of the phrases; they cannot overlap each other."""
    regex = f"(?<= )(?:{'|'.join(PHRASES)})(?= )"
    pieces, found = F.split(words, regex, -1), F.regexp_extract_all(words, F.lit(regex), F.lit(0))
    last_words = _spaces(F.element_at(found, -1)) + 1
    labels = F.create_map(*(F.lit(x) for pair in PHRASES.items() for x in pair))
    place = F.struct(
        F.size(found).cast("long").alias("n_base"),
        (_spaces(F.element_at(pieces, 1)) - 1).alias("first_word"),
        (n_words - last_words - (_spaces(F.element_at(pieces, -1)) - 1)).alias("last_word"),
        F.array_distinct(F.transform(found, lambda p: F.element_at(labels, p))).alias("labels"),
    )
    return F.when(_holds_any(words, list(PHRASES)) & F.regexp_like(words, F.lit(regex)), place)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chosen: list[Rule] | None = None) -> DataFrame:
    """Per row: words, phrase places, labels (of phrases and of rules) and a score of 0 to 1."""
    chosen = rules() if chosen is None else chosen
    words = docs.select(F.col(id_col), plain_words(F.col(text_col)).alias("_words"))
    counted = words.withColumn("n_words", F.when(F.col("_words") == "  ", F.lit(0).cast("long")).otherwise(_spaces(F.col("_words")) - 1))
    looked = counted.select(
        id_col,
        "n_words",
        phrase_places(F.col("_words"), F.col("n_words")).alias("_base"),
        F.when(_holds_any(F.col("_words"), TRIGGERS), resolved(hits(F.col("_words"), chosen))).alias("_rules"),
    )
    none = F.array().cast("array<string>")
    base, more = F.coalesce(F.col("_base.labels"), none), F.coalesce(F.col("_rules.labels"), none)
    base_score = F.when(F.col("_base").isNotNull(), F.lit(BASE_SCORE)).otherwise(F.lit(0.0))
    return looked.select(
        id_col,
        "n_words",
        F.coalesce(F.col("_base.n_base"), F.lit(0).cast("long")).alias("n_base"),
        F.col("_base.first_word").alias("first_word"),
        F.col("_base.last_word").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"),
        F.greatest(base_score, F.coalesce(F.col("_rules.score"), F.lit(0.0))).alias("score"),
        F.coalesce(F.col("_rules.n_kept"), F.lit(0).cast("long")).alias("n_matches"),
    )
