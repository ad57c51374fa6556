"""Trigram containment between a value and the words of a dictionary.

The similarity of a value and a word is the share of the word's trigrams that
the value covers, in percent, counting every occurrence in the value. It can
exceed 100.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import let
from ..operators.joins import BROADCAST_BYTES, repartitioned, stage

#: A word counts as similar from this percentage on, before rounding.
THRESHOLD = 49

#: Values of one trigram that meet the dictionary in one place where both are shuffled.
PER_GRAM = 20_000

_PAD = "  "


def word_trigrams(word: str) -> list[str]:
    """Trigrams of one dictionary word, in order, duplicates kept."""
    padded = (_PAD + word + _PAD).upper()
    return [padded[i:i + 3] for i in range(len(padded) - 2)]


def padded(value: Column) -> Column:
    return F.upper(F.concat(F.lit(_PAD), value, F.lit(_PAD)))


def trigrams(value: Column) -> Column:
    """All trigrams of a value: padded by two blanks each side, upper case."""
    return let(padded(value), lambda p: F.transform(
        F.sequence(F.lit(1), F.length(p) - 2), lambda i: F.substring(p, i, F.lit(3))
    ))


def packed_trigrams(value: Column) -> Column:
    """The same trigrams as numbers: the code points of the three characters, 21 bits
    each. Equal numbers are equal trigrams, and arrays of numbers are compared faster."""
    codes = let(padded(value), lambda p: F.transform(
        F.sequence(F.lit(1), F.length(p)), lambda i: F.ascii(F.substring(p, i, F.lit(1))).cast("long")))
    return let(codes, lambda c: F.transform(
        F.sequence(F.lit(0), F.size(c) - 3),
        lambda i: F.shiftleft(F.get(c, i), 42) + F.shiftleft(F.get(c, i + 1), 21) + F.get(c, i + 2)))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _dictionary(words: list[str]) -> Column:
    """The words with their trigrams as one literal."""
    entries = []
    for i, word in enumerate(words):
        grams = word_trigrams(word)
        listed = ", ".join(_quoted(g) for g in dict.fromkeys(grams))
        entries.append(
            f"named_struct('word', {_quoted(word)}, 'order', {-i}, 'size', {len(grams)}, "
            f"'grams', array({listed}))"
        )
    return F.expr(f"array({', '.join(entries)})")


def known_trigrams(value: Column, words: list[str]) -> Column:
    """Occurrences in the value of any trigram of the dictionary, in order.

    The look-ahead reads the trigram that starts at each position, so the
    occurrences may overlap.
    """
    grams = dict.fromkeys(g for w in words for g in word_trigrams(w))
    pattern = "|".join(re.escape(g) for g in grams)
    return F.regexp_extract_all(padded(value), F.lit(f"(?=({pattern}))"), F.lit(1))


def _percent(score: Column) -> Column:
    return score["matches"] * F.lit(100.0) / score["size"]


def _scores(value: Column, words: list[str]) -> Column:
    """Hits as structs that sort by matches, then dictionary order."""
    def score(found: Column) -> Column:
        return F.transform(_dictionary(words), lambda w: F.struct(
            F.size(F.filter(found, lambda g: F.array_contains(w["grams"], g))).alias("matches"),
            w["order"].alias("order"), w["word"].alias("word"), w["size"].alias("size"),
        ))

    return F.filter(let(known_trigrams(value, words), score), lambda s: _percent(s) >= THRESHOLD)


def _similarity(score: Column) -> Column:
    return F.bround(_percent(score), 0).cast("int")


def similar_words(value: Column, words: list[str]) -> Column:
    """Hits ``array<struct<word, matches, similarity>>``, most matches first and
    dictionary order among equals."""
    return F.transform(
        F.sort_array(_scores(value, words), asc=False),
        lambda s: F.struct(
            s["word"].alias("word"), s["matches"].alias("matches"), _similarity(s).alias("similarity")
        ),
    )


def top_similarity(value: Column, words: list[str]) -> Column:
    """Similarity of the hit with the most matches, null where nothing hits."""
    return let(F.array_max(_scores(value, words)), _similarity)


def any_similar(value: Column, words: list[str]) -> Column:
    """Whether any word of the dictionary is similar to the value."""
    return F.size(_scores(value, words)) > 0


def mentions_key(value: Column, words: list[str], minimum: int = 70) -> Column:
    """Whether the value holds one of the words literally (case counts) or its
    best hit reaches ``minimum`` percent."""
    literal = value.rlike("|".join(re.escape(w) for w in words))
    return literal | F.coalesce(top_similarity(value, words) >= minimum, F.lit(False))


def similarity_join(values: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Pairs of similar ``values(value)`` and ``dictionary(word)``.

    Both sides are made distinct first. A pair at or above the threshold needs
    ``ceil(0.49 n)`` occurrences of the word's ``n`` trigrams; a value that
    repeats no trigram more than ``m`` times then shares at least
    ``need = ceil(0.49 n / m)`` distinct ones. So it must share one of the
    word's rarest ``distinct - need + 1`` trigrams, and the equi-join runs on
    those only: trigrams that most words have rarely take part. Trigrams are numbers
    here, and a value with fewer than ``need`` distinct ones is not compared.

    A pair that meets on several of them is kept where it meets first, so no
    pair has to be made distinct, and it is verified on both trigram arrays in
    the same task, which makes the result exact. The dictionary side is broadcast
    if its trigram table, whose size is computed first, is small enough; else
    both sides are shuffled by trigram, and the values of a trigram with more than
    ``PER_GRAM`` of them are dealt over salted keys, each with a copy of its words.
    """
    # Both inputs are used several times and may be costly to compute.
    known = stage(dictionary.select("word").where("word <> ''").distinct(), "words")
    distinct_values = stage(values.select("value").where("value <> ''").distinct(), "values")
    words = known.withColumn("grams", packed_trigrams(F.col("word"))).select(
        "word", F.size("grams").alias("n"), F.array_distinct("grams").alias("grams")
    )
    word_gram = words.select("word", "n", F.explode("grams").alias("gram"))
    frequency = word_gram.groupBy("gram").agg(F.count("*").alias("freq"))
    ordered = (
        word_gram.join(frequency, "gram")
        .groupBy("word", "n")
        .agg(F.sort_array(F.collect_list(F.struct("freq", "gram"))).alias("g"))
        .select("word", "n", F.transform("g", lambda g: g["gram"]).alias("word_grams"))
    )
    ranked = ordered.select("word", "n", "word_grams", F.posexplode("word_grams").alias("rank", "gram"))
    # Each value grows into many pairs, so small partitions are not merged here.
    shaped = repartitioned(distinct_values, "value").withColumn(
        "value_grams", packed_trigrams(F.col("value"))
    ).withColumn("distinct_grams", F.array_distinct("value_grams"))
    vals = shaped.select(
        "value", "value_grams", "distinct_grams",
        # No trigram can occur more often than this.
        (F.size("value_grams") - F.size("distinct_grams") + 1).alias("most"),
        F.explode("distinct_grams").alias("gram"),
    )
    width = F.length("word") + 2
    bytes_needed = known.agg(F.sum(width * (width * 20 + 100))).first()[0] or 0
    keys, side = ["gram"], F.broadcast(ranked)
    if bytes_needed > BROADCAST_BYTES:
        # One row for each trigram that needs more than one key.
        hot = stage(vals.groupBy("gram").agg(F.ceil(F.count("*") / PER_GRAM).cast("int").alias("salts")).where("salts > 1"), "hot")
        salts = F.coalesce("salts", F.lit(1))
        keys = ["gram", "salt"]
        side = ranked.join(F.broadcast(hot), "gram", "left").withColumn(
            "salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
        vals = vals.join(F.broadcast(hot), "gram", "left").withColumn(
            "salt", F.pmod(F.xxhash64("value"), salts).cast("int")).drop("salts")

    def pairs(some_values: DataFrame, most: Column, matches: Column) -> DataFrame:
        need = F.ceil(F.col("n") * THRESHOLD / F.lit(100.0) / most)
        meets_earlier = F.arrays_overlap(F.slice("word_grams", F.lit(1), F.col("rank")), "distinct_grams")
        # Cheap test first: a conjunction may be evaluated in any order, this is not.
        met = F.when((F.col("rank") <= F.size("word_grams") - need) & (F.size("distinct_grams") >= need), ~meets_earlier)
        percent = F.col("matches") * F.lit(100.0) / F.col("n")
        return (
            some_values.join(side, keys)
            .where(F.coalesce(met, F.lit(False)))
            .select("value", "word", "n", matches.alias("matches"))
            .where(percent >= THRESHOLD)
            .select("value", "word", "matches", F.bround(percent, 0).cast("int").alias("similarity"))
        )

    # Few values repeat a trigram; only for those must occurrences be counted.
    return pairs(
        vals.where("most = 1"), F.lit(1), F.size(F.array_intersect("distinct_grams", "word_grams"))
    ).unionByName(pairs(
        vals.where("most > 1"), F.col("most"),
        F.size(F.filter("value_grams", lambda g: F.array_contains(F.col("word_grams"), g))),
    ))
