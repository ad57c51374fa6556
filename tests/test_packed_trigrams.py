from pyspark.sql import functions as F

from pressloom.functions import similarity


def test_packed_trigrams_are_the_trigrams(values):
    """Also of characters beyond the first plane, and where upper case is longer."""
    rows = [("storm",), ("a",), ("\U0001f600é\U00010428",), ("straße ΐ",), ("\U0010ffff￿\u0001",), ("aaaa aaa",)]
    both = F.struct(similarity.trigrams(F.col("v")).alias("text"), similarity.packed_trigrams(F.col("v")).alias("number"))
    for text, number in values(rows, "v string", both):
        assert number == [sum(ord(c) << (42 - 21 * i) for i, c in enumerate(gram)) for gram in text]


def test_join_of_values_shorter_than_needed(spark):
    values = ["st", "storm", "storms", "s", "stormy weather", "tormst"]
    words = ["storm", "st", "thunderstorms", "weather"]
    got = similarity.similarity_join(
        spark.createDataFrame([(v,) for v in values], "value string"), spark.createDataFrame([(w,) for w in words], "word string"))
    want = set()
    for v in values:
        for w in words:
            grams = similarity.word_trigrams(w)
            n = sum(g in grams for g in similarity.word_trigrams(v))
            if n * 100 / len(grams) >= similarity.THRESHOLD:
                want.add((v, w, n))
    assert {(r.value, r.word, r.matches) for r in got.collect()} == want and len(want) > 6
