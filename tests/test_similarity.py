import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pressloom import vocab
from pressloom.functions import similarity as S, text
from pressloom.operators.content import _Words

DICTIONARIES = {
    "author": vocab.AUTHOR_KEYS, "date": vocab.DATE_KEYS, "content": vocab.CONTENT_KEYS,
    "invalid": vocab.CONTENT_INVALID_KEYS, "html": ["text/html"],
}
GOLDEN = [
    ("cse_author", "author", [("AUTHOR", 6, 75)]),
    ("byline", "author", [("BYLINE", 8, 100)]),
    ("by-line", "author", [("BYLINE", 6, 75)]),
    ("authors", "author", [("AUTHOR", 6, 75)]),
    ("authority", "author", [("AUTHOR", 6, 75)]),
    ("post-meta", "author", []),
    ("date", "date", [("DATE", 6, 100)]),
    ("update", "date", [("DATE", 4, 67)]),
    ("pubdate", "date", [("DATE", 4, 67)]),
    ("entry-date", "date", [("DATE", 4, 67)]),
    ("candidate", "date", [("DATE", 4, 67)]),
    ("template", "date", [("DATE", 3, 50)]),
    ("time", "date", []),
    ("entry-content", "content", [("content", 8, 89)]),
    ("maincontent", "content", [("content", 7, 78), ("main", 4, 67)]),
    ("domain", "content", [("main", 4, 67)]),
    ("ads ads ads", "invalid", [("ads", 11, 220)]),
    ("heads", "invalid", [("ads", 3, 60)]),
    ("status", "invalid", [("stats", 5, 71)]),
    ("navlinks", "invalid", [("nav-links", 8, 73)]),
    ("text/html; charset=UTF-8", "html", [("text/html", 9, 82)]),
    ("", "invalid", []),
]


def brute(value: str, word: str) -> tuple[int, float]:
    """Matches and percent straight from the definition."""
    def grams(text):
        padded = f"  {text}  ".upper()
        return [padded[i:i + 3] for i in range(len(padded) - 2)]

    own = grams(word)
    matches = sum(g in set(own) for g in grams(value))
    return matches, matches / len(own) * 100


@pytest.mark.parametrize("name", DICTIONARIES)
def test_golden_table(values, name):
    cases = [(v, hits) for v, d, hits in GOLDEN if d == name]
    got = values([(v,) for v, _ in cases], "v string", S.similar_words(F.col("v"), DICTIONARIES[name]))
    assert [[tuple(h) for h in hits] for hits in got] == [hits for _, hits in cases]


def test_top_similarity_is_by_matches(values):
    got = values([("maincontent",), ("ads ads ads",), ("zzz",)], "v string",
                 S.top_similarity(F.col("v"), vocab.CONTENT_KEYS))
    assert got == [78, None, None]


def test_trigram_count_is_length_plus_two(values):
    words = ["a", "ab", "author", "x-y z", "niño"]
    got = values([(w,) for w in words], "v string", F.size(S.trigrams(F.col("v"))))
    assert got == [len(w) + 2 for w in words]


@pytest.mark.parametrize("limit", [S.BROADCAST_BYTES, -1])
def test_join_equals_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(S, "BROADCAST_BYTES", limit)
    rng = random.Random(7)
    alphabet = ["th", "er", "an", "on", "s", "ß", "a"]
    def make(n):
        return sorted({"".join(rng.choices(alphabet, k=rng.randint(1, 5))) for _ in range(n)})
    vals, words = make(120) + ["ananananan", "a a a a"], make(60)
    got = {
        (r.value, r.word, r.matches, r.similarity)
        for r in S.similarity_join(
            spark.createDataFrame([(v,) for v in vals], "value string"),
            spark.createDataFrame([(w,) for w in words], "word string"),
        ).collect()
    }
    want = set()
    for v in vals:
        for w in words:
            matches, percent = brute(v, w)
            if percent >= 49:
                want.add((v, w, matches, round(percent)))
    assert got == want and want


@settings(max_examples=200, deadline=None)
@given(st.text("abn ß-", max_size=12), st.lists(st.text("abnß-", min_size=1, max_size=6), max_size=4))
def test_growing_dictionary_equals_brute_force(value, words):
    scored = [(brute(value, w), i) for i, w in enumerate(dict.fromkeys(words))]
    hits = [(m, p) for (m, p), _ in scored if p >= 49]
    best = max(hits, key=lambda h: h[0]) if hits else None
    known = _Words(words)
    assert known.best(value) == (None if best is None else round(best[1]))
    assert known.hit(value) == bool(hits)


@pytest.mark.parametrize("limit", [None, 0])
def test_join_of_document_words_matches_brute_force(spark, tmp_path, monkeypatch, limit):
    """Broadcast, and shuffled with every trigram of more than three values salted."""
    from checks.queries import QUERIES

    if limit is not None:
        monkeypatch.setattr(S, "BROADCAST_BYTES", limit)
        monkeypatch.setattr(S, "PER_GRAM", 3)
    source = "/root/testdata/sf0.001"
    for name, n in (("documents", 12), ("benchmark", 2)):
        spark.read.parquet(f"{source}/{name}.parquet").limit(n).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    def words(name):
        tokens = text.content_tokens(F.col("text"), vocab.STOPWORDS_EN)
        rows = spark.read.parquet(f"{tmp_path}/{name}.parquet").select(F.explode(tokens).alias("w")).distinct().collect()
        return {r.w for r in rows if r.w}
    want = set()
    values = {v: S.word_trigrams(v) for v in words("documents")}
    for word in words("benchmark"):
        grams = S.word_trigrams(word)
        for value, own in values.items():
            matches = sum(g in set(grams) for g in own)
            if matches * 100.0 / len(grams) >= S.THRESHOLD:
                want.add((value, word, matches, round(matches * 100.0 / len(grams))))
    got = [tuple(r) for r in QUERIES["trigram_similarity_join_documents"](spark, str(tmp_path)).collect()]
    assert len(values) > 100 and want and len(got) == len(want) and set(got) == want
