from hashlib import sha256
from math import floor, log
from zlib import crc32

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from pressloom.llm import resample

WORD = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    runs = [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return words, [crc32(r.encode()) for r in runs]


def brute(docs, target, percent=10, least_words=20, longest=1, buckets=10_000):
    s, t = np.zeros(buckets, int), np.zeros(buckets, int)
    found = [(i, *features(text, longest)) for i, text in docs]
    for _, _, hashes in found:
        for h in hashes:
            s[h % buckets] += 1
    for text in target:
        for h in features(text, longest)[1]:
            t[h % buckets] += 1
    gain = [floor(1000 * log((b + 1) * (int(s.sum()) + buckets) / ((a + 1) * (int(t.sum()) + buckets)))) for a, b in zip(s.tolist(), t.tolist(), strict=True)]
    rows = []
    for i, words, hashes in found:
        weight = sum(gain[h % buckets] for h in hashes) // len(hashes) if hashes else 0
        h = int(sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + floor(-1000 * log(-log((h + 0.5) / 4294967296)))
        rows.append((i, len(words), len(hashes), weight, score))
    able = sorted((r for r in rows if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = percent * len(able) // 100
    out = [(r[0], *r[2:], n + 1 if n < drawn else None) for n, r in enumerate(able)]
    return sorted([*out, *((r[0], *r[2:], None) for r in rows if r[1] < least_words)], key=repr)


def result(docs, target, **options):
    out = resample.resampled(docs, target, **options)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("longest", [1, 3])
def test_given_tables(spark, folder, longest):
    docs, target = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "benchmark"))
    options = {"longest": longest, "percent": 30, "buckets": 500}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(docs, target, **options) == brute(rows, [r.text for r in target.collect()], **options)


def test_odd_rows(spark, odd, odd_rows, none):
    target = spark.createDataFrame([("one two three WORD",), (None,), ("",)], "text string")
    texts = [(r[0], r[1]) for r in odd_rows]
    want = ["one two three WORD", None, ""]
    assert result(odd, target, percent=50, least_words=12) == brute(texts, want, percent=50, least_words=12)
    assert result(odd, none.select("text")) == brute(texts, [])
    assert result(none, target) == []


def test_words_are_ascii_letters_and_digits_and_all_beyond():
    assert resample.feature_words("A-b2 É\x7fz x€_y\x00Kİ") == [
        b"a", b"b2", "É".encode(), "z x€".encode(), b"y", "kİ".encode()]
    assert resample.feature_words(None) == [] and resample.feature_words("") == []


@pytest.mark.parametrize("segments", [1, 3, 8])
def test_ranked_matches_a_plain_sort(spark, segments):
    rng = np.random.default_rng(segments)
    rows = [(int(k), int(i)) for i, k in enumerate(rng.integers(-5, 40, 500))]
    df = spark.createDataFrame(rows, "k long, i long").repartition(5)
    got = {(r.k, r.i): r.rank for r in resample.ranked(df, [-F.col("k"), F.col("i")], segments=segments).collect()}
    assert got == {row: n + 1 for n, row in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])))}


def test_segments_stay_even_when_rows_agree(spark, monkeypatch):
    kept = []
    plain = resample.stage
    monkeypatch.setattr(resample, "stage", lambda df, name: kept.append((name, plain(df, name))) or kept[-1][1])
    df = spark.range(4000).select(F.lit(1).alias("k"), F.lit("x").alias("x")).repartition(8)
    out = resample.ranked(df, [F.col("k")], segments=8)
    assert sorted(r.rank for r in out.collect()) == list(range(1, 4001))
    merged = dict(kept)["segments"].groupBy("__segment").count().collect()
    assert len(merged) == 8 and max(r["count"] for r in merged) <= 1000


def test_ranking_nothing(spark):
    assert resample.ranked(spark.range(0), [F.col("id")]).count() == 0
