import zlib

import numpy as np
from pyspark.sql import functions as F

from pressloom.llm import language


def test_held_out_is_the_remainder_of_the_checksum(spark):
    rows = spark.range(200).select("id", language.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_grams_fold_case_and_anything_between_words():
    a, n = language.grams("Ab, 12 cD")
    b, m = language.grams("  ab\n-cd")
    assert a.tolist() == b.tolist() and n.tolist() == m.tolist() and n.sum() == 5
    assert len(language.grams("12 !")[0]) == 0 and len(language.grams(None)[0]) == 0
    long = language.grams("abc " * 20_000)
    assert long[1].sum() == 80_000 - 1


def test_shares_follow_a_mixture():
    rng = np.random.default_rng(1)
    chances = rng.dirichlet(np.full(400, 0.05), 3)
    logs = np.log(np.pad(chances, ((0, 0), (0, language.BUCKETS - 400))) + 1e-9)
    model = language.Languages(["a", "b", "c"], logs)
    counts = rng.multinomial(2000, 0.7 * chances[0] + 0.3 * chances[2])
    used = np.flatnonzero(counts)
    found = dict(model.shares(used, counts[used]))
    assert set(found) == {"a", "c"} and abs(found["a"] - 0.7) < 0.05
    counts = rng.multinomial(500, chances[1])
    used = np.flatnonzero(counts)
    assert [n for n, _ in model.shares(used, counts[used])] == ["b"]


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    told = language.predicted(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in told) / len(told) > 0.97
    assert all(0 <= r.score <= 1 for r in told)


def test_inputs_of_a_prediction_are_the_text_only(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.train(docs)
    a = docs.select("doc_id", language.identify(F.col("text"), model).alias("x")).collect()
    b = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None)).select(
        "doc_id", language.identify(F.col("text"), model).alias("x")).collect()
    assert sorted(a) == sorted(b)


def test_odd_rows(odd, odd_rows, none):
    out = language.predicted(odd).collect()
    assert len(out) == len(odd_rows)
    assert {(r.lang_pred, r.score) for r in out if r.doc_id in (3, 4, 5)} == {("und", 0.0)}
    assert language.predicted(none).count() == 0
    unlearned = language.predicted(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unlearned} == {"und"}
