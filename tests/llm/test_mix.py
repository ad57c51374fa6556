from pyspark.sql import functions as F

from pressloom.llm import mix


def totals(df):
    rows = df.groupBy("source").agg(
        F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("source_size").alias("size")).collect()
    return {r.source: (r.taken, r.target, r.size) for r in rows}


def test_prefix_sums_match_a_plain_sum(spark):
    rows = [(i % 3 if i % 5 else None, (i * 37) % 101, i % 7) for i in range(300)]
    df = spark.createDataFrame([(g, k, i, v) for i, (g, k, v) in enumerate(rows)], "g int, k int, i int, v int")
    got = {r.i: r.s for r in mix.prefix_sums(df, ["g"], ["k", "i"], "v", "s").collect()}
    for i, (g, k, v) in enumerate(rows):
        assert got[i] == sum(v2 for j, (g2, k2, v2) in enumerate(rows) if g2 == g and (k2, j) < (k, i))


def test_targets_fill_up_by_weight(spark):
    table = spark.createDataFrame([("a", 10), ("b", 100), ("c", 1000), (None, 50)], "source string, source_size long")
    got = {r.source: r.target for r in mix.source_targets(table).collect()}
    # Weights 1, 2, 3 and, null last, 1 again; a stops at 30 and b at 300.
    assert got == {"a": 30.0, "b": 300.0, "c": 680.0, None: 150.0}


def test_every_source_takes_its_budget(spark, docs):
    rows = [(i, " ".join(["w"] * (1 + i * i % 50)), None, f"s{min(i % 9, 3)}") for i in range(200)]
    df = spark.createDataFrame([(*r[:2], "en", r[3], 0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = mix.mix_sources(df)
    for taken, target, size in totals(out).values():
        assert taken == round(target) and target <= 3 * size
    assert out.filter("taken > 3 * size").count() == 0
    again = {(r.doc_id, r.taken) for r in mix.mix_sources(df.repartition(7)).collect()}
    assert again == {(r.doc_id, r.taken) for r in out.collect()}


def test_odd_rows(odd, odd_rows, none):
    out = mix.mix_sources(odd).collect()
    assert len(out) == len(odd_rows)
    assert all(r.taken <= 3 * r["size"] and r.taken >= 0 for r in out)
    assert {r["size"] for r in out if r.doc_id in (3, 4, 5)} == {0}
    assert mix.mix_sources(none).count() == 0 and mix.mixed_documents(none).count() == 0
    kept = mix.mixed_documents(odd)
    assert kept.columns == [*odd.columns, "_size", "taken"]
    assert kept.filter("doc_id = 2").count() <= 1
