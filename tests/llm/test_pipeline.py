import pytest

import corpus_pipeline
from pressloom.llm import pii

STAGES = dict(corpus_pipeline.STAGES)


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_a_stage_keeps_columns_and_rows_of_odd_tables(spark, odd, none, folder, name):
    kept = STAGES[name](spark, odd, folder)
    assert kept.columns == odd.columns and kept.dtypes == odd.dtypes
    before, after = rows(odd), rows(kept)
    assert not set(after) - set(before)
    assert STAGES[name](spark, none, folder).count() == 0
    if name == "near duplicates":
        # Rows 1 and 2 say the same and one stays; a row without an id has no class.
        assert sum("one two three" in r for r in after) == 2 and sum("doc_id=None" in r for r in after) == 2
    if name in ("decontamination", "personal data"):
        assert after == before


def test_the_mix_of_odd_tables(spark, odd, none, folder):
    mixed = STAGES["source mix"](spark, odd, folder)
    assert mixed.columns == [*odd.columns, "_size", "taken"] and mixed.filter("taken <= 0").count() == 0
    assert STAGES["source mix"](spark, none, folder).count() == 0


def test_stages_match_their_operators_on_given_tables(spark, folder):
    """Each stage by itself on the documents, against what its operator says of them."""
    from pressloom.llm import queries

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    every = {r.doc_id for r in docs.select("doc_id").collect()}

    def kept(name):
        return {r.doc_id for r in STAGES[name](spark, docs, folder).select("doc_id").collect()}

    verdicts = {r.doc_id: r.kept for r in queries.op4_quality_rules(spark, folder).collect()}
    assert kept("quality rules") == {i for i, k in verdicts.items() if k}
    held = {r.doc_id for r in queries.op2_decontaminate(spark, folder).collect()}
    assert kept("decontamination") == every - held
    classes = {}
    for r in queries.op5_near_duplicates(spark, folder).collect():
        classes.setdefault(r[1], []).append(r.doc_id)
    unique = kept("near duplicates")
    assert len(unique) == len(classes) and all(len(unique & set(c)) == 1 for c in classes.values())
    masked = {r.doc_id: r.text for r in STAGES["personal data"](spark, docs, folder).collect()}
    assert set(masked) == every
    found = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    for r in docs.collect():
        assert (masked[r.doc_id] == r.text) == (found[r.doc_id].spans == "")


def test_the_whole_pipeline(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert out.columns == [*docs.columns, "size", "taken"]
    got = out.collect()
    assert 0 < len(got) < docs.count() and len({r.doc_id for r in got}) == len(got)
    assert all(0 < r.taken <= 3 * r["size"] for r in got)
