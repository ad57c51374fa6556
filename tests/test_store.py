import pytest
from pyspark.sql import functions as F

from pressloom.sources import store, tables


@pytest.fixture(scope="module")
def links(spark):
    rows = [(1, "u1", "Queued", "System"), (2, None, "Queued", "System"), (3, "u3", "Done", "JS_link"),
            (4, "u4", "Queued", "JS_lazy"), (5, "u5", "Queued", "System")]
    return spark.createDataFrame(rows, "link_id long, original_url string, status string, created_by string")


def ids(df):
    return sorted(r.link_id for r in df.collect())


def test_find(links):
    assert ids(store.find(links, {"status": "Queued"}, None)) == [1, 2, 4, 5]
    assert ids(store.find(links, {"status": "Queued", "original_url": {"$ne": None}}, None)) == [1, 4, 5]
    assert ids(store.find(links, {"created_by": {"$in": ["JS_link", "JS_lazy"]}}, None)) == [3, 4]
    assert ids(store.find(links, {"original_url": None}, None)) == [2]
    assert store.find(links, {}, 1).count() == 1
    ordered = store.find(links, {"$query": {"status": "Queued"}, "$orderby": {"link_id": -1}}, 2)
    assert [r.link_id for r in ordered.collect()] == [5, 4]


@pytest.mark.parametrize("query", [{"a": {"$gt": 1}}, {"$or": []}, {"link_id": {"$ne": 3}}])
def test_unknown_operator(links, query):
    with pytest.raises(ValueError):
        store.find(links, query, None)


def test_get_one_and_counts(links):
    assert ids(store.get_one(links, "link_id", 3)) == [3]
    assert ids(store.get_one(links, "link_id", None)) == []
    assert store.counts(links, {"status": "Nope"}).first().n == 0
    assert store.counts(links, {"status": "Nope"}, null_for_none=True).first().n is None
    assert store.counts(links, {"status": "Queued"}, null_for_none=True).first().n == 4


def test_patched(spark, links):
    patches = spark.createDataFrame([(1, "Done", None), (3, None, "Ana")], "link_id long, status string, created_by string")
    got = {r.link_id: (r.status, r.created_by) for r in store.patched(links, patches, "link_id").collect()}
    assert got[1] == ("Done", "System") and got[3] == ("Done", "Ana") and got[5] == ("Queued", "System")
    with pytest.raises(ValueError):
        store.patched(links, patches.select("link_id"), "link_id")


def test_unique_inserts(spark):
    new = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, "c")], "id long, k string")
    old = spark.createDataFrame([("b",)], "k string")
    got = store.unique_inserts(new, old, "k", "id")
    assert sorted(r.id for r in got.collect()) == [1, 5]
    again = store.unique_inserts(new, old.union(got.select("k")), "k", "id")
    assert again.count() == 0


def test_latest(spark):
    log = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, "x", 1)], "id long, s string, v int")
    assert sorted(map(tuple, store.latest(log, "id", "v").collect())) == [(1, "b", 3), (2, "x", 1)]


def test_domain_list_file(spark, tmp_path):
    (tmp_path / "lazy.json").write_text(
        '{\n "lazy-sites": [\n  {"name": "A", "domain": "www\\\\.a\\\\.com$"},\n  {"name": "B", "domain": "b"}\n ]\n}'
    )
    got = tables.read_domain_list(spark, str(tmp_path / "lazy.json"), "lazy-sites").collect()
    assert [tuple(r) for r in got] == [("lazy-sites", "A", r"www\.a\.com$"), ("lazy-sites", "B", "b")]


def test_decode(spark):
    df = spark.createDataFrame([("é".encode(), "utf-8"), ("é".encode("latin-1"), "ISO-8859-1")], "b binary, c string")
    assert [r[0] for r in df.select(tables.decode_page(F.col("b"), F.col("c"))).collect()] == ["é", "é"]


def test_word_tables(spark):
    counts = {r.lang: r.n for r in tables.stopword_table(spark).groupBy("lang").agg(F.count("*").alias("n")).collect()}
    assert counts["tl"] == 147 and set(counts) == {"en", "es", "tl"}
    assert tables.keyword_table(spark).where("dict = 'content_invalid'").count() == 13
