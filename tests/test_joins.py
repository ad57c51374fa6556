import pytest
from pyspark.sql import functions as F

from pressloom.operators import author, joins
from pressloom.plans import harvest as plan


def test_a_filter_keeps_every_wanted_row_and_few_others(spark):
    df = spark.range(20_000).select("id", F.md5(F.col("id").cast("string")).alias("name"))
    for key, wanted in (("id", df.where("id % 100 = 7")), ("name", df.where("id % 50 = 3"))):
        kept = joins.prefiltered(df, key, wanted)
        want = {r[0] for r in wanted.select(key).collect()}
        got = {r[0] for r in kept.select(key).collect()}
        assert want <= got and len(got) <= len(want) + 400
    none = joins.prefiltered(df, "id", df.where("false"))
    assert none.count() == 0
    assert joins.prefiltered(df.where("id is null"), "id", df).count() == 0


def test_a_full_filter_lets_all_through(spark, monkeypatch):
    monkeypatch.setattr(joins, "MOST_BITS", 1 << 10)
    df = spark.range(5_000)
    assert joins.prefiltered(df, "id", df).count() == 5_000


def test_sources_of_other_pages_are_not_shuffled(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    spark.range(3_000).select(
        F.col("id").alias("page_id"), F.concat(F.lit("http://x.com/"), F.col("id") % 2_500).alias("url"), F.lit("<p>x</p>").alias("html")
    ).write.parquet(f"{tmp_path}/pages")
    pages = spark.read.parquet(f"{tmp_path}/pages")
    entries = pages.where("page_id % 200 = 5").select("url", F.lit("en").alias("site_lang"))
    got = plan.pages_for(entries, pages)
    assert {r.page_id for r in got.select("page_id").collect()} == {i % 2_500 for i in range(3_000) if i % 200 == 5}
    # Directly above the scan of the sources, and below all that moves them.
    lines = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    scan = next(i for i, line in enumerate(lines) if "Relation" in line and "html" in line)
    assert "Filter" in lines[scan - 1] and "getbit" in lines[scan - 1] and "page_id" in lines[scan - 1]
    assert not any("getbit" in line and "html" in line for line in lines[:scan - 1])


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_only_heavy_keys_are_divided(spark, monkeypatch, how):
    left = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.when(F.col("id") % 3 == 1, 0).otherwise(F.col("id") % 20)).alias("k"))
    right = spark.range(0, 15, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    want = sorted(map(str, left.join(right, "k", how).collect()))
    monkeypatch.setattr(joins, "HEAVY_ROWS", 100)
    heavy = joins.heavy_keys(left, ["k"]).collect()
    assert {r.k for r in heavy} == {None, 0}
    assert sorted(map(str, joins.lookup(left, right, "k", how, "id", limit=-1).collect())) == want
    monkeypatch.setattr(joins, "HEAVY_ROWS", 10 ** 9)
    assert sorted(map(str, joins.lookup(left, right, "k", how, "id", limit=-1).collect())) == want


def test_a_hot_name_is_divided(spark, monkeypatch):
    monkeypatch.setattr(joins, "HEAVY_ROWS", 50)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    rows = [(i, ["Staff", f"Name {i % 7}", "Nobody", "Staff"] if i % 3 else ["Nobody"]) for i in range(300)] + [(900, []), (901, None)]
    records = spark.createDataFrame(rows, "id long, names array<string>")
    people = spark.createDataFrame([("Staff",), ("Name 3",), ("Staff",), (None,)], "name string")
    got = {r.id: r.names for r in author.verify_authors(records, people, "id", "names").collect()}
    known = {"Staff", "Name 3"}
    for i, names in rows:
        found = list(dict.fromkeys(n for n in names or [] if n in known))[:2]
        assert got[i] == (found or names)


def test_article_log(spark):
    base = spark.createDataFrame(
        [(1, "u1", "Queued", "e", "old", None, "ed", ["s"]), (2, "u2", "Queued", None, "old", None, "ed", None), (3, "u3", "Done", None, "old", None, "ed", None)],
        "article_id long, article_url string, article_status string, article_error_status string, article_title string, "
        "date_updated timestamp_ntz, updated_by string, keyword array<string>")
    record = "struct<" + ", ".join(
        f"{c}: {'string' if c in ('article_title', 'article_content', 'article_media_type', 'article_language', 'article_source_from') else 'timestamp_ntz' if c == 'article_publish_date' else 'double' if c.endswith('value') else 'array<string>'}"
        for c in plan.RECORD_FIELDS) + ">"

    def fields(title, keyword=None):
        return {c: {"article_title": title, "keyword": keyword}.get(c) for c in plan.RECORD_FIELDS}

    def log(rows):
        df = spark.createDataFrame(
            rows, f"article_id long, article_status string, article_error_status string, day int, record {record}")
        return df.withColumn("date_updated", F.expr("timestampadd(DAY, day, timestamp_ntz'2024-01-01 00:00:00')")).drop("day")

    versions = log([
        (1, "Error", "Invalid Content", 1, None), (1, "Done", None, 3, fields("new")), (1, "Error", "timeout", 2, None),
        (2, "Done", None, 1, fields("first", ["k"])), (2, "Error", "timeout", 5, None), (2, "Done", None, 2, fields(None)),
        (9, "Done", None, 1, fields("unknown article")),
    ])
    out = {r.article_id: r for r in plan.with_article_log(base, versions).collect()}
    assert set(out) == {1, 2, 3}
    assert (out[1].article_status, out[1].article_error_status, out[1].article_title, out[1].keyword) == ("Done", None, "new", ["s"])
    # The newest record has no title: the title before it stays; the newest state failed.
    assert (out[2].article_status, out[2].article_error_status, out[2].article_title) == ("Error", "timeout", "old")
    assert (out[3].article_status, out[3].updated_by, out[3].date_updated) == ("Done", "ed", None)
    assert out[1].updated_by == plan.CREATOR and out[1].date_updated.day == 4
    # Compacting in two steps gives what compacting at once gives.
    early, late = versions.where("date_updated < timestamp_ntz'2024-01-03'"), versions.where("date_updated >= timestamp_ntz'2024-01-03'")
    steps = plan.with_article_log(plan.with_article_log(base, early), late)
    same = [c for c in base.columns if c not in ("keyword",)]
    assert sorted(map(str, steps.where("article_id <> 2").select(same).collect())) == sorted(
        map(str, plan.with_article_log(base, versions).where("article_id <> 2").select(same).collect()))


def test_messages_of_the_rendered_mode(spark):
    row = spark.range(1).select(
        plan.error_status(F.lit(plan.OUTCOME_DUPLICATE), F.lit("x"), js=True).alias("js"),
        plan.error_status(F.lit(plan.OUTCOME_DUPLICATE), F.lit("x")).alias("static"),
        plan.error_status(F.lit(plan.OUTCOME_ERROR), F.lit("x"), js=True).alias("error"),
        plan.error_status(F.lit(plan.OUTCOME_NO_TITLE), F.lit("x"), js=True).alias("title")).first()
    assert tuple(row) == ("Duplicate Article Found in Database", None, "x", "Invalid article title")
