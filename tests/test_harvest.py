import pytest
from pyspark.sql import functions as F

from checks.queries import as_of
from pressloom.plans import harvest as plan
from pressloom.schemas import ARTICLES, LINKS
from pressloom.sources import derived, store, tables
from pressloom.streaming import harvest_stream

TEXT = "The storm hit the coast on Monday and thousands of people had to leave their homes, officials of the town said."


def page(body, title="Storm hits the coast"):
    return f"<title>{title}</title><body><article><p>{body}</p></article></body>"


PAGES = [
    (1, "http://a.com/1", page(TEXT)),
    (2, "https://a.com/1?x=1", page(TEXT)),               # same article, later
    (3, "http://a.com/2", page("")),                      # no content ...
    (4, "http://a.com/2#top", page(TEXT + " Two.")),      # ... but this copy has
    (5, "http://a.com/2/", page(TEXT + " Three.")),       # later than the copy that was read
    (6, "http://a.com/3", page(TEXT, "Page not found: storm on the coast")),
    (7, "http://b.com/1", page(TEXT)),                    # site not eligible
    (8, "http://unknown.com/1", page(TEXT)),              # site not registered
    (9, "http://a.com/old/", page(TEXT)),                 # stored before
    (11, "http://a.com/1", page("other source, same address")),
]
LINK_URLS = {p[0]: p[1] for p in PAGES[:-1]} | {10: "http://a.com/missing", 12: "http://a.com/1"}
WANT = {
    1: plan.OUTCOME_SCRAPED, 2: plan.OUTCOME_DUPLICATE, 3: plan.OUTCOME_NO_CONTENT, 4: plan.OUTCOME_SCRAPED,
    5: plan.OUTCOME_DUPLICATE, 6: plan.OUTCOME_NO_TITLE, 7: plan.OUTCOME_NOT_ELIGIBLE,
    8: plan.OUTCOME_NOT_ELIGIBLE, 9: plan.OUTCOME_DUPLICATE, 10: plan.OUTCOME_ERROR, 12: plan.OUTCOME_DUPLICATE,
}


@pytest.fixture(scope="module")
def world(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    links = spark.createDataFrame(sorted(LINK_URLS.items()), "link_id long, original_url string")
    sites = spark.createDataFrame(
        [(1, "a.com", "A", "Singapore", False), (2, "b.com", "B", "Japan", False), (3, "a.com", "A2", "Japan", True)],
        "website_id long, fqdn string, website_name string, country string, is_aggregator boolean")
    stored = spark.createDataFrame([("http://a.com/old",)], "article_url string")
    return links, pages, sites, stored


@pytest.fixture(scope="module")
def result(world):
    return plan.harvest(*world, as_of())


def test_outcomes(result):
    assert {r.link_id: r.outcome for r in result.outcomes.collect()} == WANT
    assert result.outcomes.count() == len(LINK_URLS)


def test_articles(result, spark):
    rows = {r.article_id: r for r in result.articles.collect()}
    assert set(rows) == {1, 4}
    assert rows[1].article_url == "http://a.com/1" and rows[1].article_content == TEXT
    assert rows[4].article_url == "http://a.com/2" and rows[4].article_content == TEXT + " Two."
    assert [f.name for f in result.articles.schema] == [f.name for f in spark.createDataFrame([], ARTICLES).schema]


def test_statuses(result):
    static = {r.link_id: (r.status, r.error_status, r.created_by) for r in result.link_updates(as_of()).collect()}
    assert static[1] == ("Done", None, None) and static[2] == ("Done", None, None)
    assert static[3] == ("Error", "Invalid Content", None) and static[6] == ("Error", "Invalid article title", None)
    assert static[7] == ("Error", "Unverified Website", None) and static[10] == ("Error", "no page source", None)
    rendered = {r.link_id: (r.status, r.created_by) for r in result.link_updates(as_of(), js=True).collect()}
    assert rendered[1] == ("Done", None) and rendered[2] == ("Error", "JS_Error")
    assert rendered[3] == ("Error", None) and rendered[6] == ("Error", None) and rendered[7] == ("Error", "JS_Error")


def test_running_again_adds_nothing(world, result):
    links, pages, sites, stored = world
    again = plan.harvest(links, pages, sites, stored.union(result.articles.select("article_url")), as_of())
    assert again.articles.count() == 0
    assert {r.link_id for r in again.outcomes.where("outcome = 'Article Scraped'").collect()} == set()


def test_stored_articles_are_read_again(world):
    links, pages, sites, stored = world
    again = plan.harvest(links, pages, sites, stored, as_of(), check_duplicates=False)
    got = {r.link_id: r.outcome for r in again.outcomes.collect()}
    assert got[9] == got[2] == got[5] == plan.OUTCOME_SCRAPED and got[3] == plan.OUTCOME_NO_CONTENT


def test_salted_lookups_give_the_same(world, result, monkeypatch):
    import pressloom.operators.joins as joins
    monkeypatch.setattr(joins.lookup, "__defaults__", ("left", None, -1))
    salted = plan.harvest(*world, as_of())
    assert {r.link_id: r.outcome for r in salted.outcomes.collect()} == WANT


def test_stream_equals_batch(spark, world, result, tmp_path):
    links, pages, sites, _ = world
    queue = links.select(
        "link_id", "original_url", F.lit("Queued").alias("status"), F.lit("System").alias("created_by"),
        F.expr("timestampadd(MINUTE, cast(link_id as int), timestamp_ntz'2024-01-01 00:00:00')").alias("date_created"),
        F.lit(None).cast("timestamp_ntz").alias("date_updated"))
    queue.coalesce(1).write.parquet(f"{tmp_path}/links")
    queue.where("link_id <= 3").coalesce(1).write.mode("append").parquet(f"{tmp_path}/links")   # delivered twice
    out = f"{tmp_path}/out"

    def start():
        run = harvest_stream.harvest_available(
            harvest_stream.link_stream(spark, f"{tmp_path}/links"),
            pages, sites, out, f"{tmp_path}/checkpoint", as_of)
        assert run.exception() is None

    start()
    want = {i: o for i, o in WANT.items()} | {9: plan.OUTCOME_SCRAPED}      # nothing stored at the start
    status = {r.link_id: r.status for r in spark.read.parquet(f"{out}/link_status").collect()}
    done = {plan.OUTCOME_SCRAPED, plan.OUTCOME_DUPLICATE}
    assert status == {i: "Done" if o in done else "Error" for i, o in want.items()}
    assert {r.article_id for r in spark.read.parquet(f"{out}/articles").collect()} == {1, 4, 9}

    queue.where("link_id in (1, 4)").withColumn("link_id", F.col("link_id") + 100).withColumn(
        "date_created", F.expr("date_created + interval 1 hour")
    ).coalesce(1).write.mode("append").parquet(f"{tmp_path}/links")
    start()
    articles = spark.read.parquet(f"{out}/articles")
    assert articles.count() == 3 and articles.select("article_url").distinct().count() == 3
    late = spark.read.parquet(f"{out}/link_status").where("link_id > 100").collect()
    assert {(r.link_id, r.status) for r in late} == {(101, "Done"), (104, "Done")}

    # A link much older than all before, one delivered once more, one put back.
    old = queue.where("link_id = 3").withColumn("link_id", F.lit(200)).withColumn("date_created", F.expr("timestamp_ntz'2019-01-01 00:00:00'"))
    again = queue.where("link_id = 1")
    requeued = queue.where("link_id = 4").withColumn("date_updated", F.expr("timestamp_ntz'2024-02-01 00:00:00'"))
    for rows in (old, again, requeued):
        rows.select(*queue.columns).coalesce(1).write.mode("append").parquet(f"{tmp_path}/links")
    start()
    times = {r.link_id: r["count"] for r in spark.read.parquet(f"{out}/link_status").groupBy("link_id").count().collect()}
    assert times[200] == 1 and times[1] == 1 and times[4] == 2


def test_sites_of_the_eligible_countries(spark):
    """Hosts under com.ph and com.sg have a domain and a name, and their sites are found."""
    urls = [(1, "http://www.mb.com.ph/1"), (2, "http://WWW.MB.com.ph:8080/2"), (3, "https://straitstimes.com.sg/3")]
    pages = spark.createDataFrame([(i, u, page(f"{TEXT} {i}.")) for i, u in urls], "page_id long, url string, html string")
    links = spark.createDataFrame(urls, "link_id long, original_url string")
    sites = spark.createDataFrame(
        [(1, "mb.com.ph", "Mb", "Philippines", False), (2, "straitstimes.com.sg", "Straitstimes", "Singapore", False)],
        "website_id long, fqdn string, website_name string, country string, is_aggregator boolean")
    stored = spark.createDataFrame([], "article_url string")
    found = {r.page_id: r for r in derived.site_pages(pages).collect()}
    assert [found[i].website_name for i in (1, 2, 3)] == ["Mb", "Mb", "Straitstimes"]
    assert [(found[i].domain, found[i].tld) for i in (1, 3)] == [("mb", "com.ph"), ("straitstimes", "com.sg")]
    got = plan.harvest(links, pages, sites, stored, as_of()).outcomes
    assert {r.link_id: r.outcome for r in got.collect()} == {i: plan.OUTCOME_SCRAPED for i, _ in urls}
    table = spark.createDataFrame([("com",), ("ph",)], "suffix string")
    assert {r.tld for r in derived.sites(pages, table).collect()} == {"ph", ""}
