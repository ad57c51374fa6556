from pyspark.sql import functions as F

from pressloom.operators import sites

CANDIDATE = "candidate_id long, website_name string, fqdn string, website_url string, subdomain string, tld string"


def test_names(spark):
    rows = [
        (1, "News", "news.com", "u1", "www", "com"),
        (2, "News", "blog.news.com", "u2", "blog", "com"),
        (3, "News", "blog.news.co.uk", "u3", "blog", "co.uk"),
        (4, "News", "news.co.uk", "u4", "", "co.uk"),
        (5, "Taken", "taken.com", "u5", "www", "com"),
        (6, "Taken", "MY.taken.com", "u6", "MY", "com"),
    ]
    found = spark.createDataFrame(rows, CANDIDATE)
    taken = spark.createDataFrame([("Taken",)], "website_name string")
    got = {r.candidate_id: r.website_name for r in sites.disambiguate(found, taken).collect()}
    assert got == {
        1: "News", 2: "Blog News", 3: "Blog News Co Uk", 4: "News Co Uk", 5: "Taken Com", 6: "My Taken",
    }


def test_reconcile(spark):
    registry = spark.createDataFrame(
        [(10, "A", "a.com", "http://a.com"), (11, "B", "old.b.com", "http://b.com"),
         (12, "C", "c1.com", "http://c1.com"), (13, "C", "c2.com", "http://c2.com"), (14, "D", "x.com", "http://x.com")],
        "website_id long, website_name string, fqdn string, website_url string")
    rows = [
        (1, "A", "a.com", "http://a.com", "", "com"),          # same site
        (2, "Z", "b.com", "http://b.com", "", "com"),          # same url, other fqdn
        (3, "C", "c1.com", "http://c1.com", "", "com"),        # name is not unique: no match
        (4, "D", "d.com", "http://d.com", "", "com"),          # same name, other site
        (5, "E", "e.com", "http://e.com", "", "com"),          # unknown
    ]
    got = {r.candidate_id: (r.existing_id, r.action) for r in
           sites.reconcile(spark.createDataFrame(rows, CANDIDATE), registry).collect()}
    assert got == {1: (10, "KEEP"), 2: (11, "UPDATE_FQDN"), 3: (None, "INSERT"), 4: (14, "INSERT"), 5: (None, "INSERT")}


def test_eligibility(spark):
    rows = [("Philippines", False, "a.com", True), ("Singapore", None, "a.com", True), ("Japan", False, "a.com", False),
            ("Singapore", True, "a.com", False), ("Singapore", False, "philstar.com", False), (None, None, None, False)]
    df = spark.createDataFrame(rows, "country string, agg boolean, fqdn string, want boolean")
    got = df.select(sites.is_eligible(F.col("country"), F.col("agg"), F.col("fqdn")), "want").collect()
    assert all(r[0] == r[1] for r in got)


def test_lists_are_anchored_at_the_start(spark):
    df = spark.createDataFrame([("www.a.com",), ("xwww.a.com",), ("www.a.com.evil",), ("m.a.com",)], "h string")
    got = [r[0] for r in df.select(sites.matches_list(F.col("h"), [r"www\.a\.com$", r"m\."])).collect()]
    assert got == [True, False, False, True]


def test_country_fields(spark):
    f = sites.country_fields(F.lit("Philippines"), F.lit("US"))
    g = sites.country_fields(F.lit(None).cast("string"), F.lit(None).cast("string"))
    row = spark.range(1).select(f.alias("f"), g.alias("g")).first()
    assert tuple(row.f) == ("USA", "LOCAL_NEWS") and tuple(row.g) == (None, "INTERNATIONAL_NEWS")
