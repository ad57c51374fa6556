import pytest
from pyspark.sql import functions as F

from pressloom.functions import urls
from pressloom.operators.joins import lookup

CANONICAL = {
    "https://www.a.com/x/?q=1#f": "http://www.a.com/x",
    "//a.com/x//": "http://a.com/x",
    "a.com/x": "http://a.com/x",
    "http://u:p@a.co.uk:80/x/y;z=1": "http://u:p@a.co.uk:80/x/y",
    "HTTP://A.com/X;p/y;q?z": "http://A.com/X;p/y",
    " http://a.com/a\nb": "http://a.com/ab",
    "http://a.com?x=/y": "http://a.com",
    "": "http://",
}


def test_canonical_url(values):
    got = values([(u,) for u in CANONICAL], "u string", urls.canonical_url(F.col("u")))
    assert dict(zip(CANONICAL, got)) == CANONICAL


def test_canonical_url_is_idempotent(values):
    once = values([(u,) for u in CANONICAL], "u string", urls.canonical_url(F.col("u")))
    assert values([(u,) for u in once], "u string", urls.canonical_url(F.col("u"))) == once


def test_media_url(values):
    want = {
        "https://a.com/i.png?w=1#x": "https://a.com/i.png",
        "//a.com/i.png": "http://a.com/i.png",
        "/i.png?x": "/i.png",
        "a.com/i.png": "http://a.com/i.png",
    }
    got = values([(u,) for u in want], "u string", urls.media_url(F.col("u")))
    assert dict(zip(want, got)) == want


@pytest.mark.parametrize("url, fqdn, name", [
    ("http://www.blog.a.co.uk/x", "blog.a.co.uk", "A"),
    ("http://www.a.com", "a.com", "A"),
    ("http://a.com", "a.com", "A"),
    ("https://abc9news.com", "abc9news.com", "Abc9 News"),
    ("http://localhost:80/x", "localhost:80", "Localhost:80"),
    ("http://User@WWW.A.com:8080/", "a.com", "A"),
])
def test_site_identity(spark, url, fqdn, name):
    row = spark.range(1).select(urls.site_identity(F.lit(url)).alias("s")).first().s
    assert (row.fqdn, row.website_name) == (fqdn, name)


def test_suffix_table_agrees_with_short_list(spark):
    hosts = ["http://www.blog.a.co.uk/", "http://a.com", "http://com", "http://x.y.z.org:1/p", "http://q.unknown"]
    df = spark.createDataFrame([(h,) for h in hosts], "u string")
    listed = df.select("u", urls.site_identity(F.col("u")).alias("site"))
    suffixes = spark.createDataFrame([(s,) for s in ["com", "net", "org", "co.uk", "uk"]], "suffix string")
    joined = urls.site_identity_with(df, "u", suffixes)
    assert sorted(map(str, listed.collect())) == sorted(map(str, joined.collect()))


RULES = ["com", "co.uk", "uk", "jp", "*.ck", "!www.ck", "*.kobe.jp", "!city.kobe.jp", "a.b.c", "*.x.*.y"]


@pytest.mark.parametrize("host, suffix", [
    ("a.com", "com"), ("com", "com"), ("x.co.uk", "co.uk"), ("y.uk", "uk"), ("xco.uk", "uk"), ("a.b.ck", "b.ck"),
    ("b.ck", "b.ck"), ("ck", ""), ("www.ck", "ck"), ("a.www.ck", "ck"), ("awww.ck", "awww.ck"), ("x.kobe.jp", "x.kobe.jp"),
    ("kobe.jp", "jp"), ("city.kobe.jp", "kobe.jp"), ("z.city.kobe.jp", "kobe.jp"), ("b.c", ""), ("q.a.b.c", "a.b.c"),
    ("m.x.n.y", "m.x.n.y"), ("A.COM", "com"), ("localhost", ""), ("", ""), ("scom", ""), ("a.commerce", ""),
])
def test_public_suffix_rules(spark, host, suffix):
    from pressloom.functions.suffix import host_parts, public_suffix

    row = spark.range(1).select(public_suffix(F.lit(host), RULES).alias("s"), host_parts(F.lit(host), RULES).alias("p")).first()
    assert row.s == suffix
    stem = host[:len(host) - len(suffix) - 1] if suffix and len(host) > len(suffix) else ""
    assert (row.p.tld, row.p.domain, row.p.subdomain) == (
        suffix if stem else "", stem.rpartition(".")[2], stem.rpartition(".")[0])


def test_rules_of_a_table_are_part_of_the_plan(spark):
    table = spark.createDataFrame([("*.CK",), ("!www.ck",), (None,)], "suffix string")
    df = spark.createDataFrame([("http://news.a.ck/1",), ("http://www.ck/2",)], "u string")
    found = urls.site_identity_with(df, "u", table)
    assert "Join" not in found._jdf.queryExecution().toString()
    assert [tuple(r) for r in found.select("site.domain", "site.tld").collect()] == [("news", "a.ck"), ("www", "ck")]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_lookup_equals_broadcast(spark, how):
    left = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20).alias("k"))
    right = spark.range(0, 15, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    salted = lookup(left, right, "k", how, "id", limit=-1)
    assert sorted(map(str, salted.collect())) == sorted(map(str, lookup(left, right, "k", how, "id").collect()))
    assert "BroadcastHashJoin" in lookup(left, right, "k", how, "id")._jdf.queryExecution().toString()
