"""Hand-made pages with the record each must give."""

import datetime

import pytest
from pyspark.sql import functions as F

from pressloom.operators.record import extract
from pressloom.plans.register import with_icons

BODY = (
    "The storm hit the coast on Monday and thousands of people had to leave their homes before night "
    "fell over the bay, officials said."
)
HEAD = "<title>Storm hits the coast - Daily</title>"
H1 = "<h1>Storm hits the coast</h1>"
FARM = "".join(f'<a href="/{i}">l{i}</a>' for i in range(12))


def article(inner, head=HEAD):
    return f"<html><head>{head}</head><body><article>{H1}{inner}<p>{BODY}</p></article></body></html>"


PAGES = {
    "author": article('<span class="cse_author">Ana Cruz</span>'),
    "author_in_comments": article('<div class="comments"><span class="byline">Ana Cruz</span></div>'),
    "author_long_value": article('<span id="author-of-the-article-x">Ana</span>'),
    "author_long_element": article('<span class="author-of-the-article-marker">Ana</span>'),
    "author_words": article('<p class="byline">By Ana <time>now</time> Cruz, and Jo!</p>'),
    "author_empty": article('<span class="author"> </span><a rel="author">Jo Reyes</a>'),
    "date": article('<time class="entry-date">March 3, 2021</time>'),
    "date_future": article('<time class="entry-date">March 3, 2999</time>'),
    "date_template": article('<p class="template">Jan 1, 2020</p>'),
    "date_later_tag": article('<time class="date">soon</time><span id="pubdate">2021-02-30 then 4 May 2022</span>'),
    "date_split": article('<span class="date"><b>March</b> <i>3</i>, 2021</span>'),
    "second_heading": f"<html><head>{HEAD}</head><body><h1>Something else entirely here</h1>"
                      f"<h2>Storm hits the coast</h2><article><p>{BODY}</p></article></body></html>",
    "invalid_title": f"<title>Page Not Found - X</title><body><article><p>{BODY}</p></article></body>",
    "accented_title": f"<title>La página no encontrada</title><body><article><p>{BODY}</p></article></body>",
    "only_h1": f"<body><article>{H1}<p>{BODY}</p></article></body>",
    "meta": article("", HEAD + '<meta property="og:image" content="http://i/x.png"><meta name="author" content="Meta Name">'
                    '<meta property="article:published_time" content="2020-05-06T07:08:09+08:00">'
                    '<meta property="og:video" content="v.mp4">'),
    "siblings": f"<title>Storm coast</title><body><div class='wrap'><div class='post-content'>{BODY}</div>"
                f"<div class='post-content'>{BODY} Two.</div></div></body>",
    "link_farm": f"<title>Storm hits the coast</title><body><article><div class='content'>{FARM}</div>"
                 f"<div class='main'><p>{BODY}</p></div></article></body>",
    "only_div": f"<title>Storm hits the coast</title><body><div><p>{BODY}</p></div></body>",
    "pruned": article('<div class="newsletter">Sign up here</div><div class="related-articles">Kept</div><nav>x</nav><ul><li>y</ul>'),
    "empty": "<title>Storm hits the coast</title><body></body>",
    "short": "<title>Storm hits the coast</title><body><article><p>Storm.</p></article></body>",
    "quotes": f"<title>Storm hits the coast</title><body><article><p>It’s  “{BODY}”\n\n– café</p></article></body>",
    "language": f"<html lang='es-MX'><title>Storm hits the coast</title><body><article>{BODY}</article></body></html>",
}


@pytest.fixture(scope="module")
def records(spark):
    rows = [(k, v, "en") for k, v in PAGES.items()]
    df = spark.createDataFrame(rows, "name string, html string, site_lang string")
    as_of = F.lit("2024-06-01").cast("timestamp_ntz")
    return {r.name: r for r in extract(df, ["name"], as_of).collect()}


@pytest.mark.parametrize("name, want", [
    ("author", ["Ana Cruz"]), ("author_in_comments", []), ("author_long_value", []),
    ("author_long_element", []), ("author_words", ["Ana Cruz Jo"]), ("author_empty", ["Jo Reyes"]),
    ("meta", ["Meta Name"]), ("date", []),
])
def test_authors(records, name, want):
    assert records[name].article_authors == want


@pytest.mark.parametrize("name, want", [
    ("date", (2021, 3, 3)), ("date_future", (2024, 6, 1)), ("date_template", (2020, 1, 1)),
    ("date_later_tag", (2022, 5, 4)), ("date_split", (2021, 3, 3)), ("author", (2024, 6, 1)),
    ("meta", (2020, 5, 6, 7, 8, 9)),
])
def test_dates(records, name, want):
    assert records[name].article_publish_date == datetime.datetime(*want)


@pytest.mark.parametrize("name, want", [
    ("author", "Storm hits the coast"), ("second_heading", "Storm hits the coast"),
    ("invalid_title", None), ("accented_title", None), ("only_h1", "Storm hits the coast"),
])
def test_titles(records, name, want):
    assert records[name].article_title == want


@pytest.mark.parametrize("name, want", [
    ("only_h1", f"Storm hits the coast {BODY}"),
    ("siblings", f"{BODY} {BODY} Two."),
    ("link_farm", BODY),
    ("only_div", BODY),
    ("pruned", f"Storm hits the coast Kept {BODY}"),
    ("empty", None), ("short", None),
    ("quotes", f'Its "{BODY}" - cafe'),
])
def test_content(records, name, want):
    assert records[name].article_content == want


def test_media_and_language(records):
    assert records["meta"].article_images == ["http://i/x.png"]
    assert records["meta"].article_videos == ["v.mp4"]
    assert records["author"].article_images == [] and records["author"].article_videos == []
    assert records["language"].article_language == "es" and records["author"].article_language == "en"


def test_icons(spark):
    sites = spark.createDataFrame([(1, "http://a.com"), (2, "http://b.com"), (3, "http://c.com")],
                                  "candidate_id long, website_url string")
    pages = spark.createDataFrame(
        [(1, '<link rel="shortcut icon" href="/f.ico">'), (2, "<p>x</p>"),
         (3, '<link rel="icon" href="https://cdn.c.com/i.png?v=2">')], "page_id long, html string")
    got = {r.candidate_id: r.website_icon_url for r in with_icons(sites, pages).collect()}
    assert got == {1: "http://a.com/f.ico", 2: "http://b.com/favicon.ico", 3: "https://cdn.c.com/i.png"}


def test_rendered_pages_lose_invalid_elements(spark):
    html = article('<div class="newsletter">Sign up for the storm newsletter</div><div class="card">Card</div>')
    df = spark.createDataFrame([("x", html, "en")], "name string, html string, site_lang string")
    as_of = F.lit("2024-06-01").cast("timestamp_ntz")
    got = extract(df, ["name"], as_of, js=True).first()
    assert got.article_content == f"Storm hits the coast {BODY}"
