"""One query per operator, each over whole tables of a test-data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom import vocab
from pressloom.functions import dates, similarity, suffix, text, urls
from pressloom.functions.columns import nonempty, strip
from pressloom.operators import author, content, nodes, pubdate, queue, record, sites, title
from pressloom.operators.dom import parse_html
from pressloom.operators.joins import new_folder, spread, stage
from pressloom.plans import harvest as plan
from pressloom.plans import register
from pressloom.sources import derived, store, tables
from pressloom.streaming import harvest_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: Time of the run, fixed so that results can be compared.
AS_OF = "2024-06-01 00:00:00"
SUFFIXES = ["com", "net", "org", "co.uk"]
LAZY_HOSTS = [r"m\."]
BLOCKED_HOSTS = [r"spam-farm\.example\.org$"]


def query(function):
    QUERIES[function.__name__] = function
    return function


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages with their source, for work on the markup."""
    return tables.read_pages(spark, f"{folder}/pages.parquet")


def crawl(spark: SparkSession, folder: str) -> DataFrame:
    """The page table for work on URLs; its source column stays unread."""
    return tables.read_urls(spark, f"{folder}/pages.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents").select("doc_id", "text", "lang"), "doc_id")


def parsed(spark: SparkSession, folder: str, drop=vocab.PAGE_DROP_TAGS) -> DataFrame:
    return spread(pages(spark, folder).select("page_id", "html"), "page_id").select(
        "page_id", parse_html(F.col("html"), drop).alias("dom")
    )


def bylined(spark: SparkSession, folder: str) -> DataFrame:
    """Pages with a byline and a date written into them, in four forms."""
    name = F.initcap(F.regexp_extract(F.split(urls.host(F.col("url")), r"\.")[0], r"^([a-z]+)", 1))
    day = F.expr("date_add(date'2020-01-01', cast(page_id % 1000 as int))")
    mark = F.expr("page_id % 4")
    line = (
        F.when(mark == 0, F.concat(
            F.lit('<span class="cse_author">By '), name, F.lit(" Cruz</span>"),
            F.lit('<time class="entry-date">'), F.date_format(day, "MMMM d, yyyy"), F.lit("</time>")))
        .when(mark == 1, F.concat(
            F.lit('<div class="comments"><span class="author">Nobody</span></div><p class="byline">'),
            name, F.lit(', <b>Santos</b></p><span id="pubdate">Posted '), day.cast("string"), F.lit("</span>")))
        .when(mark == 2, F.concat(
            F.lit('<a rel="author" href="/x">'), name, F.lit("</a><p class=\"template\">"),
            F.date_format(day, "d MMM yyyy"), F.lit("</p>")))
        .otherwise(F.lit('<div id="a-very-long-author-marker">Nobody</div><time class="date">2099-01-01</time>'))
    )
    return pages(spark, folder).select(
        "page_id", "url", F.replace(F.col("html"), F.lit("<article>"), F.concat(F.lit("<article>"), line)).alias("html")
    )


def bylined_dom(spark: SparkSession, folder: str) -> DataFrame:
    return spread(bylined(spark, folder).select("page_id", "html"), "page_id").select(
        "page_id", parse_html(F.col("html"), vocab.PAGE_DROP_TAGS).alias("dom")
    )


# --- urls and sites -----------------------------------------------------------


@query
def canonical_url(spark, folder):
    return crawl(spark, folder).select("page_id", urls.canonical_url(F.col("url")).alias("canonical_url"))


@query
def media_url_clean(spark, folder):
    links = F.filter("dom.nodes", lambda n: (n["tag"] == "a") & nodes.has_attribute(n, "href"))
    return (
        parsed(spark, folder)
        .select("page_id", F.posexplode(F.transform(links, lambda n: nodes.attribute(n, "href"))).alias("pos", "href"))
        .select("page_id", F.col("pos").cast("long").alias("pos"), "href",
                urls.media_url(F.col("href")).alias("link"))
    )


@query
def netloc(spark, folder):
    return crawl(spark, folder).select("page_id", urls.authority(F.col("url")).alias("netloc"))


@query
def site_identity(spark, folder):
    return derived.site_pages(crawl(spark, folder))


@query
def site_identity_suffix_table(spark, folder):
    suffixes = spark.createDataFrame([(s,) for s in SUFFIXES], "suffix string")
    found = urls.site_identity_with(crawl(spark, folder).select("page_id", "url"), "url", suffixes)
    return found.select("page_id", "site.*")


@query
def site_identity_national(spark, folder):
    """Identity of the sites if their hosts were those of the eligible countries."""
    found = crawl(spark, folder).select("page_id", F.regexp_replace(
        "url", F.lit(r"^(\w+://[^/:?#]*)\.(com|net|org)(?=[/:?#]|$)"),
        F.when(F.col("page_id") % 2 == 0, F.lit("$1.$2.ph")).otherwise(F.lit("$1.$2.sg"))).alias("url"))
    return derived.site_pages(found)


#: Rules with any label before a suffix, and exceptions to them.
SUFFIX_RULES = ["com", "jp", "*.ck", "!www.ck", "*.kobe.jp", "!city.kobe.jp", "ac.jp"]


@query
def public_suffix_rules(spark, folder):
    """Hosts of the pages under domains with such rules."""
    ends = F.array(*map(F.lit, ["ck", "www.ck", "x.kobe.jp", "city.kobe.jp", "ac.jp", "com"]))
    moved = crawl(spark, folder).select("page_id", F.concat_ws(
        ".", F.regexp_extract(urls.host(F.col("url")), r"^(.*)\.", 1), F.get(ends, (F.col("page_id") % 6).cast("int"))).alias("host"))
    hosts = moved.withColumn("host", F.when(F.col("page_id") % 10 == 3, F.regexp_extract("host", r"([^.]*\.[^.]*)$", 1)).otherwise(F.col("host")))
    return hosts.select("page_id", "host", suffix.public_suffix(F.col("host"), SUFFIX_RULES).alias("suffix"),
                        suffix.host_parts(F.col("host"), SUFFIX_RULES).alias("p")).select("page_id", "host", "suffix", "p.*")


@query
def site_name_disambiguation(spark, folder):
    found = stage(register.site_candidates(crawl(spark, folder)), "candidates")
    named = sites.disambiguate(found, found.where(F.lit(False)))
    return named.select("candidate_id", "fqdn", "website_name")


def _known_sites(spark, folder) -> DataFrame:
    """Registry of half the sites: own names, some with an outdated fqdn."""
    return derived.websites(crawl(spark, folder)).where("website_id % 2 = 0").select(
        "website_id",
        F.concat(F.lit("Site "), F.col("website_id")).alias("website_name"),
        "website_url",
        F.expr("case when website_id % 4 = 0 then concat('old.', fqdn) else fqdn end").alias("fqdn"),
    )


@query
def site_reconciliation(spark, folder):
    found = register.site_candidates(crawl(spark, folder))
    return sites.reconcile(found, _known_sites(spark, folder)).select(
        "candidate_id", "fqdn", "existing_id", "action"
    )


@query
def site_registry_insert(spark, folder):
    inserts, _ = register.register_sites(
        crawl(spark, folder), _known_sites(spark, folder), as_of(), plan.CREATOR
    )
    return inserts.select(
        "website_id", "website_name", "website_icon_url", "website_url", "website_cost",
        "website_type", "country", "country_code", "fqdn", "programming_language", "created_by",
    )


@query
def site_registry_fixes(spark, folder):
    _, fixes = register.register_sites(
        crawl(spark, folder), _known_sites(spark, folder), as_of(), plan.CREATOR
    )
    return fixes


@query
def site_eligibility(spark, folder):
    found = crawl(spark, folder)
    links = derived.site_pages(found).select(F.col("page_id").alias("link_id"), "fqdn")
    return sites.check_sites(links, derived.websites(found), "link_id").select(
        "link_id", "fqdn", "website_id", "is_eligible",
        sites.site_language(F.col("country")).alias("site_lang"),
    )


@query
def lazy_site_flag(spark, folder):
    listed = sites.listed_domains(tables.domain_lists(spark), "lazy-sites") + LAZY_HOSTS
    host = urls.authority(F.col("url"))
    return crawl(spark, folder).select(
        "page_id", host.alias("netloc"), sites.matches_list(host, listed).alias("is_lazy")
    )


@query
def blocklist_anti(spark, folder):
    listed = sites.listed_domains(tables.domain_lists(spark), "remove-sites") + BLOCKED_HOSTS
    return crawl(spark, folder).where(
        ~sites.matches_list(urls.authority(F.col("url")), listed)
    ).select("page_id", "url")


@query
def country_type(spark, folder):
    code = F.upper(F.substring("n_name", 1, 2))
    country = F.when(F.col("n_nationkey") % 5 == 0, F.lit("Philippines")).otherwise(F.initcap("n_name"))
    code = F.when(F.col("n_nationkey") == 24, F.lit("US")).when(F.col("n_nationkey") % 7 != 0, code)
    fields = sites.country_fields(country, code)
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").cast("long").alias("n_nationkey"),
        fields["country_code"].alias("country_code"), fields["website_type"].alias("website_type"),
    )


@query
def country_override(spark, folder):
    registry = derived.websites(crawl(spark, folder))
    given = F.expr("case when website_id % 4 = 0 then 'Japan' end")
    code = F.expr("case when website_id % 4 = 0 then 'JPN' end")
    known = F.expr("case when website_id % 5 <> 0 then country end")
    known_code = F.expr("case when website_id % 5 <> 0 then upper(substring(country, 1, 3)) end")
    plain = sites.country_override(given, code, known, known_code)
    ignoring = sites.country_override(given, code, known, known_code, ignore_local=True)
    return registry.select(
        "website_id",
        plain["country"].alias("country"), plain["country_code"].alias("country_code"),
        ignoring["country"].alias("country_ignoring"),
        ignoring["country_code"].alias("code_ignoring"),
    )


@query
def media_value_input(spark, folder):
    found = crawl(spark, folder)
    articles = derived.site_pages(found).select("page_id", "fqdn").join(
        found.select("page_id", F.expr("case when page_id % 3 <> 0 then url end").alias("text")), "page_id"
    ).withColumn("images", F.when(F.col("page_id") % 2 == 0, F.array("text"))).withColumn(
        "videos", F.lit(None).cast("array<string>")
    )
    registry = derived.websites(found).where("website_id % 3 <> 1")
    return sites.media_values(articles, registry, "page_id").select(
        "page_id", "global", "local", "website_cost", "text",
        F.size("images").cast("long").alias("n_images"), F.size("videos").cast("long").alias("n_videos"),
    )


# --- queue and stores -----------------------------------------------------------


@query
def url_duplicates(spark, folder):
    found = crawl(spark, folder)
    links = derived.links(found).where("original_url is not null").select(
        "link_id", urls.canonical_url(F.col("original_url")).alias("article_url")
    )
    return links.join(derived.stored_articles(found).select("article_url"), "article_url", "left_semi")


@query
def new_articles(spark, folder):
    found = crawl(spark, folder)
    new = found.select("page_id", urls.canonical_url(F.col("url")).alias("article_url"))
    return store.unique_inserts(new, derived.stored_articles(found), "article_url", "page_id")


@query
def find_links(spark, folder):
    return store.find(
        derived.links(crawl(spark, folder)), queue.link_queue_query(js=True), limit=None
    ).select("link_id", "original_url", "status", "created_by")


@query
def get_one_link(spark, folder):
    return store.get_one(derived.links(crawl(spark, folder)), "link_id", 42).select("link_id", "original_url")


@query
def get_one_website(spark, folder):
    return store.get_one(derived.websites(crawl(spark, folder)), "fqdn", "cheap-pills.example.com").select(
        "website_id", "fqdn", "country"
    )


@query
def count_links(spark, folder):
    return store.counts(derived.links(crawl(spark, folder)), {"status": "Error"})


@query
def count_websites(spark, folder):
    return store.counts(derived.websites(crawl(spark, folder)), {"country": "Atlantis"}, null_for_none=True)


@query
def queue_count_by_mode(spark, folder):
    found = crawl(spark, folder)
    return queue.queued_counts(derived.links(found), derived.stored_articles(found))


@query
def queue_view(spark, folder):
    found = crawl(spark, folder)
    return queue.link_view(derived.links(found)).withColumn("mode", F.lit("link")).unionByName(
        queue.article_view(derived.stored_articles(found)).withColumn("mode", F.lit("article"))
    )


@query
def claim_newest(spark, folder):
    batch = queue.claim_newest(derived.stored_articles(crawl(spark, folder)), 20)
    return queue.claimed(batch, "h1", "article_status").select("article_id", "article_url", "article_status")


@query
def split_batches(spark, folder):
    links = derived.links(crawl(spark, folder)).select("link_id")
    return queue.even_split(links, "link_id", 7).select("link_id", F.col("part").cast("long").alias("part"))


@query
def shuffle_queue(spark, folder):
    return queue.shuffled(derived.links(crawl(spark, folder)).select("link_id"), "link_id", 7)


@query
def requeue_stale(spark, folder):
    links = derived.links(crawl(spark, folder))
    return queue.requeued(links, queue.stale_link_query("h1"), "link_id", "status").select("link_id", "status")


@query
def patch_update(spark, folder):
    articles = derived.stored_articles(crawl(spark, folder)).withColumns({
        "date_updated": F.col("date_created"), "updated_by": F.lit(None).cast("string"),
    })
    patches = articles.where("article_id % 4 = 0").select(
        "article_id", F.lit("Done").alias("article_status"),
        F.expr("case when article_id % 8 = 0 then 'editor' end").alias("updated_by"),
    )
    out = store.patched(articles, patches, "article_id", as_of(), plan.CREATOR)
    return out.select(
        "article_id", "article_status", "updated_by",
        F.date_format("date_updated", "yyyy-MM-dd HH:mm:ss").alias("date_updated"),
    )


@query
def latest_status(spark, folder):
    log = derived.links(crawl(spark, folder)).select("link_id", "status", F.lit(1).alias("version"))
    log = log.unionByName(
        log.where("link_id % 3 = 0").select("link_id", F.lit("Done").alias("status"), F.lit(2).alias("version"))
    )
    return store.latest(log, "link_id", "version").select("link_id", "status")


@query
def quiet_hours(spark, folder):
    return table(spark, folder, "events").select(
        "event_id",
        dates.is_quiet(F.col("ts")).alias("links_quiet"),
        dates.is_quiet(F.col("ts"), for_article=True).alias("articles_quiet"),
    )


# --- similarity -----------------------------------------------------------------


@query
def trigram_similarity(spark, folder):
    label = F.explode(F.split(urls.host(F.col("url")), "[.-]"))
    values = crawl(spark, folder).select(label.alias("value")).distinct()
    words = vocab.CONTENT_KEYS + vocab.AUTHOR_KEYS + vocab.DATE_KEYS + ["example", "pills", "other"]
    hits = values.select("value", F.posexplode(similarity.similar_words(F.col("value"), words)).alias("rank", "h"))
    return hits.select(
        "value", F.col("rank").cast("long").alias("rank"), F.col("h.word").alias("word"),
        F.col("h.matches").cast("long").alias("matches"), F.col("h.similarity").cast("long").alias("similarity"),
    )


def _words(df: DataFrame, column: str, out: str) -> DataFrame:
    return df.select(F.explode(text.content_tokens(F.col(column), vocab.STOPWORDS_EN)).alias(out)).distinct()


@query
def trigram_similarity_join(spark, folder):
    values = _words(pages(spark, folder).select(F.regexp_extract("html", r"<title>(.*?)</title>", 1).alias("t")), "t", "value")
    words = _words(table(spark, folder, "benchmark"), "text", "word")
    return similarity.similarity_join(values, words).select(
        "value", "word", F.col("matches").cast("long").alias("matches"),
        F.col("similarity").cast("long").alias("similarity"),
    )


@query
def trigram_similarity_join_documents(spark, folder):
    """The words of all documents against those of the benchmark."""
    words = _words(table(spark, folder, "benchmark"), "text", "word")
    return similarity.similarity_join(_words(documents(spark, folder), "text", "value"), words).select(
        "value", "word", F.col("matches").cast("long").alias("matches"),
        F.col("similarity").cast("long").alias("similarity"),
    )


@query
def content_type_html(spark, folder):
    kind = F.col("content_type")
    return derived.fetch_log(crawl(spark, folder)).select(
        "page_id",
        F.when(kind.isNotNull(), F.coalesce(
            similarity.top_similarity(kind, vocab.HTML_CONTENT_TYPE) >= 50, F.lit(False)
        )).alias("is_html"),
    )


@query
def fetch_status_class(spark, folder):
    status = F.coalesce("status_code", F.lit(vocab.MISSING_RESPONSE_STATUS))
    return derived.fetch_log(crawl(spark, folder)).select(
        "page_id",
        F.when(status.isin(*vocab.ERROR_STATUS_CODES), F.lit("Error")).otherwise(F.lit("OK")).alias("fetch"),
    )


@query
def decode_bytes(spark, folder):
    return derived.fetch_log(pages(spark, folder)).select(
        "page_id", F.md5(tables.decode_page(F.col("body"))).alias("html_md5")
    )


# --- text -----------------------------------------------------------------------


@query
def transliterate(spark, folder):
    return documents(spark, folder).select("doc_id", text.transliterate(F.col("text")).alias("text"))


@query
def normalize_text(spark, folder):
    return documents(spark, folder).select("doc_id", text.normalize(F.col("text")).alias("text"))


@query
def tokens_no_stopwords(spark, folder):
    tokens = text.tokens_in(F.col("text"), F.col("lang"))
    return documents(spark, folder).select("doc_id", tokens.alias("t")).select(
        "doc_id", F.size("t").cast("long").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("tokens_md5")
    )


@query
def new_tokens(spark, folder):
    """Tokens of the rest of a document that its first line does not have."""
    head = text.content_tokens(F.regexp_extract("text", r"^([^\n]*)", 1), vocab.STOPWORDS_EN)
    rest = text.content_tokens(F.regexp_replace("text", r"^[^\n]*", ""), vocab.STOPWORDS_EN)
    return (
        documents(spark, folder).select("doc_id", text.new_tokens(rest, head).alias("n"))
        .select("doc_id", F.size("n").cast("long").alias("n_new"), F.md5(F.array_join("n", " ")).alias("new_md5"))
    )


@query
def string_block_quality(spark, folder):
    lines = F.filter(F.transform(F.split("text", "\n"), strip), lambda l: l != "")
    return (
        documents(spark, folder).select("doc_id", lines.alias("lines"))
        .select(
            "doc_id",
            F.size("lines").cast("long").alias("n_lines"),
            F.size(F.filter("lines", lambda l: F.length(l) >= 30)).cast("long").alias("n_long"),
            (content.has_long_string(F.col("lines")) | content.is_dense(F.col("lines"))).alias("is_admitted"),
        )
    )


def _order_texts(spark, folder) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    form = F.expr("o_orderkey % 11")

    def month(lang: str) -> Column:
        names = F.array(*[F.lit(n.split()[0].capitalize()) for n in vocab.MONTH_NAMES[lang]])
        return F.get(names, F.month(day) - 1)

    def said(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    number, year = F.dayofmonth(day), F.year(day)
    written = (
        F.when(form == 0, F.concat(F.lit("Posted on "), F.date_format(day, "MMMM d, yyyy"), F.lit(" by staff")))
        .when(form == 1, F.concat(F.lit("Updated "), F.date_format(day, "d MMM yyyy"), F.lit(", 10:30")))
        .when(form == 2, F.concat(F.lit("on "), F.date_format(day, "yyyy-MM-dd"), F.lit(".")))
        .when(form == 3, F.date_format(day, "M/d/yyyy"))
        .when(form == 4, F.concat(F.lit("2099-12-31, then "), F.date_format(day, "yyyy/M/d")))
        .when(form == 5, F.lit("Order 1234-99-99 has no date"))
        .when(form == 6, said("Publicado el ", number, " de ", month("es"), " de ", year, "."))
        .when(form == 7, said("le ", number, F.when(number == 1, "er").otherwise(""), " ", month("fr"), " ", year))
        .when(form == 8, said("am ", number, ". ", month("de"), " ", year, " um 10 Uhr"))
        .when(form == 9, said("ika-", number, " ng ", month("tl"), ", ", year))
        .otherwise(said("Noong ", month("tl"), " ", number, ", ", year, " sa Maynila"))
    )
    orders = spread(table(spark, folder, "orders").select("o_orderkey", "o_orderdate"), "o_orderkey")
    return orders.select("o_orderkey", day.alias("day"), written.alias("written"))


@query
def date_mentions(spark, folder):
    found = dates.first_date_before(F.col("written"), as_of())
    return _order_texts(spark, folder).select(
        "o_orderkey", F.size(dates.date_mentions(F.col("written"))).cast("long").alias("n_dates"),
        F.date_format(found, "yyyy-MM-dd").alias("first_date"),
    )


@query
def publish_date(spark, folder):
    orders = table(spark, folder, "orders")
    block = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate").cast("timestamp_ntz"))
    meta = F.when(F.col("o_orderkey") % 4 != 0, F.expr("cast(o_orderdate as timestamp_ntz) - interval 1 day"))
    return orders.select(
        "o_orderkey",
        F.date_format(dates.publish_date(block, meta, as_of()), "yyyy-MM-dd HH:mm:ss").alias("publish_date"),
    )


@query
def author_cap(spark, folder):
    first = F.regexp_extract("text", r"^(\S+)", 1)
    names = (
        table(spark, folder, "conversations").groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("turn", first.alias("name")))).alias("said"))
        .select("conv_id", F.transform("said", lambda s: s["name"]).alias("names"))
    )
    return names.select("conv_id", F.array_join(author.cap_authors(F.col("names")), "|").alias("authors"))


@query
def author_verification(spark, folder):
    first = F.regexp_extract("text", r"^(\S+)", 1)
    talk = table(spark, folder, "conversations").select("conv_id", "turn", first.alias("name"))
    records = talk.groupBy("conv_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("turn", "name"))), lambda s: s["name"]).alias("authors")
    )
    people = talk.where(F.length("name") > 4).select("name")
    return author.verify_authors(records, people, "conv_id", "authors").select(
        "conv_id", F.array_join("authors", "|").alias("authors")
    )


# --- nodes ----------------------------------------------------------------------


@query
def node_rows(spark, folder):
    found = nodes.node_table(parsed(spark, folder, drop=()))
    return found.select(
        "page_id", "node_id", "parent_id", "tag", "depth", "end_id",
        F.array_join("path", ".").alias("path"), F.to_json("attrs").alias("attrs"),
        F.array_join(F.transform("own_strings", lambda s: s["text"]), "|").alias("own"),
    )


@query
def tag_histogram(spark, folder):
    return nodes.tag_histogram(parsed(spark, folder, drop=()))


@query
def strip_tags(spark, folder):
    """Elements per page that are left without navigation, styles and scripts."""
    found = nodes.node_table(parsed(spark, folder, drop=()), lambda n: n["tag"].isin("nav", "style", "script"))
    return found.groupBy("page_id").agg(F.count("*").alias("n_nodes"), F.count_if(F.col("tag") == "a").alias("n_links"))


@query
def text_blocks(spark, folder):
    return nodes.text_blocks(parsed(spark, folder), ["article", "nav"]).select(
        "page_id", "tag", "n_strings", "n_links", "is_link_heavy", F.md5("text").alias("text_md5")
    )


@query
def link_density(spark, folder):
    found = nodes.text_blocks(parsed(spark, folder), ["body"])
    return found.select("page_id", "n_links", "is_link_heavy")


@query
def largest_block(spark, folder):
    found = nodes.largest_block(nodes.text_blocks(parsed(spark, folder), ["article", "div"]))
    return found.select("page_id", "tag", F.col("node_id").cast("long").alias("node_id"), "n_strings")


@query
def invalid_tag_prune(spark, folder):
    """Nodes of bylined pages that survive the removal of comment and footer elements."""
    keys = vocab.AUTHOR_COMMENT_KEYS + vocab.AUTHOR_FOOTER_KEYS
    marked = bylined_dom(spark, folder).withColumn(
        "doomed", nodes.subtree_roots(F.col("dom.nodes"), lambda n: nodes.marked_by(n, keys))
    )
    return marked.select(
        "page_id", F.size("doomed").cast("long").alias("n_removed"),
        F.size(F.filter("dom.nodes", lambda n: nodes.outside_all(n["node_id"], F.col("doomed")))).cast("long").alias("n_left"),
    )


@query
def page_language(spark, folder):
    dom = parsed(spark, folder).select("page_id", "dom", nodes.meta_entries(F.col("dom.nodes")).alias("meta"))
    declared = nodes.page_language(F.col("dom.nodes"), F.col("meta"))
    return dom.select("page_id", record.article_language(declared).alias("language"))


@query
def meta_map(spark, folder):
    found = parsed(spark, folder).select("page_id", nodes.meta_map(F.col("dom.nodes")).alias("meta"))
    return found.select(
        "page_id", F.size("meta").cast("long").alias("n_meta"), F.col("meta")["charset"].alias("charset")
    )


# --- extraction -----------------------------------------------------------------


def title_by_pattern(source: DataFrame) -> DataFrame:
    """Title without a parse: tags read by pattern, built-in functions only."""
    tag = nonempty(strip(text.unescape(F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1))))
    headings = F.concat(*[
        F.transform(
            F.regexp_extract_all("html", F.lit(rf"(?s)<{h}[^>]*>(.*?)</{h}>"), F.lit(1)),
            lambda t: strip(text.unescape(F.regexp_replace(t, r"<[^>]*>", " "))),
        )
        for h in vocab.TITLE_TAGS
    ])
    return source.select(
        "page_id", "url", headings.alias("headings"), tag.alias("tag")
    ).select("page_id", "url", title.clean_title(title.choose_title(F.col("headings"), F.col("tag"))).alias("title"))


@query
def page_identity(spark, folder):
    """Canonical URL, site and title of every page."""
    found = title_by_pattern(pages(spark, folder))
    return found.select(
        "page_id", urls.canonical_url(F.col("url")).alias("url"),
        urls.site_identity(F.col("url"))["fqdn"].alias("fqdn"), "title",
    )


@query
def extract_title(spark, folder):
    return parsed(spark, folder).select("page_id", title.clean_title(title.raw_title(F.col("dom"))).alias("title"))


@query
def extract_author(spark, folder):
    return bylined_dom(spark, folder).select("page_id", author.author(F.col("dom")).alias("author"))


@query
def extract_date(spark, folder):
    return bylined_dom(spark, folder).select(
        "page_id", F.date_format(pubdate.block_date(F.col("dom"), as_of()), "yyyy-MM-dd").alias("published")
    )


@query
def candidate_lists(spark, folder):
    found = parsed(spark, folder).select("page_id", content.candidate_nodes(F.col("dom")).alias("c")).select(
        "page_id", content.candidate_lists(F.col("c")).alias("c"))
    def count(lists: Column) -> Column:
        return F.when(lists.isNotNull(), F.size(lists).cast("long"))

    return found.select("page_id", count(F.col("c.first")).alias("n_first"), count(F.col("c.second")).alias("n_second"))


@query
def extract_content(spark, folder):
    found = plan.raw_records(pages(spark, folder), as_of())
    return found.select(F.col("article_id").alias("page_id"), F.col("article_content").alias("content"))


@query
def news_record(spark, folder):
    found = plan.raw_records(pages(spark, folder), as_of())
    return found.select(
        "article_id", "article_title", "article_url", "article_language", "article_media_type",
        F.array_join("article_authors", "|").alias("authors"),
        F.date_format("article_publish_date", "yyyy-MM-dd HH:mm:ss").alias("published"),
        F.size("article_images").cast("long").alias("n_images"),
        F.size("article_videos").cast("long").alias("n_videos"),
        "article_ad_value", "article_pr_value", "article_status", "created_by",
        F.md5(F.coalesce("article_content", F.lit(""))).alias("content_md5"),
    )


@query
def rendered_record(spark, folder):
    """Records of bylined pages in the rendered mode."""
    found = plan.raw_records(bylined(spark, folder), as_of(), js=True)
    return found.select(
        "article_id", "article_title", F.array_join("article_authors", "|").alias("authors"),
        F.date_format("article_publish_date", "yyyy-MM-dd").alias("published"),
        F.length("article_content").cast("long").alias("n_chars"),
    )


def _harvest(spark, folder, js=False) -> plan.Harvest:
    found = crawl(spark, folder)
    return plan.harvest(
        derived.open_links(found), found, derived.websites(found), derived.stored_articles(found),
        as_of(), js=js,
    )


@query
def harvest(spark, folder):
    return _harvest(spark, folder).outcomes.select("link_id", "article_url", "outcome", "error_status")


@query
def harvest_articles(spark, folder):
    return _harvest(spark, folder).articles.select(
        "article_id", "article_url", "article_title", "article_language",
        F.md5("article_content").alias("content_md5"),
    )


@query
def outcome_tally(spark, folder):
    return plan.tally(_harvest(spark, folder).outcomes)


@query
def link_status_updates(spark, folder):
    return _harvest(spark, folder, js=True).link_updates(as_of(), js=True).select(
        "link_id", "status", "error_status", "created_by"
    )


@query
def stored_article_reread(spark, folder):
    """Harvest of stored articles: their own URLs, no duplicate check."""
    found = crawl(spark, folder)
    entries = queue.article_view(derived.stored_articles(found)).select(
        F.col("id").alias("link_id"), F.col("url").alias("original_url")
    )
    by_own_url = found.withColumn("url", urls.canonical_url(F.col("url")))
    again = plan.harvest(
        entries, by_own_url, derived.websites(found), derived.stored_articles(found), as_of(),
        check_duplicates=False,
    )
    return again.outcomes.select("link_id", "outcome")


@query
def harvest_media(spark, folder):
    """Input of the media-value formula for each article harvested."""
    return _harvest(spark, folder).media.select("article_id", "global", "local", "website_cost", F.md5("text").alias("text_md5"))


def faulty(found: DataFrame) -> DataFrame:
    """Pages of which some have lost their title, their text or their source."""
    fault = F.col("page_id") % 11
    return found.withColumn("html", F.when(fault == 1, F.lit(
        '<html><head><meta name="description" content="Words of a page"></head><body><p>x</p></body></html>')).when(
        fault == 2, F.lit("<html><head><title>Only a title</title></head><body></body></html>")).when(
        fault != 3, F.col("html")))


@query
def article_status_updates(spark, folder):
    """Stored articles after a log of two readings: an earlier one that failed, and one
    with all outcomes that reading an article again has."""
    found = crawl(spark, folder)
    stored = derived.stored_articles(found).withColumns({
        "article_error_status": F.lit("before"), "article_title": F.lit("old title"), "date_updated": F.col("date_created"),
        "updated_by": F.lit("before"),
    })
    entries = queue.article_view(stored).select(F.col("id").alias("link_id"), F.col("url").alias("original_url"))
    again = plan.harvest(
        entries, faulty(found.withColumn("url", urls.canonical_url(F.col("url")))), derived.websites(found), stored, as_of(),
        check_duplicates=False)
    log = again.article_updates(as_of())
    failed = log.where("article_id % 4 = 0").select(
        "article_id", F.lit("Error").alias("article_status"), F.lit("timeout").alias("article_error_status"),
        F.lit("2024-05-01 00:00:00").cast("timestamp_ntz").alias("date_updated"), F.lit(None).cast(log.schema["record"].dataType).alias("record"))
    out = plan.with_article_log(stored, log.unionByName(failed))
    return out.select("article_id", "article_url", "article_status", "article_error_status", "article_title", "updated_by",
                      F.date_format("date_updated", "yyyy-MM-dd").alias("updated"))


@query
def harvest_outcomes(spark, folder):
    """Links over pages with faults: every outcome there is."""
    found = crawl(spark, folder)
    out = plan.harvest(derived.open_links(found), faulty(found), derived.websites(found), derived.stored_articles(found), as_of())
    return out.outcomes.select("link_id", "outcome", "error_status")


@query
def mapped_pages(spark, folder):
    """A function of the caller run over the pages in batches."""
    def measure(batches):
        for batch in batches:
            yield batch.assign(n_chars=batch["html"].str.len())[["page_id", "n_chars"]]

    return plan.map_pages(pages(spark, folder).select("page_id", "url", "html"), measure, "page_id long, n_chars long")


@query
def stream_harvest(spark, folder):
    """Outcomes of the queue read as a stream of files."""
    found = crawl(spark, folder)
    queue_folder = new_folder(spark, "links")
    # Files in order of the ids, the newest links first: later files hold older dates.
    # Then some links once more as they were, and some that were put back.
    links = derived.open_links(found).withColumn(
        "date_created", F.expr("timestampadd(HOUR, -cast(link_id as int), timestamp_ntz'2024-03-01 00:00:00')"))
    numbered = queue.even_split(links, "link_id", 4)
    requeued = links.where("link_id % 10 = 3").withColumn("date_updated", F.expr("timestamp_ntz'2024-06-01 00:00:00'"))
    files = [numbered.where(F.col("part") == k).drop("part") for k in (1, 2, 3, 4)]
    for rows in [*files, links.where("link_id % 10 = 1"), requeued]:
        rows.write.mode("append").parquet(queue_folder)
    out = f"{queue_folder}-out"
    files_each = max(1, len(spark.read.parquet(queue_folder).inputFiles()) // 6)
    harvest_stream.harvest_available(
        harvest_stream.link_stream(spark, queue_folder, files_per_trigger=files_each),
        # A registry is a table; each batch reads it again.
        found, stage(derived.websites(found), "websites"), out, f"{queue_folder}-checkpoint", as_of,
    )
    return spark.read.parquet(f"{out}/link_status").select("link_id", "status", "error_status")
