"""Article records from pages: all fields of one page in a single narrow stage."""

from __future__ import annotations

from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .author import author
from .content import candidate_lists, candidate_nodes, with_content
from .dom import parse_html
from .nodes import (
    alive, is_alive, marked_by, meta_entries, meta_value, page_language,
)
from .pubdate import block_date
from .title import clean_title, raw_title
from ..functions.columns import let, nonempty
from ..functions.dates import publish_date
from ..functions.text import normalize
from ..vocab import DONE, PAGE_DROP_TAGS, PAGE_INVALID_KEYS

MEDIA_TYPE = "web"


def empty_list() -> Column:
    return F.array().cast("array<string>")


def listed(value: Column) -> Column:
    """A list of the one value, empty where it is null."""
    return F.when(value.isNotNull(), F.array(value)).otherwise(empty_list())


def article_language(declared: Column) -> Column:
    return F.coalesce(nonempty(declared), F.lit("en"))


def meta_time(entries: Column) -> Column:
    """Publish time from the metadata, wall clock kept and zone dropped."""
    text = meta_value(entries, "article:published_time")
    clock = F.regexp_extract(text, r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2})?)?", 0)
    return nonempty(clock).try_cast("timestamp_ntz")


def without_invalid(dom: Column) -> Column:
    """Parsed page without the elements that rendered pages carry around the text. Their
    places stay, as elements without a name, so that a node is found at its number."""
    def pruned(living: Column) -> Column:
        nodes = F.transform(dom["nodes"], lambda n, i: F.when(F.get(living, i), n).otherwise(
            n.withField("tag", F.lit("")).withField("attrs", F.filter(n["attrs"], lambda _: F.lit(False)))))
        strings = F.transform(dom["strings"], lambda s: F.struct(
            s["node_id"].alias("node_id"),
            F.when(is_alive(living, s["node_id"]), s["text"]).otherwise("").alias("text")))
        return F.struct(nodes.alias("nodes"), strings.alias("strings"), dom["error"].alias("error"))

    return let(alive(dom["nodes"], lambda n: marked_by(n, PAGE_INVALID_KEYS)), pruned)


def _meta_fields(entries: Column, nodes: Column) -> Column:
    return F.struct(
        meta_value(entries, "og:title").alias("title"),
        meta_value(entries, "author").alias("author"),
        meta_time(entries).alias("published"),
        meta_value(entries, "og:image").alias("image"),
        meta_value(entries, "og:video").alias("video"),
        meta_value(entries, "og:description", "description").alias("text"),
        page_language(nodes, entries).alias("language"),
    )


@lru_cache(maxsize=4)
def _page_columns(_gateway) -> tuple[Column, ...]:
    """What is read from a page, as columns over ``dom`` and ``as_of``.

    The expressions are large and always the same, so they are built once.
    """
    dom = F.col("dom")
    return (
        dom["error"].alias("error"),
        let(meta_entries(dom["nodes"]), lambda m: _meta_fields(m, dom["nodes"])).alias("meta"),
        raw_title(dom).alias("raw_title"),
        author(dom).alias("author"),
        block_date(dom, F.col("as_of")).alias("block_date"),
        candidate_nodes(dom).alias("candidates"),
    )


def extract(pages: DataFrame, keys: list[str], as_of: Column, js: bool = False) -> DataFrame:
    """Fields of the article on each page of ``pages(*keys, html, site_lang)``.

    Columns: the keys, error, article_title, article_authors, article_publish_date,
    article_images, article_videos, article_language, article_content. No
    shuffle: one parse per page, array expressions, one Arrow step for the body.
    """
    parsed = pages.select(
        *keys, "site_lang", as_of.alias("as_of"), parse_html(F.col("html"), PAGE_DROP_TAGS).alias("dom")
    )
    if js:
        parsed = parsed.withColumn("dom", without_invalid(F.col("dom")))
    fields = parsed.select(
        *keys, "site_lang", "as_of", *_page_columns(SparkContext._gateway)
    ).select(
        *keys, "site_lang", "error", candidate_lists(F.col("candidates")).alias("candidates"),
        F.coalesce(nonempty(F.col("raw_title")), F.col("meta.title")).alias("headline"),
        listed(F.coalesce("author", "meta.author")).alias("article_authors"),
        publish_date(F.col("block_date"), F.col("meta.published"), F.col("as_of"))
        .alias("article_publish_date"),
        listed(F.col("meta.image")).alias("article_images"),
        listed(F.col("meta.video")).alias("article_videos"),
        article_language(F.col("meta.language")).alias("article_language"),
        F.col("meta.text").alias("meta_text"),
    )
    read = with_content(fields, headline="headline", lang="site_lang", out="body")
    body = F.col("body") if js else F.coalesce(nonempty(F.col("body")), F.col("meta_text"))
    return read.select(
        *keys, "error",
        clean_title(F.col("headline")).alias("article_title"),
        "article_authors", "article_publish_date", "article_images", "article_videos",
        "article_language",
        nonempty(normalize(body)).alias("article_content"),
    )


def article_rows(extracted: DataFrame, id_column: str, url: Column, as_of: Column, creator: str) -> DataFrame:
    """Rows of the article table."""
    null_text = F.lit(None).cast("string")
    return extracted.select(
        F.col(id_column).alias("article_id"),
        "article_title", empty_list().alias("article_section"), "article_authors",
        "article_publish_date", "article_images", "article_content", "article_videos",
        F.lit(MEDIA_TYPE).alias("article_media_type"),
        F.lit(0.0).alias("article_ad_value"), F.lit(0.0).alias("article_pr_value"),
        "article_language", F.lit(DONE).alias("article_status"),
        null_text.alias("article_error_status"), null_text.alias("article_source_from"),
        empty_list().alias("keyword"), url.alias("article_url"),
        as_of.alias("date_created"), as_of.alias("date_updated"),
        F.lit(creator).alias("created_by"), F.lit(creator).alias("updated_by"),
    )
