"""The harvest: a batch of queue entries becomes article records and outcomes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import canonical_url, site_identity_with
from ..operators.author import verify_authors
from ..operators.joins import lookup, prefiltered, spread, stage
from ..operators.record import article_rows, extract
from ..operators.sites import check_sites, media_values, site_language
from ..sources.store import patched
from ..sources.tables import usable_pages
from ..vocab import (
    DONE, DUPLICATE_MESSAGE, ERROR, JS_ERROR_CREATOR, NO_SOURCE_MESSAGE, OUTCOME_DUPLICATE, OUTCOME_ERROR, OUTCOME_NO_CONTENT,
    OUTCOME_NO_TITLE, OUTCOME_NOT_ELIGIBLE, OUTCOME_SCRAPED,
)

CREATOR = "pressloom"


@dataclass
class Harvest:
    """Result of one batch: records to store and what happened to each entry."""

    articles: DataFrame
    outcomes: DataFrame
    media: DataFrame | None

    def link_updates(self, as_of: Column, js: bool = False) -> DataFrame:
        return status_updates(self.outcomes, as_of, js)

    def article_updates(self, as_of: Column) -> DataFrame:
        """Versions for the article log: what became of each stored article that was read
        again, with the fields that a new record has. An entry keeps the id, address and
        creation of its article."""
        fresh = self.articles.select("article_id", F.struct(*RECORD_FIELDS).alias("record"))
        states = article_states(self.outcomes, as_of)
        return states.join(fresh, "article_id", "left").select(*states.columns, "record")


def outcome_of(
    eligible: Column, duplicate: Column, failed: Column, content: Column, title: Column
) -> Column:
    """Outcome of an entry; the first reason that applies decides."""
    return (
        F.when(~eligible, F.lit(OUTCOME_NOT_ELIGIBLE))
        .when(duplicate, F.lit(OUTCOME_DUPLICATE))
        .when(failed, F.lit(OUTCOME_ERROR))
        .when(F.coalesce(content, F.lit("")) == "", F.lit(OUTCOME_NO_CONTENT))
        .when(F.coalesce(title, F.lit("")) == "", F.lit(OUTCOME_NO_TITLE))
        .otherwise(F.lit(OUTCOME_SCRAPED))
    )


def error_status(outcome: Column, detail: Column, js: bool = False) -> Column:
    """Message recorded with an entry that failed; in the rendered mode with one that is
    a duplicate as well."""
    repeated = F.when((outcome == OUTCOME_DUPLICATE) & F.lit(js), F.lit(DUPLICATE_MESSAGE))
    return F.coalesce(repeated, (
        F.when(outcome == OUTCOME_NOT_ELIGIBLE, F.lit("Unverified Website"))
        .when(outcome == OUTCOME_NO_CONTENT, F.lit("Invalid Content"))
        .when(outcome == OUTCOME_NO_TITLE, F.lit("Invalid article title"))
        .when(outcome == OUTCOME_ERROR, detail)
    ))


def status_updates(outcomes: DataFrame, as_of: Column, js: bool = False) -> DataFrame:
    """New status of each entry. Duplicates are done, but errors of the rendered
    mode, where errors also change the creator, except those of an empty record."""
    empty = F.col("outcome").isin(OUTCOME_NO_CONTENT, OUTCOME_NO_TITLE)
    done = [OUTCOME_SCRAPED] if js else [OUTCOME_SCRAPED, OUTCOME_DUPLICATE]
    is_done = F.col("outcome").isin(*done)
    return outcomes.select(
        "link_id",
        F.when(is_done, F.lit(DONE)).otherwise(F.lit(ERROR)).alias("status"),
        "error_status",
        (F.when(~is_done & ~empty, F.lit(JS_ERROR_CREATOR)) if js else F.lit(None).cast("string")).alias("created_by"),
        as_of.alias("date_updated"),
    )


#: Fields of an article that reading it again replaces.
RECORD_FIELDS = [
    "article_title", "article_section", "article_authors", "article_publish_date", "article_images",
    "article_content", "article_videos", "article_media_type", "article_ad_value", "article_pr_value",
    "article_language", "article_source_from", "keyword",
]


def article_states(outcomes: DataFrame, as_of: Column) -> DataFrame:
    """New state of each article that was read again: (article_id, article_status,
    article_error_status, date_updated). A repeated article has no state of its own for
    being one; its first reading counts."""
    done = F.col("outcome").isin(OUTCOME_SCRAPED, OUTCOME_DUPLICATE)
    return outcomes.select(
        F.col("link_id").alias("article_id"),
        F.when(done, F.lit(DONE)).otherwise(F.lit(ERROR)).alias("article_status"),
        F.col("error_status").alias("article_error_status"), as_of.alias("date_updated"))


def with_article_log(articles: DataFrame, log: DataFrame, editor: str = CREATOR) -> DataFrame:
    """The article table after the versions of a log: the newest state of each article,
    and the fields of its newest record. Fields that a record leaves null stay.

    ``log`` has the columns of ``Harvest.article_updates`` and may hold many versions of
    an article, as an append-only table does; each id is reduced to two rows before it is
    joined. Writing the result as the new table and starting an empty log compacts it.
    Versions of one time are ordered by their content, so the result does not depend on
    the order of arrival.
    """
    state = F.struct("date_updated", "article_status", "article_error_status")
    with_record = F.col("record").isNotNull()
    newest = log.groupBy("article_id").agg(
        F.max(state).alias("state"),
        F.max_by("record", F.when(with_record, F.struct("date_updated", F.xxhash64("record")))).alias("record"))
    patches = newest.select("article_id", "state.article_status", *[F.col(f"record.{c}").alias(c) for c in RECORD_FIELDS if c in articles.columns])
    out = patched(articles, patches, "article_id", None, editor)
    told = newest.select(
        "article_id", F.col("state.article_error_status").alias("__error"), F.col("state.date_updated").alias("__at"), F.lit(True).alias("__told"))
    joined = out.join(told, "article_id", "left")
    # A message goes when the article has been read without one.
    replaced = {"article_error_status": F.col("__error"), "date_updated": F.col("__at")}
    return joined.select(*[
        F.when(F.col("__told"), replaced[c]).otherwise(F.col(c)).alias(c) if c in replaced else F.col(c) for c in out.columns])


def tally(outcomes: DataFrame) -> DataFrame:
    """Number of entries per outcome."""
    return outcomes.groupBy("outcome").agg(F.count("*").alias("n"))


def raw_records(pages: DataFrame, as_of: Column, creator: str = CREATOR, js: bool = False) -> DataFrame:
    """Records of all pages: no eligibility, no duplicate check, nothing stored."""
    source = spread(usable_pages(pages).select("page_id", "url", "html"), "page_id").select(
        "page_id", canonical_url(F.col("url")).alias("page_url"), "html", F.lit("en").alias("site_lang")
    )
    fields = extract(source, ["page_id", "page_url"], as_of, js)
    return article_rows(fields, "page_id", F.col("page_url"), as_of, creator)


def map_pages(
    pages: DataFrame, function: Callable[[Iterator], Iterator], schema: str
) -> DataFrame:
    """Run a function of the caller over the pages in pandas batches."""
    return usable_pages(pages).mapInPandas(function, schema)


def pages_for(entries: DataFrame, pages: DataFrame) -> DataFrame:
    """Source of each distinct URL wanted; the page with the lowest id where a URL
    was crawled more than once. Entries with the same URL share one page.

    The page is chosen on URL and id alone, so that the source column is read once, and
    only where it is joined: a filter of the chosen ids drops the other pages in the scan.
    """
    wanted = stage(entries.select("url", "site_lang").distinct(), "wanted")
    urls = wanted.select("url").distinct()
    chosen = stage(
        lookup(prefiltered(pages.select("url", "page_id"), "url", urls), urls, "url", "left_semi", "page_id")
        .groupBy("url").agg(F.min("page_id").alias("page_id"))
        .join(wanted, "url"), "chosen",
    )
    span = chosen.agg(F.min("page_id").alias("low"), F.max("page_id").alias("high")).first()
    # The bounds reach the row groups of the table.
    source = pages.select("page_id", "html").where("html is not null and html <> ''").where(
        F.col("page_id").between(F.lit(span.low), F.lit(span.high)))
    return lookup(spread(prefiltered(source, "page_id", chosen), "page_id"), chosen, "page_id", "inner")


def harvest(
    links: DataFrame, pages: DataFrame, websites: DataFrame, articles: DataFrame,
    as_of: Column, creator: str = CREATOR, js: bool = False, check_duplicates: bool = True,
    suffixes: DataFrame | None = None, people: DataFrame | None = None,
) -> Harvest:
    """Harvest a batch of ``links(link_id, original_url)`` against the page table.

    Cheap tests come first: eligibility, then the duplicate check, and only the
    pages that are left are parsed. Entries with one canonical URL behave as if
    read in the order of their ids: the first that yields a record is stored, the
    later ones are duplicates. ``check_duplicates`` is off when the entries are
    stored articles that are read again. ``suffixes(suffix)`` are the public suffixes,
    by default ``PUBLIC_SUFFIXES``. ``people(name)`` are known names: where an article has
    some, they are its authors. ``media`` holds the input of the media-value formula for
    each record: its site's ranks and cost, its text and media (None if the registry has no
    ranks and costs).
    """
    url = F.col("original_url")
    queued = links.where("original_url is not null and original_url <> ''").select(
        "link_id", url.alias("url"), canonical_url(url).alias("article_url"),
    )
    entries = site_identity_with(queued, "url", suffixes).select("link_id", "url", "article_url", "site.fqdn")
    checked = check_sites(entries, websites, "link_id").select(
        "link_id", "url", "article_url", "is_eligible",
        (site_language(F.col("country")) if js else F.lit("en")).alias("site_lang"),
    )
    if check_duplicates:
        stored = (
            entries.select("article_url").distinct()
            .join(articles.select("article_url"), "article_url", "left_semi")
            .withColumn("is_stored", F.lit(True))
        )
        checked = lookup(checked, stored, "article_url", "left", "link_id")
    else:
        checked = checked.withColumn("is_stored", F.lit(None).cast("boolean"))
    checked = stage(checked, "entries")
    todo = checked.where("is_eligible and is_stored is null").select(
        "link_id", "url", "article_url", "site_lang"
    )

    read = stage(
        extract(pages_for(todo, pages), ["url"], as_of, js), "extracted"
    )
    verdict = read.select(
        "url", "error",
        F.coalesce(F.col("article_content"), F.lit("")).alias("content"),
        F.coalesce(F.col("article_title"), F.lit("")).alias("title"),
    ).select(
        "url", "error",
        F.substring("content", 1, 1).alias("content"), F.substring("title", 1, 1).alias("title"),
        F.lit(True).alias("is_read"),
    )
    tried = lookup(todo, verdict, "url", "left", "link_id").withColumn(
        "failed", F.col("is_read").isNull() | F.col("error").isNotNull()
    )
    good = tried.where("not failed and content <> '' and title <> ''")
    winners = good.groupBy("article_url").agg(F.min("link_id").alias("winner"))
    if not check_duplicates:
        winners = winners.withColumn("winner", F.lit(None).cast("bigint"))
    judged = lookup(tried, winners, "article_url", "left", "link_id").select(
        "link_id", "url", "article_url", "error",
        outcome_of(
            F.lit(True), F.coalesce(F.col("link_id") > F.col("winner"), F.lit(False)),
            F.col("failed"), F.col("content"), F.col("title"),
        ).alias("outcome"),
    )
    judged = stage(judged, "judged")

    def plain(df: DataFrame, outcome: str) -> DataFrame:
        return df.select("link_id", "url", "article_url", F.lit(None).cast("string").alias("error"),
                         F.lit(outcome).alias("outcome"))

    every = (
        plain(checked.where("not is_eligible"), OUTCOME_NOT_ELIGIBLE)
        .unionByName(plain(checked.where("is_eligible and is_stored"), OUTCOME_DUPLICATE))
        .unionByName(judged)
    )
    outcomes = every.select(
        "link_id", "url", "article_url", "outcome",
        error_status(F.col("outcome"), F.coalesce("error", F.lit(NO_SOURCE_MESSAGE if js else "no page source")), js).alias("error_status"),
    )
    scraped = judged.where(F.col("outcome") == OUTCOME_SCRAPED).select("link_id", "url", "article_url")
    own = lookup(scraped.withColumnRenamed("url", "__url"), read.withColumnRenamed("url", "__url"), "__url", "inner", "link_id")
    records = article_rows(own, "link_id", F.col("article_url"), as_of, creator)
    if people is not None:
        records = verify_authors(records, people, "article_id", "article_authors")
    media = None
    if {"alexa_rankings", "website_cost"} <= set(websites.columns):
        sites = entries.select(F.col("link_id").alias("article_id"), "fqdn")
        media = media_values(records.join(sites, "article_id").select(
            "article_id", "fqdn", F.col("article_content").alias("text"),
            F.col("article_images").alias("images"), F.col("article_videos").alias("videos")), websites, "article_id")
    return Harvest(records, outcomes, media)
