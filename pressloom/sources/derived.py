"""Queue, registry and store tables derived from a table of crawled pages.

The page tables at hand come without a crawl queue. These rules derive one, for
checks and benchmarks; each grows with the page table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import canonical_url, site_identity_with
from ..vocab import NEW_SITE_COST

CLOCK = "timestamp_ntz'2024-01-01 00:00:00'"


def links(pages: DataFrame) -> DataFrame:
    """Crawl queue: one link per page, some without URL, in mixed states."""
    created = F.expr(f"timestampadd(MINUTE, cast(page_id as int), {CLOCK})")
    return pages.select(
        F.col("page_id").alias("link_id"),
        F.expr("case when page_id % 17 <> 0 then url end").alias("original_url"),
        F.expr("case page_id % 5 when 2 then 'Processing@h1' when 3 then 'Done' "
               "when 4 then 'Error' else 'Queued' end").alias("status"),
        F.expr("case page_id % 4 when 2 then 'JS_link' when 3 then 'JS_lazy' "
               "else 'System' end").alias("created_by"),
        created.alias("date_created"),
        created.alias("date_updated"),
    )


def open_links(pages: DataFrame) -> DataFrame:
    """The same queue with every link still to do."""
    return links(pages).withColumn("status", F.lit("Queued")).where("original_url is not null")


def stored_articles(pages: DataFrame) -> DataFrame:
    """Articles harvested earlier: every sixth page."""
    created = F.expr(f"timestampadd(MINUTE, cast(page_id as int), {CLOCK})")
    return pages.where("page_id % 6 = 0").select(
        F.col("page_id").alias("article_id"),
        canonical_url(F.col("url")).alias("article_url"),
        F.expr("case page_id % 4 when 0 then 'Queued' when 2 then 'Done' else 'Error' end")
        .alias("article_status"),
        F.expr("case page_id % 3 when 0 then 'System' else 'JS_link' end").alias("created_by"),
        created.alias("date_created"),
    )


def site_pages(pages: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """Identity of the site of each page."""
    return site_identity_with(pages.select("page_id", "url"), "url", suffixes).select("page_id", "site.*")


def sites(pages: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """Distinct sites of a page table; the first page of a site gives its id."""
    return (
        site_pages(pages, suffixes).groupBy("fqdn")
        .agg(F.min_by(F.struct("page_id", "website_name", "website_url", "subdomain", "tld"),
                      F.col("page_id")).alias("r"))
        .select(F.col("r.page_id").alias("website_id"), "fqdn", "r.website_name",
                "r.website_url", "r.subdomain", "r.tld")
    )


def websites(pages: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """Site registry: all sites of the pages, with country, ranks and cost."""
    return sites(pages, suffixes).select(
        "website_id", "website_name",
        F.concat("website_url", F.lit("/favicon.ico")).alias("website_icon_url"),
        "website_url",
        F.lit(NEW_SITE_COST).alias("website_cost"),
        F.expr("case website_id % 3 when 0 then 'Philippines' when 1 then 'Singapore' "
               "else 'United States' end").alias("country"),
        "fqdn",
        (F.col("website_id") % 7 == 0).alias("is_aggregator"),
        F.struct((F.col("website_id") * 100).alias("global"),
                 (F.col("website_id") * 10).alias("local")).alias("alexa_rankings"),
    )


def fetch_log(pages: DataFrame) -> DataFrame:
    """Responses of the crawl: status code, content type and body bytes."""
    kind = F.expr("case page_id % 4 when 0 then 'text/html; charset=UTF-8' "
                  "when 1 then 'text/html' when 2 then 'application/json' end")
    return pages.select(
        "page_id", "url",
        F.expr("case page_id % 10 when 0 then 404 when 1 then 403 when 2 then null "
               "else 200 end").alias("status_code"),
        kind.alias("content_type"),
        F.encode("html", "UTF-8").alias("body"),
    )
