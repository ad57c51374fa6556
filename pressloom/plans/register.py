"""Registration of the sites of crawled pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.dom import parse_html
from ..operators.joins import lookup, stage
from ..operators.sites import disambiguate, icon_url, new_site_rows, reconcile
from ..sources.derived import sites


def site_candidates(pages: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """Each site of the pages once, with the identity its first page gives."""
    return sites(pages, suffixes).withColumnRenamed("website_id", "candidate_id")


def with_icons(candidates: DataFrame, pages: DataFrame) -> DataFrame:
    """Add the icon of each site, read from its first page only."""
    first = lookup(
        pages.select(F.col("page_id").alias("candidate_id"), "html"),
        candidates, "candidate_id", "inner",
    )
    parsed = first.withColumn("dom", parse_html(F.col("html")))
    return parsed.select(
        *candidates.columns,
        icon_url(F.col("dom.nodes"), F.col("website_url")).alias("website_icon_url"),
    )


def register_sites(
    pages: DataFrame, websites: DataFrame, as_of: Column, creator: str, suffixes: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """New registry rows, and fqdn corrections ``(website_id, fqdn)`` of known sites.

    The candidates are staged, since naming refers to them several times and the
    page table should be read for them once.
    """
    candidates = stage(site_candidates(pages, suffixes), "candidates")
    decided = stage(reconcile(candidates, websites), "decided")
    new = decided.where("action = 'INSERT'").drop("existing_id", "action")
    inserts = new_site_rows(with_icons(disambiguate(new, websites), pages), as_of, creator)
    fixes = decided.where("action = 'UPDATE_FQDN'").groupBy("existing_id").agg(
        F.min_by("fqdn", "candidate_id").alias("fqdn")
    ).withColumnRenamed("existing_id", "website_id")
    return inserts, fixes
