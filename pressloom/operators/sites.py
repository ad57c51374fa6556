"""Operators on the site registry: eligibility, lists, identity, registration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import first_rows, lookup
from .nodes import attribute
from ..functions.columns import first_where, let, nonempty
from ..functions.urls import media_url
from ..vocab import (
    ELIGIBLE_COUNTRIES, EXCLUDED_FQDNS, FOREIGN_SITE_TYPE, LOCAL_COUNTRY, LOCAL_SITE_TYPE,
    NEW_SITE_COST, SITE_LANGUAGE, UNKNOWN_COUNTRY, UNKNOWN_COUNTRY_CODE,
)


def is_eligible(
    country: Column, is_aggregator: Column, fqdn: Column,
    countries: list[str] = ELIGIBLE_COUNTRIES, excluded: list[str] = EXCLUDED_FQDNS,
) -> Column:
    """Whether a registered site may be harvested."""
    return (
        F.coalesce(country.isin(*countries), F.lit(False))
        & ~F.coalesce(is_aggregator, F.lit(False))
        & ~F.coalesce(fqdn.isin(*excluded), F.lit(False))
    )


def is_flagged(is_to_be_scraped: Column) -> Column:
    """Eligibility by the flag of the registry alone (not used by default)."""
    return F.coalesce(is_to_be_scraped, F.lit(False))


def site_of(links: DataFrame, websites: DataFrame, columns: list[str], spread_by: str) -> DataFrame:
    """Add columns of the registered site with the same fqdn; the lowest id counts."""
    once = first_rows(websites, "fqdn", "website_id", columns)
    return lookup(links, once, "fqdn", "left", spread_by)


def check_sites(links: DataFrame, websites: DataFrame, spread_by: str) -> DataFrame:
    """Registry id, name and eligibility of the site of each link; unknown sites
    are not eligible."""
    known = site_of(links, websites, ["website_id", "website_name", "country", "is_aggregator"], spread_by)
    return known.withColumn(
        "is_eligible", is_eligible(F.col("country"), F.col("is_aggregator"), F.col("fqdn"))
    )


def matches_list(host: Column, domains: list[str]) -> Column:
    """Whether a host starts with a match of one of a list of patterns.

    One alternation per list: no join, however many rows.
    """
    if not domains:
        return F.lit(False)
    return host.rlike("^(?:" + "|".join(f"(?:{d})" for d in domains) + ")")


def listed_domains(lists: DataFrame, name: str) -> list[str]:
    """Patterns of one list. Domain lists are configuration of a few entries."""
    return [r[0] for r in lists.where(F.col("list") == name).select("domain").collect()]


def site_language(country: Column) -> Column:
    """Language in which a site of a country is read."""
    return F.when(country == LOCAL_COUNTRY, F.lit("tl")).otherwise(F.lit("en"))


def country_fields(country: Column, code: Column) -> Column:
    """Normalised country code and site type."""
    return F.struct(
        F.when(code == "US", F.lit("USA")).otherwise(code).alias("country_code"),
        F.when(country == LOCAL_COUNTRY, F.lit(LOCAL_SITE_TYPE))
        .otherwise(F.lit(FOREIGN_SITE_TYPE)).alias("website_type"),
    )


def country_override(
    country: Column, code: Column, site_country: Column, site_code: Column, ignore_local: bool = False
) -> Column:
    """Country and code to record for a site: the given ones, else the site's, else
    the unknown marks. ``ignore_local`` treats the local country as unknown."""
    new_country = F.coalesce(country, site_country, F.lit(UNKNOWN_COUNTRY))
    new_code = F.coalesce(code, site_code, F.lit(UNKNOWN_COUNTRY_CODE))
    if ignore_local:
        local = F.coalesce(site_country == LOCAL_COUNTRY, F.lit(False))
        new_country = F.when(local, F.lit(UNKNOWN_COUNTRY)).otherwise(new_country)
        new_code = F.when(local, F.lit(UNKNOWN_COUNTRY_CODE)).otherwise(new_code)
    return F.struct(new_country.alias("country"), new_code.alias("country_code"))


def icon_url(nodes: Column, website_url: Column) -> Column:
    """Icon link of a page, else the usual place on its site."""
    link = first_where(
        nodes,
        lambda n: (n["tag"] == "link") & F.exists(
            n["attrs"], lambda a: (a["name"] == "rel") & F.array_contains(a["values"], "icon")
        ),
    )
    def on_site(icon: Column) -> Column:
        return F.when(icon.startswith("/"), F.concat(website_url, icon)).otherwise(icon)

    return F.coalesce(
        let(media_url(nonempty(attribute(link, "href"))), on_site),
        F.concat(website_url, F.lit("/favicon.ico")),
    )


def existing_site(candidates: DataFrame, websites: DataFrame) -> DataFrame:
    """Add ``existing_id``: the registered site with the same name, else the same
    fqdn, else the same URL. The first of these that finds any site decides, and
    only if it finds exactly one."""
    out = candidates
    for key in ("website_name", "fqdn", "website_url"):
        found = websites.groupBy(key).agg(
            F.count("*").alias(f"n_{key}"), F.min("website_id").alias(f"id_{key}")
        )
        out = lookup(out, found, key, "left", "candidate_id")
    decided = F.lit(None).cast("bigint")
    for key in ("website_url", "fqdn", "website_name"):
        decided = F.when(
            F.col(f"n_{key}") > 0, F.when(F.col(f"n_{key}") == 1, F.col(f"id_{key}"))
        ).otherwise(decided)
    return out.withColumn("existing_id", decided).select(*candidates.columns, "existing_id")


def reconcile(candidates: DataFrame, websites: DataFrame) -> DataFrame:
    """Decide for each candidate site: ``INSERT``, ``UPDATE_FQDN`` or ``KEEP``."""
    stored = websites.select(
        F.col("website_id").alias("existing_id"),
        F.col("website_url").alias("stored_url"), F.col("fqdn").alias("stored_fqdn"),
    )
    joined = lookup(existing_site(candidates, websites), stored, "existing_id", "left", "candidate_id")
    same_url = F.col("stored_url") == F.col("website_url")
    same_fqdn = F.col("stored_fqdn") == F.col("fqdn")
    action = (
        F.when(F.col("existing_id").isNull() | (~same_url & ~same_fqdn), F.lit("INSERT"))
        .when(same_url & ~same_fqdn, F.lit("UPDATE_FQDN"))
        .otherwise(F.lit("KEEP"))
    )
    return joined.withColumn("action", action).select(*candidates.columns, "existing_id", "action")


def disambiguate(candidates: DataFrame, taken: DataFrame) -> DataFrame:
    """Give each new site a name of its own.

    The first site of a name keeps it unless the registry has it; the others put
    their subdomain before it; names that still collide get the words of their
    public suffix after them. First means lowest ``candidate_id``.
    """
    names = taken.select(F.col("website_name").alias("name")).distinct()

    def keepers(df: DataFrame, occupied: DataFrame) -> DataFrame:
        firsts = df.groupBy("name").agg(F.min("candidate_id").alias("candidate_id"))
        return firsts.join(occupied, "name", "left_anti").select(
            "candidate_id", F.lit(True).alias("keeps")
        )

    base = candidates.withColumn("name", F.col("website_name"))
    first = base.join(keepers(base.select("candidate_id", "name"), names), "candidate_id", "left")
    prefix = F.concat(F.upper(F.substring("subdomain", 1, 1)), F.lower(F.expr("substring(subdomain, 2)")))
    second = first.withColumn(
        "name",
        F.when(F.col("keeps") | F.col("subdomain").isin("", "www"), F.col("name"))
        .otherwise(F.concat(prefix, F.lit(" "), F.col("name"))),
    ).withColumnRenamed("keeps", "settled")
    open_names = second.where("settled is null").select("candidate_id", "name")
    occupied = names.union(second.where("settled").select("name"))
    third = second.join(keepers(open_names, occupied.distinct()), "candidate_id", "left")
    words = F.initcap(F.regexp_replace("tld", r"\.", " "))
    return third.withColumn(
        "website_name",
        F.when(F.coalesce("settled", "keeps", F.lit(False)), F.col("name"))
        .otherwise(F.rtrim(F.concat(F.col("name"), F.lit(" "), words))),
    ).select(*candidates.columns)


def new_site_rows(named: DataFrame, as_of: Column, creator: str) -> DataFrame:
    """Registry rows of new sites with their defaults."""
    return named.select(
        F.col("candidate_id").alias("website_id"),
        "website_name", "website_icon_url", "website_url",
        F.lit(NEW_SITE_COST).alias("website_cost"),
        F.lit(FOREIGN_SITE_TYPE).alias("website_type"),
        F.lit(UNKNOWN_COUNTRY).alias("country"),
        F.lit(UNKNOWN_COUNTRY_CODE).alias("country_code"),
        "fqdn", F.lit(SITE_LANGUAGE).alias("programming_language"),
        F.lit(None).cast("boolean").alias("is_aggregator"),
        F.lit(None).cast("boolean").alias("is_to_be_scraped"),
        F.lit(None).cast("struct<global:bigint,local:bigint>").alias("alexa_rankings"),
        as_of.alias("date_created"), as_of.alias("date_updated"),
        F.lit(creator).alias("created_by"), F.lit(creator).alias("updated_by"),
    )


def media_values(articles: DataFrame, websites: DataFrame, spread_by: str) -> DataFrame:
    """Input of the media-value formula: ranks and cost of the site (0 where it is
    unknown), text, images and videos of the article."""
    joined = site_of(articles, websites, ["alexa_rankings", "website_cost"], spread_by)
    return joined.select(
        spread_by,
        F.coalesce(F.col("alexa_rankings.global"), F.lit(0)).alias("global"),
        F.coalesce(F.col("alexa_rankings.local"), F.lit(0)).alias("local"),
        F.coalesce(F.col("website_cost"), F.lit(0.0)).alias("website_cost"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.coalesce(F.col("images"), F.array().cast("array<string>")).alias("images"),
        F.coalesce(F.col("videos"), F.array().cast("array<string>")).alias("videos"),
    )
