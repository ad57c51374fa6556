"""Schemas of the harvest tables and of the parsed page."""

from __future__ import annotations

PAGES = "page_id bigint, url string, html string"

LINKS = (
    "link_id bigint, original_url string, status string, created_by string, "
    "date_created timestamp_ntz, date_updated timestamp_ntz"
)

ARTICLES = (
    "article_id bigint, article_title string, article_section array<string>, "
    "article_authors array<string>, article_publish_date timestamp_ntz, "
    "article_images array<string>, article_content string, article_videos array<string>, "
    "article_media_type string, article_ad_value double, article_pr_value double, "
    "article_language string, article_status string, article_error_status string, "
    "article_source_from string, keyword array<string>, article_url string, "
    "date_created timestamp_ntz, date_updated timestamp_ntz, created_by string, "
    "updated_by string"
)

WEBSITES = (
    "website_id bigint, website_name string, website_icon_url string, website_url string, "
    "website_cost double, website_type string, country string, country_code string, "
    "fqdn string, programming_language string, is_aggregator boolean, "
    "is_to_be_scraped boolean, alexa_rankings struct<global:bigint,local:bigint>, "
    "date_created timestamp_ntz, date_updated timestamp_ntz, created_by string, "
    "updated_by string"
)

LINK_STATUS = (
    "link_id bigint, status string, error_status string, created_by string, "
    "date_updated timestamp_ntz"
)

DOMAIN_LIST = "list string, name string, domain string"

#: One parsed page. ``nodes`` is in document order, so ``node_id`` is the index
#: of a node; its subtree is ``node_id .. end_id`` and the strings below it are
#: ``strings[s_from .. s_to)``; ``nodes[parent_id]`` is its parent.
DOM = (
    "struct<nodes: array<struct<"
    "node_id: int, parent_id: int, end_id: int, depth: int, s_from: int, s_to: int, "
    "tag: string, "
    "attrs: array<struct<name: string, is_list: boolean, values: array<string>>>>>, "
    "strings: array<struct<node_id: int, text: string>>, "
    "error: string>"
)
