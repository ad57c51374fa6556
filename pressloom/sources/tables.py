"""Readers of pages, domain lists and word lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DOMAIN_LIST, PAGES
from ..vocab import KEYWORD_DICTIONARIES, LAZY_SITES, REMOVE_SITES, STOPWORDS

def read_urls(spark: SparkSession, path: str) -> DataFrame:
    """The page table for work on its URLs: the source column is there, but no
    filter touches it, so it is only read where it is selected."""
    return spark.read.schema(PAGES).parquet(path).where("url is not null and url <> ''")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Usable pages of a Parquet table: with URL and source."""
    return usable_pages(spark.read.schema(PAGES).parquet(path))


def usable_pages(pages: DataFrame) -> DataFrame:
    return pages.where("html is not null and html <> '' and url is not null and url <> ''")


def decode_page(body: Column, charset: Column | None = None) -> Column:
    """Text of a page body given as bytes; UTF-8 unless the charset column says
    otherwise."""
    if charset is None:
        return F.decode(body, "UTF-8")
    name = F.upper(F.trim(charset))
    return (
        F.when(name == "ISO-8859-1", F.decode(body, "ISO-8859-1"))
        .when(name == "US-ASCII", F.decode(body, "US-ASCII"))
        .when(name == "UTF-16", F.decode(body, "UTF-16"))
        .otherwise(F.decode(body, "UTF-8"))
    )


def read_domain_list(spark: SparkSession, path: str, field: str) -> DataFrame:
    """Domain list from a JSON file ``{field: [{name, domain}, ...]}``."""
    entry = "array<struct<name: string, domain: string>>"
    return (
        spark.read.schema(f"`{field}` {entry}").option("multiLine", True).json(path)
        .select(F.lit(field).alias("list"), F.explode(F.col(f"`{field}`")).alias("e"))
        .select("list", "e.name", "e.domain")
    )


def domain_lists(spark: SparkSession) -> DataFrame:
    """The shipped lists of sites to scroll before reading and of sites to skip."""
    rows = [("lazy-sites", n, d) for n, d in LAZY_SITES]
    rows += [("remove-sites", n, d) for n, d in REMOVE_SITES]
    return spark.createDataFrame(rows, DOMAIN_LIST)


def stopword_table(spark: SparkSession) -> DataFrame:
    rows = [(lang, word) for lang, words in STOPWORDS.items() for word in words]
    return spark.createDataFrame(rows, "lang string, word string")


def keyword_table(spark: SparkSession) -> DataFrame:
    rows = [
        (name, i, word)
        for name, words in KEYWORD_DICTIONARIES.items() for i, word in enumerate(words)
    ]
    return spark.createDataFrame(rows, "dict string, ord int, word string")
