"""Operators on the crawl queue: claim, split, recovery, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import stage
from ..sources.store import find, predicate
from ..vocab import JS_CREATORS, PROCESSING, QUEUED, SYSTEM_CREATOR


def link_view(links: DataFrame) -> DataFrame:
    """Links in the common shape of queue entries."""
    return links.select(F.col("link_id").alias("id"), F.col("original_url").alias("url"), "status")


def article_view(articles: DataFrame) -> DataFrame:
    """Articles to be read again in the common shape of queue entries."""
    return articles.select(
        F.col("article_id").alias("id"), F.col("article_url").alias("url"),
        F.col("article_status").alias("status"),
    )


def link_queue_query(js: bool = False) -> dict:
    creator = {"$in": JS_CREATORS} if js else SYSTEM_CREATOR
    return {"status": QUEUED, "created_by": creator, "original_url": {"$ne": None}}


def article_queue_query(js: bool = False, pipeline: str | None = None) -> dict:
    creators = JS_CREATORS if js else [SYSTEM_CREATOR] + ([pipeline] if pipeline else [])
    return {
        "$query": {"article_status": QUEUED, "created_by": {"$in": creators}},
        "$orderby": {"date_created": -1},
    }


def queued_counts(links: DataFrame, articles: DataFrame) -> DataFrame:
    """Number of waiting links and articles in each mode, in one pass per table."""
    def count(df: DataFrame, mode: str, query: dict) -> Column:
        return F.count_if(predicate(query)).alias(mode)

    link_counts = links.agg(
        count(links, "static_link", link_queue_query()),
        count(links, "js_link", link_queue_query(js=True)),
    )
    article_counts = articles.agg(
        count(articles, "static_article",
              {"article_status": QUEUED, "created_by": SYSTEM_CREATOR}),
        count(articles, "js_article", article_queue_query(js=True)["$query"]),
    )
    def tall(df: DataFrame) -> DataFrame:
        return df.unpivot([], df.columns, "mode", "n")

    return tall(link_counts).unionByName(tall(article_counts))


def claim_newest(articles: DataFrame, limit: int, js: bool = False, pipeline: str | None = None) -> DataFrame:
    """Newest waiting articles, up to the size of one batch."""
    return find(articles, article_queue_query(js, pipeline), limit, tiebreak="article_id")


def claimed(batch: DataFrame, host: str, status: str = "status") -> DataFrame:
    """The batch marked as being processed on a host."""
    return batch.withColumn(status, F.lit(f"{PROCESSING}@{host}"))


def shuffled(batch: DataFrame, id_column: str, seed: int) -> DataFrame:
    """The batch in a random order that a seed fixes."""
    return batch.orderBy(F.xxhash64(F.col(id_column), F.lit(seed)), id_column)


def numbered(df: DataFrame, key: str, slices: int | None = None) -> DataFrame:
    """Add ``rank``, the place of each row from 0 in the order of a unique key, and
    ``total``, the number of rows.

    Rows are dealt to ranges of the key, ``slices`` of them or one for each shuffle
    partition or core; a range is ranked by itself on top of the rows
    in the ranges before it. Those offsets are a table of one row per range.
    """
    spark = df.sparkSession
    ranges = slices or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dealt = stage(df.repartitionByRange(ranges, key).withColumn("__range", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("__range").agg(F.count("*").alias("__size"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__range", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"),
        F.sum("__size").over(Window.partitionBy()).alias("total"))
    within = F.row_number().over(Window.partitionBy("__range").orderBy(key)) - 1
    return dealt.withColumn("__place", within).join(offsets, "__range").select(
        *df.columns, (F.col("__before") + F.col("__place")).alias("rank"), "total")


def even_split(df: DataFrame, key: str, parts: int, slices: int | None = None) -> DataFrame:
    """Number the rows by a unique key and split them evenly: the parts differ by one row
    at most and the first ones get the extra rows. The result of ``ntile`` without its
    single task."""
    base, extra = F.floor(F.col("total") / parts), F.col("total") % parts
    wide = extra * (base + 1)
    part = F.when(F.col("rank") < wide, F.floor(F.col("rank") / (base + 1))).otherwise(
        extra + F.floor((F.col("rank") - wide) / F.greatest(base, F.lit(1))))
    return numbered(df, key, slices).withColumn("part", part.cast("int") + 1).drop("rank", "total")


def stale_link_query(host: str) -> dict:
    return {"status": f"{PROCESSING}@{host}", "created_by": SYSTEM_CREATOR}


def stale_article_query(host: str, pipeline: str | None = None) -> dict:
    creators = [SYSTEM_CREATOR] + ([pipeline] if pipeline else [])
    return {
        "article_status": {"$in": [f"{PROCESSING}@{host}", PROCESSING]},
        "created_by": {"$in": creators},
    }


def requeued(
    table: DataFrame, query: dict, id_column: str, status: str,
    older_than: Column | None = None, cap: int | None = None,
) -> DataFrame:
    """Unfinished claims that go back to the queue: all of them, or those of one round
    of up to ``cap``, lowest ids first."""
    stale = table.where(predicate(query))
    if older_than is not None:
        stale = stale.where(F.col("date_updated") < older_than)
    if cap is not None:
        stale = stale.orderBy(id_column).limit(cap)
    return stale.withColumn(status, F.lit(QUEUED))
