import datetime

import pytest
from pyspark.sql import functions as F

from pressloom.functions.dates import date_mentions, is_quiet
from pressloom.operators import queue


@pytest.mark.parametrize("rows, parts", [(8, 3), (1, 3), (0, 3), (10, 10), (100, 7), (999, 16)])
def test_even_split(spark, rows, parts):
    df = spark.range(rows).select((F.col("id") * F.col("id")).alias("k")).repartition(3)
    got = sorted((r.k, r.part) for r in queue.even_split(df, "k", parts, slices=5).collect())
    base, extra = divmod(rows, parts)
    want = [p + 1 for p in range(parts) for _ in range(base + (p < extra))]
    assert [p for _, p in got] == want


def test_even_split_of_eight_into_three(spark):
    got = queue.even_split(spark.range(8), "id", 3).groupBy("part").count().orderBy("part").collect()
    assert [r["count"] for r in got] == [3, 3, 2]


def test_requeue_round_takes_the_lowest_ids(spark):
    rows = [(i, "Processing@h1" if i % 2 else "Processing", "System") for i in range(10)]
    links = spark.createDataFrame(rows, "link_id long, status string, created_by string")
    one = queue.requeued(links, queue.stale_link_query("h1"), "link_id", "status", cap=3)
    assert sorted(r.link_id for r in one.collect()) == [1, 3, 5]
    assert queue.requeued(links, queue.stale_link_query("h1"), "link_id", "status").count() == 5
    many = spark.range(30_000).select(F.col("id").alias("link_id"), F.lit("Processing@h1").alias("status"), F.lit("System").alias("created_by"))
    assert queue.requeued(many, queue.stale_link_query("h1"), "link_id", "status").count() == 30_000


def test_stale_articles(spark):
    rows = [(1, "Processing@h1", "System"), (2, "Processing", "me"), (3, "Processing@h2", "System"), (4, "Processing", "x")]
    df = spark.createDataFrame(rows, "article_id long, article_status string, created_by string")
    got = queue.requeued(df, queue.stale_article_query("h1", "me"), "article_id", "article_status")
    assert sorted(r.article_id for r in got.collect()) == [1, 2]


def test_quiet_hours_edges(spark):
    def at(h, m, s=0, us=0):
        return datetime.datetime(2024, 1, 1, h, m, s, us)

    cases = [
        (at(3, 0), False, False), (at(3, 0, 0, 1), True, False), (at(3, 29, 59), True, False),
        (at(3, 30), False, False), (at(6, 10), False, True), (at(21, 15), True, False),
        (at(23, 0), False, False), (at(23, 45), False, True), (at(0, 0), False, True),
        (at(0, 29), False, True), (at(0, 30), False, False), (at(9, 1), True, False), (at(12, 1), False, True),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, ts timestamp_ntz")
    got = df.orderBy("i").select(is_quiet(F.col("ts")), is_quiet(F.col("ts"), True)).collect()
    assert [tuple(r) for r in got] == [c[1:] for c in cases]


def test_date_mentions(spark):
    text = "On 2021-03-04, March 5th, 2021; 6 Apr. 2021 (7/8/2021) 2021-02-30 99/99/2021 Sept 9, 2021 at 10:30"
    got = spark.range(1).select(date_mentions(F.lit(text)).alias("d")).first().d
    assert [d.strftime("%Y-%m-%d") for d in got] == [
        "2021-03-04", "2021-03-05", "2021-04-06", "2021-07-08", "2021-09-09"
    ]
