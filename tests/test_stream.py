import os
from statistics import median

import pytest
from pyspark.sql import functions as F

from pressloom.schemas import LINKS
from pressloom.streaming import harvest_stream
from pressloom.streaming.harvest_stream import STATE_PROVIDER, link_stream, settled_stream, unread

T0 = "timestamp_ntz'2024-01-01 00:00:00'"


def links(spark, rows):
    """Rows (link, URL, minute it became due or None, minute it was put back or None)."""
    def due(minute):
        return F.expr(f"timestampadd(MINUTE, {minute}, {T0})")

    df = spark.createDataFrame(rows, "link_id long, original_url string, made int, again int")
    return df.select(
        "link_id", "original_url", F.lit("Queued").alias("status"), F.lit("System").alias("created_by"),
        due("made").alias("date_created"), due("again").alias("date_updated")).select(
        *[c.split()[0] for c in LINKS.split(", ")])


@pytest.fixture
def stream(spark, tmp_path):
    """Run the state over files of links; every URL in ``good`` is stored when it is read."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER)
    taken, seconds = [], []

    def run(files=(), good=(), stored=None):
        for rows in files:
            links(spark, rows).coalesce(1).write.mode("append").parquet(f"{tmp_path}/links")

        def write(batch, batch_id):
            rows = [tuple(r) for r in batch.collect()]
            taken.append((batch_id, sorted(rows)))
            if not rows:
                return
            urls = sorted({(r[2],) for r in rows if r[2] in good and not r[3]})
            spark.createDataFrame(urls, "article_url string").coalesce(1).write.mode("overwrite").parquet(
                f"{tmp_path}/settled/batch_id={batch_id}")

        query = (
            unread(link_stream(spark, f"{tmp_path}/links", 1), settled_stream(spark, f"{tmp_path}/settled"), stored)
            .writeStream.foreachBatch(write).option("checkpointLocation", f"{tmp_path}/checkpoint")
            .trigger(processingTime="0 seconds").start())
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        seconds.extend(p["durationMs"].get("addBatch", 0) for p in query.recentProgress if p["numInputRows"])
        return [r for _, rows in taken for r in rows]

    run.taken, run.seconds, run.path = taken, seconds, tmp_path
    yield run
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_state_of_links_and_urls(stream, spark):
    a, b, c, d = (f"http://x.com/{n}" for n in "abcd")
    stored = spark.createDataFrame([(d,), (None,), (d,)], "article_url string")
    got = stream([
        [(1, a, 1, None), (2, b, 2, None), (1, a, 1, None), (7, d, 1, None)],  # one delivered twice; one stored before
        [(1, a, 1, None), (3, a + "?q", 3, None), (4, b, 4, None)],           # delivered again; same URLs, later links
        [(1, a, 1, 90), (5, c, None, None), (5, c, None, None)],              # put back; without a date
        [(1, a, 1, 80), (5, c, None, None), (5, c, 5, None)],                 # an older claim; then with a date
    ], good={a}, stored=stored)
    assert sorted((r[0], r[2], r[3]) for r in got) == [
        (1, a, False), (1, a, True), (2, b, False), (3, a, True), (4, b, False), (5, c, False), (5, c, False), (7, d, True)]


def test_a_batch_that_is_repeated_gives_the_same(stream):
    url = "http://x.com/{}".format
    files = [[(i, url(i % 3), i, None) for i in range(k, k + 4)] for k in (0, 2, 4)]
    stream(files, good={url(0), url(1)})
    last, rows = next((n, rows) for n, rows in reversed(stream.taken) if rows)
    # As if the driver had died before it noted the end of the batch.
    commits = stream.path / "checkpoint" / "commits"
    for name in os.listdir(commits):
        number = name.strip(".").split(".")[0]
        if number.isdigit() and int(number) >= last:
            os.remove(commits / name)
    offsets = stream.path / "checkpoint" / "offsets"
    for name in os.listdir(offsets):
        number = name.strip(".").split(".")[0]
        if number.isdigit() and int(number) > last:
            os.remove(offsets / name)
    before = len(stream.taken)
    stream()
    repeated = [r for n, r in stream.taken[before:] if n == last]
    assert repeated == [rows]


def test_a_batch_takes_no_longer_after_many(stream):
    url = "http://x.com/{}".format
    stream([[(100 * k + i, url(100 * k + i), i, None) for i in range(20)] for k in range(16)])
    assert sum(len(rows) for _, rows in stream.taken) == 16 * 20
    assert len(stream.seconds) >= 16
    assert median(stream.seconds[-6:]) < 3 * median(stream.seconds[2:8]) + 500


def test_harvest_reads_no_earlier_output(spark, tmp_path, monkeypatch):
    """What a batch hands to the harvest as stored is made of its own entries only."""
    seen = []
    plain = harvest_stream.harvest

    def watched(entries, pages, websites, known, *args, **options):
        seen.append(known.inputFiles())
        return plain(entries, pages, websites, known, *args, **options)

    monkeypatch.setattr(harvest_stream, "harvest", watched)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    sites = spark.createDataFrame(
        [], "website_id long, fqdn string, website_name string, country string, is_aggregator boolean")
    for k in range(2):
        links(spark, [(k, f"http://x.com/{k}", k, None)]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/links")
    harvest_stream.harvest_available(
        link_stream(spark, f"{tmp_path}/links", 1), pages, sites, f"{tmp_path}/out", f"{tmp_path}/checkpoint",
        lambda: F.expr(T0))
    assert len(seen) == 2 and not any("/out/" in f for files in seen for f in files)
    assert spark.read.parquet(f"{tmp_path}/out/link_status").count() == 2
