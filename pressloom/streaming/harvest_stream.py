"""The harvest as a stream of links.

What the harvest must remember from one batch to the next is keyed state: for each
canonical URL which links were read, when they were due, and whether an article of it is
stored. A batch looks up the keys it holds and no others, whatever came before it. URLs
are dealt to groups, each of which is one call of the state's Python function.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.urls import canonical_url
from ..operators.joins import stage
from ..plans.harvest import CREATOR, harvest
from ..schemas import LINKS
from ..sources.store import append_articles
from ..vocab import QUEUED

#: State store that holds its keys on disk, and reads and writes single ones.
STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER_SETTING = "spark.sql.streaming.stateStore.providerClass"
_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
#: A claim without a date comes before all dated ones.
_UNDATED = -(2 ** 63)


def link_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Waiting links that arrive as Parquet files."""
    return (
        spark.readStream.schema(LINKS).option("maxFilesPerTrigger", files_per_trigger)
        .parquet(path)
        .where((F.col("status") == QUEUED) & F.col("original_url").isNotNull())
    )


def settled_stream(spark: SparkSession, path: str) -> DataFrame:
    """Canonical URLs of which a batch has stored an article. Files that the state has
    taken in are removed, so listing them takes no longer as the stream grows older."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    return (
        spark.readStream.schema("article_url string").option("cleanSource", "delete")
        .option("recursiveFileLookup", "true").parquet(path)
    )


def claims(links: DataFrame) -> DataFrame:
    """Links as events of the state, with ``claimed_at``, when they last became due: at
    their last update, or at their creation, in microseconds."""
    due = F.coalesce("date_updated", "date_created")
    micros = F.coalesce(F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), due), F.lit(_UNDATED))
    return links.select(
        canonical_url(F.col("original_url")).alias("article_url"),
        "link_id", "original_url", micros.alias("claimed_at"))


ENTRIES = "link_id bigint, original_url string, article_url string, is_stored boolean"


#: Groups that URLs are dealt to. A call costs several milliseconds, a key in it one tenth
#: or less. The state of a checkpoint is dealt by it: it cannot change under one.
GROUPS = 1024


def group_of(url: Column) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(GROUPS))


class ReadState(StatefulProcessor):
    """State of one group of canonical URLs: the links of each with their last claims, and
    of which an article is stored.

    Nothing goes by its date: a link of any age is read when it arrives, a repeated
    delivery is not read again, and one that was put back into the queue is. Other links
    of the same URL go on, because each must get an outcome: the harvest marks them as
    duplicates, in one batch and across batches.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.stored = handle.getMapState("stored", "article_url string", "is_stored boolean")
        self.read = handle.getMapState("read", "article_url string, link_id bigint", "claimed_at bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest: dict[tuple[str, int], tuple[int, str]] = {}
        settled: set[str] = set()
        for part in rows:
            is_mark = part.link_id.isna()
            settled.update(part.article_url[is_mark])
            some = part[~is_mark]
            for page, link, url, claim in zip(some.article_url, some.link_id, some.original_url, some.claimed_at, strict=True):
                own = page, int(link)
                newest[own] = max(newest.get(own, (_UNDATED, url)), (int(claim), url))
        for page in settled:
            self.stored.updateValue((page,), (True,))
        known_stored: dict[str, bool] = dict.fromkeys(settled, True)
        fresh = []
        for (page, link), (claim, url) in newest.items():
            known = self.read.getValue((page, link)) if self.read.containsKey((page, link)) else None
            if known is None or claim > known[0]:
                self.read.updateValue((page, link), (claim,))
                if page not in known_stored:
                    known_stored[page] = self.stored.containsKey((page,))
                fresh.append((link, url, page, known_stored[page]))
        yield pd.DataFrame(fresh, columns=["link_id", "original_url", "article_url", "is_stored"])

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for page in initialState.article_url:
            self.stored.updateValue((page,), (True,))

    def close(self) -> None:
        pass


def unread(links: DataFrame, settled: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Entries of a stream of links that are to be read (``ENTRIES``).

    ``settled`` is the stream of URLs stored by this stream; ``stored(article_url)`` holds
    those stored before its first batch, which become state once.
    """
    entries = claims(links)
    nothing = {"link_id": "bigint", "original_url": "string", "claimed_at": "bigint"}
    marks = settled.select("article_url", *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()])
    group = group_of(F.col("article_url")).alias("group")
    first = None if stored is None else stored.select("article_url").where(
        "article_url is not null").distinct().select("article_url", group).groupBy("group")
    # Waiting batches have no timers; the output is what is due now.
    return entries.unionByName(marks).select("*", group).groupBy("group").transformWithStateInPandas(
        ReadState(), ENTRIES, "Append", "None", first)


def start_harvest(
    links: DataFrame, pages: DataFrame, websites: DataFrame, out: str, checkpoint: str,
    as_of: Callable[[], Column], creator: str = CREATOR, js: bool = False, suffixes: DataFrame | None = None,
    stored: DataFrame | None = None, interval: str = "0 seconds",
) -> StreamingQuery:
    """Run the harvest on each micro-batch of links until the query is stopped.

    Articles and link states go to ``out/articles`` and ``out/link_status``, one folder
    per batch, and the URLs stored to ``out/settled``, from where the next batch takes
    them into the state. A batch that is repeated after a failure starts from the state
    before it and overwrites its own folders. ``stored`` are articles from before the
    first batch. An empty queue is an empty batch.
    """
    spark = links.sparkSession
    folder = f"{out}/settled"
    waiting = unread(links, settled_stream(spark, folder), stored)

    def run(batch: DataFrame, batch_id: int) -> None:
        now = as_of()
        # The state is read and written once, here.
        entries = stage(batch, "batch")
        if entries.isEmpty():
            return
        known = entries.where("is_stored").select("article_url").distinct()
        result = harvest(
            entries.select("link_id", "original_url"), pages, websites, known, now, creator, js, suffixes=suffixes)
        append_articles(result.articles, f"{out}/articles", batch_id)
        result.link_updates(now, js).write.mode("overwrite").parquet(f"{out}/link_status/batch_id={batch_id}")
        articles = spark.read.parquet(f"{out}/articles/batch_id={batch_id}")
        # Last: from here on the batch counts as stored. Its files are listed after it ends.
        articles.select("article_url").write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    before = spark.conf.get(_PROVIDER_SETTING, None)
    spark.conf.set(_PROVIDER_SETTING, STATE_PROVIDER)
    try:
        # A query keeps the settings of its start.
        return (
            waiting.writeStream.foreachBatch(run)
            .option("checkpointLocation", checkpoint)
            .trigger(processingTime=interval)
            .start()
        )
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER_SETTING)
        else:
            spark.conf.set(_PROVIDER_SETTING, before)


def harvest_available(*args, **options) -> StreamingQuery:
    """Start a harvest, wait until all links at hand are read, and stop it."""
    query = start_harvest(*args, **options)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query
