"""Resampling documents towards a target distribution: hashed features scored by an array
of gains, noise that makes the highest scores a weighted draw, and exact ranks by a
parallel sort with regular sampling."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import chain
from string import ascii_lowercase, ascii_uppercase, digits
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import spread, stage

BUCKETS, PERCENT, LEAST_WORDS, SEED = 10_000, 10, 20, "2024"
#: Most runs and segments of a sort; their square bounds the samples on the driver.
MOST_SEGMENTS = 1_000
#: Words are runs of ASCII letters and digits and of characters beyond ASCII; A-Z become small.
_LETTERS = bytes(c + 32 if chr(c) in ascii_uppercase else c if c > 127 or chr(c) in ascii_lowercase + digits else 32 for c in range(256))


def feature_words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8, A-Z as small letters; none for a null text."""
    return text.encode("utf-8", "surrogatepass").translate(_LETTERS).split() if text else []


def feature_buckets(words: list[bytes], longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Bucket of every run of 1 to ``longest`` consecutive words."""
    runs = [words] + [
        [b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] for size in range(2, longest + 1)]
    features = chain.from_iterable(runs)
    return (np.fromiter(map(crc32, features), np.uint32) % np.uint32(buckets)).astype(np.int64)


def _counted(longest: int, buckets: int) -> Callable:
    """How often each bucket occurs in a partition: at most one row a bucket."""
    def run(batches):
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                counts += np.bincount(feature_buckets(feature_words(text.as_py()), longest, buckets), minlength=buckets)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(found.astype(np.int32)), "count": pa.array(counts[found])})

    return run


def bucket_gains(raw: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> list[int]:
    """Thousandfold log ratio of each bucket's smoothed share in ``target`` and ``raw``.

    Both have a column ``text``. The result is one number a bucket, however many
    documents there are.
    """
    def counts(df: DataFrame, name: str) -> DataFrame:
        found = df.select("text").mapInArrow(_counted(longest, buckets), "bucket int, count long")
        return found.groupBy("bucket").agg(F.sum("count").alias(name))

    found = stage(counts(raw, "s").join(counts(target, "t"), "bucket", "full"), "bucket-counts")
    sums = found.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("s"), F.coalesce(F.sum("t"), F.lit(0)).alias("t")).first()
    s, t = F.coalesce("s", F.lit(0)), F.coalesce("t", F.lit(0))
    ratio = ((t + 1) * F.lit(sums.s + buckets)).cast("double") / ((s + 1) * F.lit(sums.t + buckets)).cast("double")
    every = raw.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    rows = every.join(found, "bucket", "left").select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))
    return [r.gain for r in rows.orderBy("bucket").collect()]


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """Thousandfold Gumbel noise of a document, from a hash of its id (null: empty)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def _weighed(gains: np.ndarray, longest: int) -> Callable:
    """Numbers of words and features and the floored mean gain of each text."""
    def run(batches):
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                words = feature_words(text.as_py())
                found = feature_buckets(words, longest, len(gains))
                rows.append((len(words), len(found), int(gains[found].sum()) // max(1, len(found))))
            columns = zip(*rows, strict=True) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)],
                names=["doc_id", "n_words", "n_features", "weight"])

    return run


def scored(
    docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS, seed: str = SEED
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight`` and ``score`` of each document.

    One pass over the texts counts buckets, a second one looks each feature up in the
    array of gains; nothing of the texts is written or shuffled.
    """
    texts = spread(docs.select("doc_id", "text"), "doc_id")
    gains = np.array(bucket_gains(texts, target, longest, buckets), np.int64)
    kind = docs.schema["doc_id"].dataType.simpleString()
    weighed = texts.mapInArrow(_weighed(gains, longest), f"doc_id {kind}, n_words long, n_features long, weight long")
    return weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def _segments(order: list[tuple], names: list[str]) -> Callable:
    """Number the rows of locally sorted batches by the splitters before them."""
    def key(batch: pa.RecordBatch, i: int) -> tuple:
        return tuple(batch.column(c)[i].as_py() for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            first = bisect_left(order, key(batch, 0))
            last = bisect_left(order, key(batch, batch.num_rows - 1))
            cuts = [bisect_left(range(batch.num_rows), True, key=lambda i, s=s: key(batch, i) > s) for s in order[first:last]]
            sizes = np.diff([0, *cuts, batch.num_rows])
            segment = np.repeat(np.arange(first, last + 1, dtype=np.int32), sizes)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segment)], names=[*batch.schema.names, "__segment"])

    return run


def ranked(df: DataFrame, keys: list[Column], out: str = "rank", segments: int | None = None) -> DataFrame:
    """Add ``out``: the place of each row, from 1, in ascending order of ``keys``.

    ``keys`` are whole numbers without nulls. The table is cut into runs, each sorted in
    place and written. Every run gives as many rows at regular distances as there are
    segments; these, at most ``MOST_SEGMENTS`` squared, give the splitters. Rows go to the
    segment their key falls in and are merged there by a local sort; the places within a
    segment follow those of the segments before it. The run and the place in it end each
    key, so no two rows have equal keys, and a segment holds at most about twice its share
    however many rows agree. Equal rows have an arbitrary order.
    """
    spark: SparkSession = df.sparkSession
    if segments is None:
        segments = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    segments = max(1, min(segments, MOST_SEGMENTS))
    names = [f"__key{i}" for i in range(len(keys))]
    keyed = stage(df.select("*", *[k.cast("long").alias(n) for k, n in zip(keys, names, strict=True)]), "keyed")
    runs = stage(
        keyed.coalesce(segments).sortWithinPartitions(*names).select(
            "*", F.spark_partition_id().alias("__run"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("__place")), "runs")
    sizes = runs.groupBy("__run").agg(F.count("*").alias("__size"))
    step = F.greatest(F.lit(1), F.ceil(F.col("__size") / segments))
    whole = [*names, "__run", "__place"]
    picked = runs.select(*whole).join(F.broadcast(sizes), "__run").filter(F.col("__place") % step == 0)
    samples = sorted(tuple(r) for r in picked.select(*whole).collect())
    every = max(1, -(-len(samples) // segments))
    splitters = samples[every::every]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in runs.schema.fields)
    dealt = runs.mapInArrow(_segments(splitters, whole), f"{types}, __segment int")
    merged = stage(
        dealt.repartitionById(len(splitters) + 1, F.col("__segment")).sortWithinPartitions("__segment", *whole).withColumn(
            "__at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "segments")
    counts = merged.groupBy("__segment").agg(F.count("*").alias("__size"))
    before = Window.orderBy("__segment").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__segment", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    return merged.join(F.broadcast(offsets), "__segment").select(
        *df.columns, (F.col("__before") + F.col("__at") + 1).alias(out))


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
    longest: int = 1, buckets: int = BUCKETS, seed: str = SEED,
) -> DataFrame:
    """Draw the part of ``docs`` (doc_id, text) that reads most like ``target`` (text).

    Features are the runs of 1 to ``longest`` words, hashed into buckets. A document's
    weight is the floored mean of its buckets' gains, its score adds noise from a hash of
    its id, and ``percent`` of the documents with ``least_words`` words are drawn by score,
    ties to the smaller id. Returns one row per input row: doc_id, n_features, weight,
    score, rank (null: not drawn).

    Null texts and texts without words have no features, weight 0 and no rank. Every text is
    used whole. An absent id hashes as an empty one and loses ties. Repeated rows are rows
    of their own and tie in an arbitrary order. An empty target makes rare buckets worth
    more; no documents give no rows. Other columns are ignored.
    """
    all_rows = stage(scored(docs, target, longest, buckets, seed), "scored")
    long_enough = F.col("n_words") >= least_words
    drawn = percent * all_rows.filter(long_enough).count() // 100
    last = F.lit((1 << 63) - 1)
    places = ranked(
        all_rows.filter(long_enough),
        [-F.col("score"), F.col("doc_id").isNull().cast("long"), F.coalesce(F.col("doc_id").cast("long"), last)])
    columns = ["doc_id", "n_features", "weight", "score"]
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    rest = all_rows.filter(~long_enough).select(*columns, F.lit(None).cast("long").alias("rank"))
    return places.select(*columns, rank.alias("rank")).unionByName(rest)


SQL = r"""
WITH RECURSIVE bits AS (
  SELECT b, b::BIGINT AS c, 0 AS k FROM range(256) r(b)
  UNION ALL
  SELECT b, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
target_words AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
doc_words AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(ws) AS w FROM words) GROUP BY doc_id, w),
vocabulary AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM doc_words UNION SELECT w FROM target_words)),
hashed AS (
  SELECT w, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(0, length(h) // 2), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::BIGINT)),
    lambda c, x: xor(c // 256, t[(xor(c, x) % 256 + 1)::INT])), 4294967295) % 10000 AS bucket
  FROM vocabulary, crc_table),
s AS (SELECT bucket, sum(n)::BIGINT AS s FROM doc_words JOIN hashed USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM target_words JOIN hashed USING (w) GROUP BY bucket),
sums AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::BIGINT AS ss, (SELECT coalesce(sum(t), 0) FROM t)::BIGINT AS tt),
gains AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * (ss + 10000))::DOUBLE / ((coalesce(s, 0) + 1) * (tt + 10000))::DOUBLE)) AS gain
  FROM (SELECT range AS bucket FROM range(10000)) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), sums),
weights AS (SELECT doc_id, floor(sum(n * gain) / sum(n)) AS weight FROM doc_words JOIN hashed USING (w) JOIN gains USING (bucket) GROUP BY doc_id),
scores AS (
  SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM words LEFT JOIN weights USING (doc_id)),
ranks AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scores WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank
FROM scores LEFT JOIN ranks USING (doc_id)
"""
