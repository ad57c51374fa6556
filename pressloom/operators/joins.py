"""Lookups that stay even when one key holds a large share of the rows."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest planned size of a side that is sent to every executor.
BROADCAST_BYTES = 32 * 1024 * 1024
#: Partitions of a heavy key, and the rows from which a key is one.
SALTS, HEAVY_ROWS = 32, 1_000_000
#: Input bytes per core below which a table has too few splits.
SMALL_SPLIT = 8 * 1024 * 1024


def planned_bytes(df: DataFrame) -> int:
    """Size of a table as the optimizer estimates it."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def heavy_keys(df: DataFrame, on: list[str]) -> DataFrame:
    """Keys with more than ``HEAVY_ROWS`` rows: one in so many rows at most. Counted in
    each task first, so a hot key is one row of each when it is shuffled."""
    return df.groupBy(*on).agg(F.count("*").alias("__rows")).where(F.col("__rows") > HEAVY_ROWS).select(
        *on, F.lit(SALTS).alias("__parts"))


def lookup(
    left: DataFrame, right: DataFrame, on: str | list[str], how: str = "left",
    spread_by: str | None = None, limit: int | None = None,
) -> DataFrame:
    """Join a large, possibly skewed table with one that has each key once.

    The right side is broadcast while its planned size is within ``limit`` (by default
    ``BROADCAST_BYTES``). Beyond it, the rows of the keys that are heavy by their measured
    counts are divided among ``SALTS`` partitions by a hash of ``spread_by``, and the
    right side's rows of these keys, and no others, are copied to each.
    """
    on = [on] if isinstance(on, str) else list(on)
    if planned_bytes(right) <= (BROADCAST_BYTES if limit is None else limit):
        return left.join(F.broadcast(right), on, how)
    if spread_by is None:
        return left.join(right, on, how)
    heavy = stage(heavy_keys(left.select(*on), on), "heavy-keys")
    if heavy.isEmpty():
        return left.join(right, on, how)
    known = F.broadcast(heavy)
    parts = F.coalesce("__parts", F.lit(1))
    salt = F.pmod(F.xxhash64(spread_by), parts).cast("int")
    salted = left.join(known, on, "left").withColumn("__salt", salt).drop("__parts")
    copies = right.join(known, on, "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__parts")
    return salted.join(copies, [*on, "__salt"], how).drop("__salt")


#: Bits of a filter for each key, places set for a key, and most bits of one filter.
BITS_PER_KEY, PLACES, MOST_BITS = 12, 4, 1 << 26


def prefiltered(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be among ``keys(key)``: all that are, and with
    ``BITS_PER_KEY`` about one in two hundred of the others.

    A Bloom filter of the keys, in the scan's own stage, before anything is shuffled. It
    has at most ``MOST_BITS`` bits; with more keys it lets more through. Meant for a join
    of a wide table with few of its keys: the join still decides.
    """
    keys = keys.select(key).where(F.col(key).isNotNull())
    n = keys.count()
    bits = min(MOST_BITS, max(1 << 10, 1 << (n * BITS_PER_KEY - 1).bit_length())) if n else 64

    def places(column: str) -> list[Column]:
        return [F.pmod(F.xxhash64(column, F.lit(i)), F.lit(bits)) for i in range(PLACES)]

    rows = keys.select(F.explode(F.array(*places(key))).alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")).collect()
    table = np.zeros(bits // 64, np.int64)
    for row in rows:
        table[row.word] = row.bits
    words = F.lit(table)
    hit = F.lit(True)
    for at in places(key):
        own = F.get(words, F.shiftright(at, 6).cast("int"))
        hit = hit & (F.getbit(own, at.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return df.where(hit)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Divide a table too small for one input split per core among all cores.

    Meant before work that is heavy per row. Larger tables are left alone, so no
    more than ``SMALL_SPLIT`` bytes per core are ever shuffled for it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if planned_bytes(df) < cores * SMALL_SPLIT else df


def repartitioned(df: DataFrame, key: str) -> DataFrame:
    """Divide a table by a key into the session's number of shuffle partitions,
    which adaptive execution then leaves as they are. For small rows that each
    cause much work."""
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(partitions, spark.sparkContext.defaultParallelism), key)


def first_rows(df: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """One row per key, the one with the lowest ``order``: a combined aggregate
    rather than a window, so a hot key is reduced before the shuffle."""
    return df.groupBy(key).agg(
        F.min_by(F.struct(*columns), F.col(order)).alias("r")
    ).select(key, *[F.col(f"r.{c}").alias(c) for c in columns])


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for an intermediate table, under the shared folder that
    ``spark.checkpoint.dir`` names. Only a session on one machine may leave it
    unset and gets a temporary folder. The folder goes when the driver ends."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="pressloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base}/{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table and read it back, so that it is computed once
    and a lost executor costs no more than the tasks it was running."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
