"""URL filters: rules and addresses under reversed-host keys, where a rule is an
interval of keys, joined by one sorted sweep with a stack of the active rules."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import stage

RULES_DDL = "host string, path string, verdict string"
#: Verdict where no rule fits.
DEFAULT = "allow"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in
    lower case; empty for null and where there is no ``://``."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(found, upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(labels: Column) -> Column:
    """Key of a host given its labels: the last first, and a slash, which no host
    holds; with the path behind, ``org.example//es/``."""
    return F.concat(F.array_join(F.reverse(labels), "."), F.lit("/"))


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rules and probes of each range in order of their keys, rules first: a rule goes
    on the stack when its key begins and off it at the first key that does not start
    with it. The stack is nested, so the rule that fits a probe best is on top. Only
    the stack is held, at most one rule per character of a key."""
    stack: list[tuple[str, str, str]] = []
    place = None
    for batch in batches:
        ids, rules, verdicts = [], [], []
        for now, key, page, rule, verdict in zip(*(c.to_pylist() for c in batch.columns)):
            if now != place:
                place, stack = now, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if rule is not None:
                if not stack or stack[-1][0] != key:
                    stack.append((key, rule, verdict))
            elif stack:
                ids.append(page)
                rules.append(stack[-1][1])
                verdicts.append(stack[-1][2])
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
            ["__row", "rule", "verdict"])


def judged(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """The pages with host, path, rule and verdict of their ``url``.

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains if the
    path starts with the rule's. Of the rules that fit, the one with the longest text
    (host and path together) wins, then the longer host. ``rule`` is that text, null
    where none fits; the verdict is then ``default``. Of rules with the same host and
    path, the least verdict counts; rules with a null host or path are none.

    Each address is looked up under its own host and every parent domain, no deeper
    than the deepest rule: under one host, a rule is exactly an interval of keys. All
    look-ups are sorted by range; every rule is sent to the ranges its interval meets,
    which needs the first and last key of each range and nothing else on the driver.
    One host or one address may fill many ranges.

    Null addresses have an empty host and path and no rule. Pages repeat as they are;
    without rules every page gets the default. Own columns of the pages that are called
    like a result give way to it.
    """
    spark = pages.sparkSession
    plain = pages.select(*[c for c in pages.columns if c not in ("host", "path", "rule", "verdict")])
    # A number of its own per row: page ids may be null or repeated.
    rows = stage(
        plain.withColumn("__row", F.monotonically_increasing_id())
        .withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url"))), "addresses",
    )
    table = rules.filter("host is not null and path is not null").groupBy("host", "path").agg(
        F.min("verdict").alias("verdict")
    ).select(
        reversed_host(F.split("host", r"\.")).alias("__key_host"), "path", "verdict",
        F.concat("host", "path").alias("rule"), F.size(F.split("host", r"\.")).alias("__labels"),
    ).select("rule", "verdict", "__labels", F.concat("__key_host", "path").alias("key"))
    deepest = table.agg(F.max("__labels")).first()[0] or 0
    labels = F.split("host", r"\.")
    depth = F.least(F.size(labels), F.lit(deepest))
    parents = F.transform(
        F.sequence(F.lit(1), depth), lambda k: reversed_host(F.slice(labels, F.size(labels) - k + 1, k))
    )
    probes = rows.filter((F.col("host") != "") & F.lit(deepest > 0)).select(
        "__row", "path", F.explode(parents).alias("__host")
    ).select("__row", F.concat("__host", "path").alias("key"))
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    cut = stage(
        probes.repartitionByRange(ranges, "key", "__row").withColumn("__range", F.spark_partition_id()), "probes"
    )
    bounds = sorted(tuple(r) for r in cut.groupBy("__range").agg(F.min("key"), F.max("key")).collect())
    if not bounds:
        found = spark.createDataFrame([], "__row long, rule string, verdict string")
    else:
        # Rules whose interval meets a range; the bounds are one pair per range.
        numbers, lows, highs = (F.array(*map(F.lit, column)) for column in zip(*bounds))
        end = F.concat("key", F.lit("\U0010FFFF"))
        meets = F.filter(
            F.arrays_zip(numbers.alias("n"), lows.alias("low"), highs.alias("high")),
            lambda r: (r["low"] <= end) & (r["high"] >= F.col("key")),
        )
        dealt = table.withColumn("__meets", F.explode(meets)).select(
            F.col("__meets.n").alias("__range"), "key", F.lit(None).cast("long").alias("__row"), "rule", "verdict"
        )
        none = F.lit(None).cast("string")
        events = cut.select("__range", "key", "__row", none.alias("rule"), none.alias("verdict")).unionByName(dealt)
        ordered = events.repartition(ranges, "__range").sortWithinPartitions("__range", "key", F.col("__row").asc_nulls_first())
        hits = ordered.select("__range", "key", "__row", "rule", "verdict").mapInArrow(
            sweep, "__row long, rule string, verdict string"
        )
        host_length = F.length(F.substring_index("rule", "/", 1))
        found = hits.groupBy("__row").agg(
            F.max(F.struct(F.length("rule").alias("n"), host_length.alias("h"), F.col("rule"), F.col("verdict"))).alias("best")
        ).select("__row", "best.rule", "best.verdict")
    return rows.join(found, "__row", "left").withColumn(
        "verdict", F.coalesce("verdict", F.lit(default))
    ).select(*plain.columns, "host", "path", "rule", "verdict")


#: Rules of the query.
QUERY_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]

SQL = r"""
WITH parts AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
         row_number() OVER () AS r
  FROM pages),
rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits AS (
  SELECT r, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
  FROM parts JOIN rules ON (host = h OR host LIKE '%.' || h) AND starts_with(path, p)
  GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fits USING (r)
"""
