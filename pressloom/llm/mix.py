"""Mixing sources to target weights: hash-random keys, a range sort within each
source, distributed prefix sums of the sizes, and a cut at each source's budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import stage
from .words import WORD


def word_count(text: Column) -> Column:
    """Number of words of a text; zero for a null one."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def prefix_sums(df: DataFrame, group: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the earlier rows of the same group.

    The rows are divided into ranges of (group, order), so a group of any size is
    spread over many tasks. Each range is summed; a range's own offset is the sum
    of the group's ranges before it, and a window adds up within the range. Rows
    that agree in group and order have an arbitrary order among themselves. With no
    group, the offsets are a window over one row per range. Null groups are groups.
    """
    spark = df.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    cut = stage(
        df.repartitionByRange(ranges, *group, *order).withColumn("__range", F.spark_partition_id()),
        "ranges",
    )
    total = f"__sum_{out}"
    sums = cut.groupBy(*group, "__range").agg(F.sum(value).alias(total))
    before = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *group, "__range", F.coalesce(F.sum(total).over(before), F.lit(0)).alias("__offset")
    )
    within = Window.partitionBy(*group, "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = cut.withColumn(out, F.coalesce(F.sum(value).over(within), F.lit(0)))
    same = [summed[c].eqNullSafe(offsets[c]) for c in [*group, "__range"]]
    joined = summed.join(offsets, same, "left")
    return joined.select(
        *[summed[c] for c in df.columns], (summed[out] + offsets["__offset"]).alias(out)
    )


def source_targets(
    totals: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3
) -> DataFrame:
    """Add ``target`` to a table (source, source_size) with one row per source.

    Sources by code point, null last, weigh ``weights`` in turn. All sizes together
    are shared by weight; a target stops at ``cap`` times its source's size and the
    excess goes to the others by weight, until none is above. That is
    ``min(cap * size, level * weight)`` with one level for all: in order of
    ``cap * size / weight`` the stopped sources come first, and the level is what is
    left beyond them over the weights left. Both sums are prefix sums, so the number
    of sources has no bound either.
    """
    ranked = prefix_sums(
        totals.select("source", "source_size", F.col("source").isNull().alias("__null"), F.lit(1).alias("__one")),
        [], ["__null", "source"], "__one", "__rank",
    )
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("__rank") % len(weights) + 1).cast("int"))
    weighed = ranked.select("source", "source_size", weight.cast("long").alias("__weight"), "__rank").withColumn(
        "__stop", cap * F.col("source_size") / F.col("__weight")
    )
    stopped = prefix_sums(weighed, [], ["__stop", "__rank"], "source_size", "__size_before")
    stopped = prefix_sums(stopped, [], ["__stop", "__rank"], "__weight", "__weight_before")
    whole = weighed.agg(
        F.coalesce(F.sum("source_size"), F.lit(0)).alias("sizes"), F.sum("__weight").alias("weights")
    ).first()
    level = (whole.sizes - cap * F.col("__size_before")) / (F.lit(whole.weights) - F.col("__weight_before"))
    found = stopped.withColumn("__level", level).filter(F.col("__level") <= F.col("__stop")).agg(F.max("__level").alias("level")).first()
    target = F.least((cap * F.col("source_size")).cast("double"), F.lit(found.level) * F.col("__weight"))
    return weighed.select(
        "source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target")
    )


def sample_key(seed: str = "mix") -> Column:
    """A hash-random key of a document; copies under other ids get other keys."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text))


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, seed: str = "mix"
) -> DataFrame:
    """Words to take of each document so that the sources meet their targets.

    ``docs`` has doc_id, text and source; other columns are ignored. Returns one row
    per input row: doc_id, size, source_size, target, taken, source, sample_key,
    ``epochs`` (whole passes over the source).

    A source's budget is its target rounded to words. Whole epochs take every
    document; the rest is cut from the source's documents in order of their
    hash-random keys, the last one in part, so the taken words of a source are its
    budget exactly and nothing is taken more than ``cap`` times. Null and empty texts
    have size 0 and give nothing. A null source is a source of its own. Repeated rows
    are rows of their own; they tie and share the cut arbitrarily between them, with
    the same sum. No documents give no rows.
    """
    sized = stage(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), sample_key(seed).alias("sample_key")),
        "sized",
    )
    totals = stage(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "totals")
    targets = source_targets(totals, weights, cap)
    summed = prefix_sums(sized, ["source"], ["sample_key", "doc_id", "size"], "size", "__before")
    budget = F.round(F.col("target")).cast("long")
    size = F.col("source_size")
    epochs = F.when(size > 0, F.floor(budget / size)).otherwise(0).cast("long")
    rest = budget - F.col("epochs") * size
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("__before")))
    joined = summed.join(targets, summed["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    return joined.withColumn("epochs", epochs).select(
        "doc_id", "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"),
        "source", "sample_key", "epochs",
    )


def mixed_documents(docs: DataFrame, **options: object) -> DataFrame:
    """The documents that the mix takes, with ``size`` and ``taken`` beside their own
    columns (which win: a clashing name gets a leading underscore).

    Rows that agree in doc_id and text are one document; it is returned once, with
    the words taken of all of them.
    """
    plan = mix_sources(docs, **options).filter("taken > 0").groupBy("doc_id", "sample_key").agg(
        F.max("size").alias("size"), F.sum("taken").alias("taken")
    )
    names = {c: c if c not in docs.columns else f"_{c}" for c in ("size", "taken")}
    plan = plan.select(
        F.col("doc_id").alias("__id"), F.col("sample_key").alias("__key"),
        *[F.col(c).alias(name) for c, name in names.items()],
    )
    once = docs.withColumn("__own_key", sample_key(str(options.get("seed", "mix"))))
    joined = once.join(plan, once["__own_key"].eqNullSafe(plan["__key"]) & once["doc_id"].eqNullSafe(plan["__id"]))
    return joined.dropDuplicates(["__id", "__key"]).select(*docs.columns, *names.values())


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, text IS NULL AS no_text,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS k
  FROM documents),
totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS w,
         row_number() OVER (ORDER BY source IS NULL, source) AS r FROM totals),
stops AS (
  SELECT *, 3 * source_size / w AS stop FROM weighed),
levels AS (
  SELECT stop, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER before, 0))::DOUBLE
         / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
  FROM stops WINDOW before AS (ORDER BY stop, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         least((3 * source_size)::DOUBLE, (SELECT max(level) FROM levels WHERE level <= stop) * w) AS target
  FROM stops),
cut AS (
  SELECT s.*, t.source_size, t.target, round(t.target)::BIGINT AS budget,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY k, doc_id, s.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
passes AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM cut)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, budget - epochs * source_size - before)))::BIGINT AS taken,
       source, k AS sample_key, epochs::BIGINT AS epochs
FROM passes
"""
