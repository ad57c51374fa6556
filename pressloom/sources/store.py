"""Queries and updates of the link, article and website tables.

A table that changes is kept as an append-only log of rows; its current state
is the latest row per id. No batch rewrites a table it only adds to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import first_rows, lookup


def predicate(query: dict) -> Column:
    """Filter of a document query: equality, ``$in`` and ``$ne: None``, all of
    which must hold."""
    test = F.lit(True)
    for field, want in query.items():
        if not isinstance(want, dict):
            test = test & (F.col(field).isNull() if want is None else F.col(field) == F.lit(want))
            continue
        for operator, value in want.items():
            if operator == "$in":
                test = test & F.col(field).isin(list(value))
            elif operator == "$ne" and value is None:
                test = test & F.col(field).isNotNull()
            else:
                raise ValueError(f"unknown query operator {operator!r} on {field!r}")
    return test


def find(df: DataFrame, query: dict, limit: int | None, tiebreak: str | None = None) -> DataFrame:
    """Rows that match a query, or a query wrapped as ``$query``/``$orderby``.

    ``limit`` is the number of rows the caller asks for; None returns all.
    """
    wrapped = "$query" in query
    unknown = [k for k in query if k.startswith("$") and k not in ("$query", "$orderby")]
    if unknown:
        raise ValueError(f"unknown query operator {unknown[0]!r}")
    out = df.where(predicate(query["$query"] if wrapped else query))
    order = [
        F.col(field).desc() if way == -1 else F.col(field).asc()
        for field, way in (query.get("$orderby", {}) if wrapped else {}).items()
    ]
    if order:
        out = out.orderBy(*order, *([tiebreak] if tiebreak else []))
    return out if limit is None else out.limit(limit)


def get_one(df: DataFrame, id_column: str, value) -> DataFrame:
    """Row with an id; no row for a null id."""
    if value is None:
        return df.where(F.lit(False))
    return df.where(F.col(id_column) == F.lit(value)).limit(1)


def counts(df: DataFrame, query: dict, null_for_none: bool = False) -> DataFrame:
    """Number of rows that match; optionally null instead of zero."""
    n = F.count("*")
    return df.where(predicate(query)).agg((F.nullif(n, F.lit(0)) if null_for_none else n).alias("n"))


def patched(
    base: DataFrame, patches: DataFrame, id_column: str,
    stamp: Column | None = None, default_editor: str | None = None,
) -> DataFrame:
    """Base table with partial updates applied.

    ``patches`` has one row per id and some of the columns of ``base``; null
    leaves a column as it is. ``stamp`` becomes ``date_updated`` of the rows that
    were patched, ``default_editor`` their ``updated_by`` where the patch names
    none.
    """
    fields = [c for c in patches.columns if c != id_column]
    if not fields:
        raise ValueError("no valid data to be updated")
    renamed = patches.select(
        id_column, F.lit(True).alias("__patched"), *[F.col(c).alias(f"__{c}") for c in fields]
    )
    joined = base.join(renamed, id_column, "left")
    touched = F.col("__patched").isNotNull()

    def value(c: str) -> Column:
        new = F.coalesce(F.col(f"__{c}"), F.col(c)) if c in fields else F.col(c)
        if c == "date_updated" and stamp is not None:
            new = F.when(touched, stamp).otherwise(F.col(c))
        if c == "updated_by" and default_editor is not None:
            given = F.col("__updated_by") if c in fields else F.lit(None)
            new = F.when(touched, F.coalesce(given, F.lit(default_editor))).otherwise(F.col(c))
        return new.alias(c)

    return joined.select(*[value(c) for c in base.columns])


def latest(log: DataFrame, id_column: str, version: str) -> DataFrame:
    """Current rows of an append-only log: the last version of each id."""
    rest = [c for c in log.columns if c != id_column]
    return log.groupBy(id_column).agg(
        F.max_by(F.struct(*rest), F.col(version)).alias("r")
    ).select(id_column, "r.*").select(*log.columns)


def unique_inserts(new: DataFrame, existing: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of ``new`` that may be inserted under a unique key: the first per key
    whose key is not stored yet.

    The winners are found on key and order alone and joined back on ``order``,
    which must be unique; wide columns and hot keys never meet in one task.
    """
    winners = first_rows(new.where(F.col(key).isNotNull()).select(key, order), key, order, [order])
    fresh = winners.join(existing.select(key).distinct(), key, "left_anti").select(order)
    return lookup(new, fresh, order, "left_semi")


def append_articles(articles: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch of records; writing the same batch again replaces it."""
    articles.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
