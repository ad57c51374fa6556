"""Author of a page: the element whose attributes resemble a byline key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import lookup
from .nodes import (
    joined_text, live_strings, marked_by, outside_all, strings_below, subtree_roots,
)
from ..functions.columns import let, nonempty
from ..functions.similarity import top_similarity
from ..functions.text import author_text
from ..vocab import (
    AUTHOR_COMMENT_KEYS, AUTHOR_DROP_TAGS, AUTHOR_FOOTER_KEYS, AUTHOR_KEYS, AUTHOR_TAGS,
)

MAX_VALUE_LENGTH = 20
MAX_ELEMENT_LENGTH = 25
MIN_SIMILARITY = 60
MAX_AUTHORS = 2


def _is_byline(value: Column) -> Column:
    return F.coalesce(top_similarity(value, AUTHOR_KEYS) >= MIN_SIMILARITY, F.lit(False))


def names_author(node: Column) -> Column:
    """Whether some attribute value of an element resembles an author key.

    Plain values longer than 20 characters, lists of more than 20 words and
    list words longer than 25 characters are not considered.
    """
    return F.exists(
        node["attrs"],
        lambda a: F.when(
            a["is_list"],
            (F.size(a["values"]) <= MAX_VALUE_LENGTH)
            & F.exists(a["values"], lambda v: (F.length(v) <= MAX_ELEMENT_LENGTH) & _is_byline(v)),
        ).otherwise(
            F.exists(a["values"], lambda v: (F.length(v) <= MAX_VALUE_LENGTH) & _is_byline(v))
        ),
    )


def author(dom: Column) -> Column:
    """Byline text: tags in their fixed order, elements in document order, first
    one with any text."""
    nodes, strings = dom["nodes"], dom["strings"]
    invalid = AUTHOR_COMMENT_KEYS + AUTHOR_FOOTER_KEYS
    candidates = F.filter(nodes, lambda n: n["tag"].isin(*AUTHOR_TAGS) & names_author(n))

    def pick(found: Column, dropped: Column) -> Column:
        texts = F.transform(
            F.filter(found, lambda n: outside_all(n["node_id"], dropped)),
            lambda n: F.struct(
                n["tag"].alias("tag"),
                F.replace(
                    joined_text(live_strings(strings_below(strings, n), dropped), " "),
                    F.lit("\n"), F.lit(" "),
                ).alias("text"),
            ),
        )
        return let(
            F.filter(texts, lambda t: t["text"] != ""),
            lambda ts: F.coalesce(*[
                nonempty(author_text(F.get(F.filter(ts, lambda t: t["tag"] == tag), F.lit(0))["text"]))
                for tag in AUTHOR_TAGS
            ]),
        )

    def prune(found: Column) -> Column:
        dropped = subtree_roots(
            nodes, lambda n: n["tag"].isin(*AUTHOR_DROP_TAGS) | marked_by(n, invalid)
        )
        return let(
            F.struct(found.alias("found"), dropped.alias("dropped")),
            lambda v: pick(v["found"], v["dropped"]),
        )

    # Most pages have no byline; the costly pruning test runs only where there is one.
    return let(candidates, lambda found: F.when(F.size(found) > 0, prune(found)))


def cap_authors(names: Column) -> Column:
    """First-seen distinct names, at most two."""
    return F.slice(F.array_distinct(names), 1, MAX_AUTHORS)


def verify_authors(records: DataFrame, people: DataFrame, key: str, names: str) -> DataFrame:
    """Keep the names listed in ``people(name)``, distinct and at most two; the
    names stay as they are where none is listed."""
    each = records.select(key, F.posexplode(names).alias("pos", "name"))
    # A name under a third of all records is divided among many tasks.
    listed = (
        lookup(each, people.select("name").distinct(), "name", "left_semi", key)
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(F.struct("pos", "name"))).alias("found"))
        .select(key, cap_authors(F.transform("found", lambda f: f["name"])).alias("verified"))
    )
    return (
        records.join(listed, key, "left")
        .withColumn(names, F.coalesce("verified", names))
        .drop("verified")
    )
