"""Publish date of a page: the element whose attributes resemble a date key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nodes import raw_text, strings_below
from ..functions.columns import let
from ..functions.dates import first_date_before
from ..functions.similarity import any_similar
from ..vocab import DATE_KEYS, DATE_TAGS


def names_date(node: Column) -> Column:
    """Whether some attribute value of an element is similar to a date key."""
    return F.exists(node["attrs"], lambda a: F.exists(a["values"], lambda v: any_similar(v, DATE_KEYS)))


def block_date(dom: Column, as_of: Column) -> Column:
    """Date written in the first date element of a tag; the first tag, in fixed
    order, whose element holds a date before ``as_of`` decides."""
    nodes, strings = dom["nodes"], dom["strings"]
    candidates = F.filter(nodes, lambda n: n["tag"].isin(*DATE_TAGS) & names_date(n))
    return let(
        candidates,
        lambda found: F.when(
            F.size(found) > 0,
            F.coalesce(*[
                first_date_before(
                    raw_text(strings_below(
                        strings, F.get(F.filter(found, lambda n: n["tag"] == tag), F.lit(0))
                    )),
                    as_of,
                )
                for tag in DATE_TAGS
            ]),
        ),
    )
