"""Title of a page: the heading that agrees with its title tag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nodes import joined_text, raw_text, strings_below
from ..functions.columns import first_where, let, nonempty
from ..functions.text import heading_tokens, title_tokens, transliterate, valid_title
from ..vocab import TITLE_TAG, TITLE_TAGS

MIN_TOKENS = 3
MIN_LENGTH_SHARE = 0.5
MIN_OVERLAP = 0.75


def overlap(tokens: Column, reference: Column) -> Column:
    """Share of ``tokens`` that occur in ``reference``; null without tokens."""
    common = F.size(F.filter(tokens, lambda t: F.array_contains(reference, t)))
    return common / F.nullif(F.size(tokens), F.lit(0))


def agrees(heading: Column, reference: Column) -> Column:
    """Whether a heading is long enough and shares enough tokens with the title."""
    return let(
        F.struct(heading_tokens(heading).alias("h"), reference.alias("t")),
        lambda v: (F.size(v["h"]) >= MIN_TOKENS)
        & (F.size(v["h"]) / F.nullif(F.size(v["t"]), F.lit(0)) > MIN_LENGTH_SHARE)
        & (overlap(v["h"], v["t"]) >= MIN_OVERLAP),
    )


def choose_title(headings: Column, title_tag: Column) -> Column:
    """First agreeing heading in the order given, else the text of the title tag."""
    return let(
        title_tokens(title_tag),
        lambda tokens: F.coalesce(
            first_where(headings, lambda h: F.coalesce((h != "") & agrees(h, tokens), F.lit(False))),
            title_tag,
        ),
    )


def raw_title(dom: Column) -> Column:
    """Title before clean-up: h1, then h2, then h3 against the title tag."""
    nodes, strings = dom["nodes"], dom["strings"]

    def texts(tag: str) -> Column:
        return F.transform(
            F.filter(nodes, lambda n: n["tag"] == tag),
            lambda n: joined_text(strings_below(strings, n), " "),
        )

    tag_node = first_where(nodes, lambda n: n["tag"] == TITLE_TAG)
    tag_text = nonempty(raw_text(strings_below(strings, tag_node)))
    first_h1 = nonempty(F.get(texts("h1"), F.lit(0)))
    headings = F.concat(*[texts(tag) for tag in TITLE_TAGS])
    return choose_title(headings, F.coalesce(tag_text, first_h1))


def clean_title(title: Column) -> Column:
    """Stored form of a title: transliterated; null for error pages."""
    return let(transliterate(title), valid_title)
