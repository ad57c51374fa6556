"""Public suffixes of hosts: rules as a trie of labels, from the last label inwards."""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import let

#: Rules that one table may hold; the whole public list has some ten thousand.
MOST_RULES = 50_000


class _Node:
    """Labels that may stand before a suffix."""

    def __init__(self) -> None:
        self.labels: dict[str, _Node] = {}
        self.ends = False
        self.exceptions: set[str] = set()


def _trie(rules: tuple[str, ...]) -> _Node:
    root = _Node()
    for rule in rules:
        labels = rule.lstrip("!").lower().split(".")[::-1]
        if not all(labels):
            continue
        last = labels.pop() if rule.startswith("!") else None
        node = root
        for label in labels:
            node = node.labels.setdefault(label, _Node())
        if last:
            node.exceptions.add(last)
        else:
            node.ends = True
    return root


def _alternatives(node: _Node) -> str:
    """Pattern of the labels below a node, each with what may stand before it."""
    by_letter: dict[str, list[str]] = {}
    for label, child in sorted(node.labels.items()):
        if label == "*":
            continue
        # The label ends here; then comes as much more as there is.
        ways = [rf"\.(?:{_alternatives(child)})"] if child.labels else []
        if child.exceptions:
            # Before an exception the suffix ends, whatever else the rules say.
            ways.insert(0, rf"(?=\.(?:{'|'.join(map(re.escape, sorted(child.exceptions)))})(?:\.|$))")
        more = f"(?:{'|'.join(ways)}){'?+' if child.ends else ''}" if ways else ""
        tail = rf"(?=\.|$){more}"
        by_letter.setdefault(label[0], []).append(re.escape(label[1:]) + tail)
    out = [re.escape(c) + (f"(?:{'|'.join(rest)})" if len(rest) > 1 else rest[0]) for c, rest in by_letter.items()]
    if "*" in node.labels:
        spared = "|".join(map(re.escape, sorted(node.exceptions)))
        not_spared = rf"(?!(?:{spared})(?:\.|$))" if spared else ""
        below = node.labels["*"]
        more = rf"(?:\.(?:{_alternatives(below)}))?+" if below.labels else ""
        out.append(rf"{not_spared}[^.]+{more}")
    return "|".join(out) or "(?!)"


@lru_cache(maxsize=16)
def suffix_pattern(rules: tuple[str, ...]) -> str:
    """Pattern of the longest public suffix at the start of a host whose labels are in
    reverse order. Siblings are grouped by their first letter and nothing that has
    matched is given back, so a host is walked through once."""
    return rf"^((?>{_alternatives(_trie(rules))}))(?=\.|$)"


def public_suffix(host: Column, rules: list[str] | tuple[str, ...]) -> Column:
    """Longest public suffix of a host by the rules, '' where none applies.

    A rule is a suffix (``co.uk``), one with any label before it (``*.ck``), or an
    exception to that (``!www.ck``: the suffix is ``ck``).
    """
    def reverse(name: Column) -> Column:
        return F.array_join(F.reverse(F.split(name, r"\.")), ".")

    return reverse(F.regexp_extract(reverse(F.lower(host)), suffix_pattern(tuple(rules)), 1))


def host_parts(host: Column, rules: list[str] | tuple[str, ...]) -> Column:
    """``tld``, ``domain`` and ``subdomain`` of a host. A host that is nothing but a
    suffix, or has none, has empty ones."""
    def parts(suffix: Column) -> Column:
        stem = F.when(
            (suffix != "") & (F.length(host) > F.length(suffix)),
            F.left(host, F.length(host) - F.length(suffix) - 1))
        labels = F.split(stem, r"\.")
        known = stem.isNotNull() & (F.element_at(labels, -1) != "")
        return F.struct(
            F.when(known, suffix).otherwise("").alias("tld"),
            F.when(known, F.element_at(labels, -1)).otherwise("").alias("domain"),
            F.when(known, F.array_join(F.slice(labels, 1, F.size(labels) - 1), ".")).otherwise("").alias("subdomain"))

    return let(public_suffix(host, rules), parts)


def listed_rules(suffixes: DataFrame) -> tuple[str, ...]:
    """Rules of a table ``suffixes(suffix)``, which become part of the plan."""
    rows = suffixes.where("suffix is not null").select(F.lower("suffix").alias("suffix")).distinct().orderBy(
        "suffix").limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise ValueError(f"a table of suffixes has at most {MOST_RULES} rules")
    return tuple(r.suffix for r in rows)
