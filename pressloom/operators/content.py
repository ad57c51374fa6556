"""Body text of a page.

Pruning, container choice and candidate lists are array expressions inside the
row of the page. Only the last step, whose dictionary grows with each string it
keeps, is an ordered pass in Python over the few candidate strings left.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from .nodes import alive, has_attribute, inside, is_alive, link_heavy, live_counts, marked_by, string_counts
from ..functions.batches import pieces
from ..functions.columns import distinct, first_where, grouped, let, nonempty, strip
from ..functions.similarity import THRESHOLD, word_trigrams
from ..vocab import (
    CONTENT_DROP_TAGS, CONTENT_INVALID_KEYS, CONTENT_KEYS, CONTENT_TAGS, stopwords_for,
)

CLIMB_MIN_STRINGS = 3
ADMIT_LENGTH = 100
#: Length that a string of a dense list has.
DENSE_LENGTH = 30
MAX_INVALID_SCORE = 0.7
SHORT_WORDS = 4
GROWTH_PER_STRING = 4
SHORT_STRING = 80
SHORT_MATCH = 70
GROWTH_SHARE = 0.33


def _is_pruned(n: Column) -> Column:
    """Elements to remove with all below them: those with an invalid class or id unless
    they also carry a content key, and those of the dropped tags."""
    return n["tag"].isin(*CONTENT_DROP_TAGS) | (
        marked_by(n, CONTENT_INVALID_KEYS, only=("class", "id")) & ~marked_by(n, CONTENT_KEYS)
    )


def _page(nodes: Column, strings: Column, living: Column) -> Column:
    """What the later steps need to know: ``nodes``, one entry per node of the page (null
    where it is removed) with the live strings and links below it, ``texts``, the stripped
    text of each string (null where it is blank or removed), and the ``body``.

    Strings and links are summed up once along the page; the count of any subtree is the
    difference of two sums.
    """
    texts = F.transform(strings, lambda s: F.when(is_alive(living, s["node_id"]), nonempty(strip(s["text"]))))
    links = F.zip_with(nodes, living, lambda n, live: live & (n["tag"] == "a") & has_attribute(n, "href"))

    def facts(texts: Column) -> Column:
        counted = F.zip_with(
            string_counts(nodes, texts), live_counts(nodes, links),
            lambda t, l: F.struct(t.alias("n_texts"), (~link_heavy(l, t)).alias("is_good")))
        each = let(counted, lambda c: F.transform(nodes, lambda n, i: F.when(F.get(living, i), F.struct(
            n["node_id"].alias("node_id"), n["end_id"].alias("end_id"), n["parent_id"].alias("parent_id"),
            n["depth"].alias("depth"), n["s_from"].alias("s_from"), n["s_to"].alias("s_to"), n["tag"].alias("tag"),
            n["attrs"].alias("attrs"), marked_by(n, CONTENT_KEYS).alias("is_content"),
            F.get(c, i)["n_texts"].alias("n_texts"), F.get(c, i)["is_good"].alias("is_good")))))
        return let(each, lambda e: F.struct(
            e.alias("nodes"), texts.alias("texts"), first_where(e, lambda n: n["tag"] == "body").alias("body")))

    return let(texts, facts)


def _texts_below(texts: Column, node: Column) -> Column:
    return F.array_compact(F.slice(texts, node["s_from"] + 1, node["s_to"] - node["s_from"]))


def _largest(page: Column, tag: str) -> Column:
    """Block of a tag with the most strings, first of equals; null without text."""
    body = page["body"]
    blocks = F.filter(
        page["nodes"],
        lambda n: (n["tag"] == tag) & (n["n_texts"] > 0)
        & F.when(body.isNull(), F.lit(True)).otherwise(
            inside(n["node_id"], body) & (n["node_id"] > body["node_id"])
        ),
    )
    best = F.array_max(F.transform(blocks, lambda n: F.struct(
        n["n_texts"].alias("count"), (-n["node_id"]).alias("order"))))
    return let(best, lambda b: F.struct(
        F.coalesce(b["count"], F.lit(0)).alias("count"), F.get(page["nodes"], -b["order"]).alias("node")))


def _climb(page: Column, node: Column) -> Column:
    """Where a node leads: itself if it is good, else the nearest ancestor that
    has more than three strings and is good, unless the body comes first.

    ``top`` is the highest node looked at on the way. The walk follows the parents, so
    its length is the depth of the node.
    """
    nodes, body = page["nodes"], page["body"]
    start = F.struct(
        node["parent_id"].alias("at"), F.lit(None).cast("int").alias("target"),
        node["node_id"].alias("top"), F.lit(True).alias("open"),
    )

    def look(state: Column, m: Column) -> Column:
        many = m["n_texts"] > CLIMB_MIN_STRINGS
        at_body = F.coalesce(many & (m["node_id"] == body["node_id"]), F.lit(False))
        found = many & m["is_good"] & ~at_body
        return F.struct(
            m["parent_id"].alias("at"),
            F.when(found, m["node_id"]).alias("target"),
            F.when(many & ~at_body, m["node_id"]).otherwise(state["top"]).alias("top"),
            (~found & ~at_body & m["parent_id"].isNotNull()).alias("open"),
        )

    def step(state: Column, _: Column) -> Column:
        return F.when(state["open"] & state["at"].isNotNull(), let(F.get(nodes, state["at"]), lambda m: look(state, m))).otherwise(state)

    levels = F.when(node["depth"] > 0, F.sequence(F.lit(1), node["depth"])).otherwise(F.array().cast("array<int>"))
    climbed = let(F.aggregate(levels, start, step), lambda end: F.struct(
        F.get(nodes, end["target"]).alias("target"), end["top"].alias("top")))
    return F.when(
        node["is_good"], F.struct(node.alias("target"), node["node_id"].alias("top"))
    ).otherwise(climbed)


def _steps(page: Column, containers: Column) -> Column:
    """Where each content node and each container leads (see ``_climb``)."""
    return F.transform(
        F.filter(
            page["nodes"],
            lambda n: n["is_content"] | F.exists(containers, lambda c: c["node_id"] == n["node_id"]),
        ),
        lambda n: let(_climb(page, n), lambda s: F.struct(
            n["node_id"].alias("node_id"), n["is_content"].alias("is_content"),
            s["target"].alias("target"), s["top"].alias("top"),
        )),
    )


def _candidates(page: Column, steps: Column, container: Column) -> Column:
    """Candidate nodes of a container in post-order, each once: where its content
    nodes and the container lead, and, if one of them leads outside, where the
    content nodes of that wider part of the page lead."""
    def below(root: Column) -> Column:
        return F.filter(steps, lambda s: (s["node_id"] == container["node_id"]) | (
            s["is_content"] & inside(s["node_id"], root)
        ))

    top = F.array_min(F.transform(below(container), lambda s: s["top"]))
    root = let(
        F.least(top, container["node_id"]),
        lambda t: F.get(page["nodes"], t),
    )
    found = F.transform(let(root, below), lambda s: s["target"])
    ordered = F.array_sort(F.transform(F.filter(found, lambda n: n.isNotNull()), lambda n: F.struct(
        n["end_id"].alias("end_id"), (-n["node_id"]).alias("order"), n.alias("node"))))
    once = let(ordered, lambda o: F.filter(o, lambda c, i: (i == 0) | (F.get(o, i - 1)["order"] != c["order"])))
    return F.transform(once, lambda c: let(c["node"], lambda n: F.struct(
        n["tag"].alias("tag"),
        F.array_sort(F.transform(n["attrs"], lambda a: F.struct(a["name"], a["values"]))).alias("key"),
        F.array_join(_texts_below(page["texts"], n), "\n").alias("text"),
    )))


def _merged(candidates: Column) -> Column:
    """Texts of the candidates, those with the same attributes in one list."""
    lists = grouped(distinct(candidates), "key", "text")
    return distinct(F.coalesce(F.transform(lists, lambda g: g["values"]), F.array().cast("array<array<string>>")))


def has_long_string(strings: Column) -> Column:
    """Whether one of the strings is long enough by itself."""
    return F.exists(strings, lambda t: F.length(t) >= ADMIT_LENGTH)


def is_dense(strings: Column) -> Column:
    """Whether at least half of the strings are of some length and all together are
    long enough."""
    some = F.size(F.filter(strings, lambda t: F.length(t) >= DENSE_LENGTH))
    whole = F.length(F.array_join(strings, "\n\n"))
    return (F.size(strings) > 0) & (2 * some >= F.size(strings)) & (whole >= ADMIT_LENGTH)


def _admitted(lists: Column) -> Column:
    """All lists if any of their strings is long enough. Else the dense lists, each as
    the one string that its strings make together; null without any."""
    def dense(ls: Column) -> Column:
        return F.transform(F.filter(ls, is_dense), lambda l: F.array(F.array_join(l, "\n\n")))

    return let(lists, lambda ls: F.when(F.exists(ls, has_long_string), ls).otherwise(
        let(dense(ls), lambda d: F.when(F.size(d) > 0, d))
    ))


def candidate_nodes(dom: Column) -> Column:
    """Candidates for the body of a page, in two arrays of structs (tag, key, text):
    ``first`` from its articles, ``second`` from its divs."""
    nodes, strings = dom["nodes"], dom["strings"]

    def phases(p: Column) -> Column:
        largest = F.struct(*[_largest(p, tag).alias(tag) for tag in CONTENT_TAGS])
        containers = let(largest, lambda b: F.array(
            b["article"]["node"],
            F.when(b["div"]["count"] > b["article"]["count"], b["div"]["node"]),
        ))
        return let(containers, lambda cs: let(_steps(p, cs), lambda st: let(
            F.transform(cs, lambda c: F.when(c.isNotNull(), _candidates(p, st, c))),
            lambda found: F.struct(found[0].alias("first"), found[1].alias("second")),
        )))

    return let(let(alive(nodes, _is_pruned), lambda living: _page(nodes, strings, living)), phases)


def candidate_lists(found: Column) -> Column:
    """Candidate bodies of a page from its ``candidate_nodes``: ``first`` from its
    articles, ``second`` from its divs as well, to be used where the first yields nothing.

    A column of its own: as one expression with the search it would be too deep to plan.
    """
    both = F.transform(
        F.array(found["first"], found["second"]), lambda c: F.when(c.isNotNull(), _admitted(_merged(c))))
    return let(both, lambda ls: F.struct(ls[0].alias("first"), ls[1].alias("second")))


# --- ordered pass over the candidate strings of one page --------------------

_TOKEN = re.compile(r"\w+(?:[-'.]\w+)*|[^\w\s]")
_WORD = re.compile(r"\w")


class _Words:
    """Trigram counts of a growing word list."""

    def __init__(self, words=()):
        self.words: dict[str, tuple[frozenset[str], int]] = {}
        self.add(words)

    def add(self, words) -> None:
        for word in words:
            if word not in self.words:
                grams = word_trigrams(word)
                self.words[word] = (frozenset(grams), len(grams))

    def best(self, value: str) -> int | None:
        """Similarity of the hit with the most matches, None without a hit."""
        counts = Counter(word_trigrams(value))
        top = None
        for grams, size in self.words.values():
            matches = sum(counts[g] for g in grams if g in counts)
            percent = matches / size * 100
            if percent >= THRESHOLD and (top is None or matches > top[0]):
                top = (matches, round(percent))
        return None if top is None else top[1]

    def hit(self, value: str) -> bool:
        """Whether any word is similar. Distinct trigrams found by plain search
        settle most values; repeats are only counted where they could matter."""
        upper = f"  {value}  ".upper()
        open_words = False
        for grams, size in self.words.values():
            found = sum(g in upper for g in grams)
            if found * 100 >= THRESHOLD * size:
                return True
            open_words = open_words or found > 0
        return open_words and self.best(value) is not None


def _tokens(text: str, stop: frozenset[str]) -> list[str]:
    lowered = (t.lower() for t in _TOKEN.findall(text))
    return [t for t in lowered if t not in stop and _WORD.search(t)]


def _few_tokens(text: str, stop: frozenset[str]) -> list[str]:
    """The tokens of a text, but no more than it takes to see that there are many."""
    tokens = []
    for found in _TOKEN.finditer(text):
        token = found.group().lower()
        if token not in stop and _WORD.search(token):
            tokens.append(token)
            if len(tokens) > SHORT_WORDS:
                break
    return tokens


def invalid_scores(lists, headline, stop, invalid: _Words) -> list[float]:
    """Share of unrelated strings at the end of each candidate list."""
    match = _Words(headline)
    scores = []
    for strings in lists:
        negative = 0
        for text in strings:
            tokens = _few_tokens(text, stop)
            if len(tokens) > SHORT_WORDS:
                negative = 0
                continue
            if not tokens:
                negative += 1
                continue
            bad = good = grown = 0
            for token in tokens:
                bad += invalid.hit(token)
                if match.hit(token):
                    good += 1
                    if grown < GROWTH_PER_STRING:
                        match.add(tokens)
                        grown += 1
            if bad / len(tokens) >= 0.5 or good / len(tokens) >= 0.5:
                negative += 1
            if bad == 0 and good == 0:
                negative += 1
        scores.append(negative / len(strings))
    return scores


def pick_list(lists, scores):
    """Scan in order for a list that is no more invalid and longer than the last pick."""
    chosen, lowest, longest = None, 1.0, 0
    for strings, score in zip(lists, scores):
        length = len("\n".join(strings))
        if score <= MAX_INVALID_SCORE and score <= lowest and length > longest:
            chosen, lowest, longest = strings, score, length
    return chosen


def related_strings(strings, headline, stop, invalid: _Words) -> list[str]:
    """Strings related to the headline; the first ones kept widen the dictionary."""
    words = _Words(headline)
    limit = int(GROWTH_SHARE * len(strings))
    kept, grown = [], 0
    for i, text in enumerate(strings):
        if len(text) < SHORT_STRING:
            best, bad = words.best(text), invalid.best(text)
            if best is None or best <= SHORT_MATCH or (bad is not None and bad > SHORT_MATCH):
                continue
        elif not words.hit(text):
            continue
        if grown <= limit and i + 1 < len(strings):
            words.add(_tokens(text, stop))
            grown += 1
        kept.append(text)
    return kept


def body_text(first, second, headline, stop, invalid: _Words) -> str | None:
    """Body from the first candidate lists that yield any text."""
    for lists in (first, (first or []) + (second or []) if second else None):
        if not lists:
            continue
        strings = pick_list(lists, invalid_scores(lists, headline, stop, invalid))
        text = "\n\n".join(related_strings(strings, headline, stop, invalid)) if strings else ""
        if text:
            return text
    return None


def with_content(
    pages: DataFrame, headline: str = "title", lang: str = "site_lang",
    candidates: str = "candidates", out: str = "content",
) -> DataFrame:
    """Replace the candidate lists of each page by the body text chosen from them.

    A page without headline or candidates has no body. The Arrow step sees only
    the columns of ``pages``: drop the parsed page before it.
    """
    schema = StructType([f for f in pages.schema.fields if f.name != candidates])
    schema.add(out, StringType())

    def select(batches):
        stop = {}
        invalid = _Words(CONTENT_INVALID_KEYS)
        for batch in (piece for whole in batches for piece in pieces(whole)):
            bodies = []
            for lists, title, language in zip(
                batch.column(candidates).to_pylist(),
                batch.column(headline).to_pylist(),
                batch.column(lang).to_pylist(),
            ):
                if language not in stop:
                    stop[language] = frozenset(stopwords_for(language))
                bodies.append(
                    None if lists is None or title is None else body_text(
                        lists["first"], lists["second"],
                        _tokens(title, stop[language]), stop[language], invalid,
                    )
                )
            kept = batch.drop_columns([candidates])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(bodies, pa.string())], names=[*kept.schema.names, out]
            )

    return pages.mapInArrow(select, schema)
