"""Node operators over the parsed page.

Extraction stays inside the row of its page: a subtree is a range of node and
string indexes, so pruning, counting and text are array expressions that need
neither a shuffle nor a sort. ``node_table`` gives the same tree as rows for
work across pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import first_where, let, nonempty, prefix_sums, running, strip
from ..functions.similarity import mentions_key


def inside(node_id: Column, root: Column) -> Column:
    """Whether a node lies in the subtree of ``root`` (or is it)."""
    return (node_id >= root["node_id"]) & (node_id <= root["end_id"])


def outside_all(node_id: Column, roots: Column) -> Column:
    """Whether a node lies in none of the subtrees in the array ``roots``."""
    return ~F.exists(roots, lambda r: inside(node_id, r))


def attribute(node: Column, name: str) -> Column:
    """First value of an attribute, null where the node has none."""
    return F.get(first_where(node["attrs"], lambda a: a["name"] == name)["values"], F.lit(0))


def has_attribute(node: Column, name: str) -> Column:
    return F.exists(node["attrs"], lambda a: a["name"] == name)


def marked_by(node: Column, keys: list[str], only: tuple[str, ...] = ()) -> Column:
    """Keyword test of an element: some attribute value names or resembles a key.

    ``only`` restricts the test to the attributes of these names.
    """
    def test(attr: Column) -> Column:
        hit = F.exists(attr["values"], lambda v: mentions_key(v, keys))
        return attr["name"].isin(*only) & hit if only else hit

    return F.exists(node["attrs"], test)


def subtree_roots(nodes: Column, test) -> Column:
    """Ranges of the subtrees whose root satisfies ``test``."""
    return F.transform(
        F.filter(nodes, test),
        lambda n: F.struct(n["node_id"].alias("node_id"), n["end_id"].alias("end_id")),
    )


def strings_below(strings: Column, node: Column) -> Column:
    """The strings of a subtree: a contiguous slice in document order."""
    return F.slice(strings, node["s_from"] + 1, node["s_to"] - node["s_from"])


def stripped_strings(strings: Column) -> Column:
    """Stripped, non-blank texts of an array of strings."""
    return F.filter(F.transform(strings, lambda s: strip(s["text"])), lambda t: t != "")


def live_strings(strings: Column, dropped: Column) -> Column:
    """Strings that survive the removal of the subtrees ``dropped``."""
    return F.filter(strings, lambda s: outside_all(s["node_id"], dropped))


def joined_text(strings: Column, separator: str) -> Column:
    return F.array_join(stripped_strings(strings), separator)


def raw_text(strings: Column) -> Column:
    """Concatenated texts, stripped as a whole, on one line."""
    joined = F.array_join(F.transform(strings, lambda s: s["text"]), "")
    return F.replace(strip(joined), F.lit("\n"), F.lit(" "))


def alive(nodes: Column, doomed) -> Column:
    """For each node whether it lies in no subtree whose root is ``doomed``: the farthest
    end of such a subtree so far is before it."""
    ends = running(F.transform(nodes, lambda n: F.when(doomed(n), n["end_id"]).otherwise(-1)), F.lit(-1), F.greatest)
    return let(ends, lambda e: F.transform(e, lambda end, i: end < i))


def is_alive(living: Column, node_id: Column) -> Column:
    """Whether a node is alive by ``alive``; strings outside all elements are."""
    return (node_id < 0) | F.get(living, node_id)


def drop_tags(nodes: DataFrame, tags: list[str]) -> DataFrame:
    """Remove elements of the given names, with all below them, from a node table."""
    return drop_marked(nodes, F.col("tag").isin(*tags))


def drop_marked(nodes: DataFrame, mark: Column) -> DataFrame:
    """Remove the subtrees of marked nodes from a node table: those that begin no later
    than the farthest end of a marked node so far in their page. One exchange by page,
    none if the table is already dealt by page."""
    before = Window.partitionBy("page_id").orderBy("node_id")
    farthest = F.max(F.when(mark, F.col("end_id"))).over(before)
    return nodes.withColumn("__end", F.coalesce(farthest, F.lit(-1))).where(F.col("__end") < F.col("node_id")).drop("__end")


def paths(nodes: Column) -> Column:
    """Ancestors of each node, root first. The ancestors of a node are the first
    ``depth`` of the node before it and that node's own."""
    none = F.array().cast("array<int>")
    lines = running(nodes, none, lambda line, n: F.concat(F.slice(line, 1, n["depth"]), F.array(n["node_id"])))
    return let(lines, lambda ls: F.zip_with(ls, nodes, lambda line, n: F.slice(line, 1, n["depth"])))


def own_strings(nodes: Column, strings: Column) -> Column:
    """For each node its own strings that are not blank, as structs (pos, text).

    Strings are sorted by their node and cut into runs; sorted together with the nodes,
    each run comes right before its node. No string is looked at for more than one node.
    """
    some = F.array().cast("array<struct<pos: int, text: string>>")

    def runs(by_node: Column) -> Column:
        first = F.filter(
            F.sequence(F.lit(0), F.size(by_node) - 1),
            lambda i: (i == 0) | (F.get(by_node, i)["node_id"] != F.get(by_node, i - 1)["node_id"]))
        return let(first, lambda begins: F.transform(begins, lambda at, k: F.struct(
            F.get(by_node, at)["node_id"].alias("node_id"), F.lit(0).alias("kind"),
            F.transform(
                F.slice(by_node, at + 1, F.coalesce(F.get(begins, k + 1), F.size(by_node)) - at),
                lambda s: F.struct(s["pos"].alias("pos"), s["text"].alias("text"))).alias("own"))))

    told = F.filter(F.transform(strings, lambda s, i: F.struct(
        s["node_id"].alias("node_id"), i.alias("pos"), strip(s["text"]).alias("text"))), lambda s: s["text"] != "")
    no_runs = F.array().cast("array<struct<node_id: int, kind: int, own: array<struct<pos: int, text: string>>>>")
    found = let(F.array_sort(told), lambda t: F.when(F.size(t) > 0, runs(t)).otherwise(no_runs))
    each = F.transform(nodes, lambda n: F.struct(n["node_id"].alias("node_id"), F.lit(1).alias("kind"), some.alias("own")))

    def dealt(mixed: Column) -> Column:
        paired = F.transform(mixed, lambda m, i: F.struct(m["kind"].alias("kind"), F.when(
            (i > 0) & (F.get(mixed, i - 1)["node_id"] == m["node_id"]), F.get(mixed, i - 1)["own"]).otherwise(some).alias("own")))
        return F.transform(F.filter(paired, lambda m: m["kind"] == 1), lambda m: m["own"])

    return let(F.array_sort(F.concat(found, each)), dealt)


def node_table(parsed: DataFrame, dropped=None) -> DataFrame:
    """One row per element of ``parsed(page_id, dom)``, without the subtrees whose root
    satisfies ``dropped``. The time per page is in proportion to its elements, strings
    and the depths of its elements."""
    nodes, strings = F.col("dom.nodes"), F.col("dom.strings")
    living = F.transform(nodes, lambda n: F.lit(True)) if dropped is None else alive(nodes, dropped)
    each = F.arrays_zip(
        nodes.alias("node"), paths(nodes).alias("path"), own_strings(nodes, strings).alias("own"), living.alias("living"))
    names = F.transform("n.attrs", lambda a: a["name"])
    return (
        parsed.select("page_id", F.explode(F.filter(each, lambda e: e["living"])).alias("e"))
        .select("page_id", F.col("e.node").alias("n"), "e.path", "e.own")
        .select(
            "page_id", "n.node_id", "n.parent_id", "path", "n.tag",
            F.map_from_arrays(names, F.transform("n.attrs", lambda a: a["values"])).alias("attrs"),
            names.alias("attr_order"),
            F.map_from_arrays(names, F.transform("n.attrs", lambda a: a["is_list"])).alias("is_list"),
            "n.depth", "n.end_id", F.col("own").alias("own_strings"),
        )
    )


def live_counts(nodes: Column, flags: Column) -> Column:
    """For each node the number of true ``flags`` (one a node) below it, itself aside."""
    sums = prefix_sums(F.transform(flags, lambda f: f.cast("int")))
    return let(sums, lambda s: F.transform(nodes, lambda n: F.get(s, n["end_id"] + 1) - F.get(s, n["node_id"] + 1)))


def string_counts(nodes: Column, texts: Column) -> Column:
    """For each node the number of ``texts`` (one a string) below it that are not null."""
    sums = prefix_sums(F.transform(texts, lambda t: t.isNotNull().cast("int")))
    return let(sums, lambda s: F.transform(nodes, lambda n: F.get(s, n["s_to"]) - F.get(s, n["s_from"])))


def tag_histogram(parsed: DataFrame) -> DataFrame:
    """Number of elements per tag name."""
    return (
        parsed.select(F.explode(F.transform("dom.nodes", lambda n: n["tag"])).alias("tag"))
        .groupBy("tag").agg(F.count("*").alias("n"))
    )


def text_blocks(parsed: DataFrame, tags: list[str]) -> DataFrame:
    """Elements of some tags with their string and link counts, link verdict and text.

    Counts come from sums over the page, and only the strings of a block leave its row.
    """
    nodes = F.col("dom.nodes")
    texts = F.transform("dom.strings", lambda s: nonempty(strip(s["text"])))
    links = live_counts(nodes, F.transform(nodes, lambda n: (n["tag"] == "a") & has_attribute(n, "href")))

    def blocks(texts: Column, n_links: Column) -> Column:
        each = F.zip_with(nodes, n_links, lambda n, k: F.struct(n.alias("n"), k.alias("n_links")))
        return F.transform(F.filter(each, lambda e: e["n"]["tag"].isin(*tags)), lambda e: F.struct(
            e["n"]["node_id"].alias("node_id"), e["n"]["tag"].alias("tag"), e["n_links"].cast("long").alias("n_links"),
            F.array_compact(F.slice(texts, e["n"]["s_from"] + 1, e["n"]["s_to"] - e["n"]["s_from"])).alias("strings")))

    found = let(texts, lambda ts: let(links, lambda ls: blocks(ts, ls)))
    return (
        parsed.select("page_id", F.explode(found).alias("b")).select("page_id", "b.*")
        .select(
            "page_id", "node_id", "tag",
            F.size("strings").cast("long").alias("n_strings"), "n_links",
            link_heavy(F.col("n_links"), F.size("strings")).alias("is_link_heavy"),
            F.array_join("strings", "\n").alias("text"),
        )
    )


def link_heavy(n_links: Column, n_strings: Column) -> Column:
    """Whether a block is navigation rather than text: it has no strings, more
    than ten links, or more than five at over 0.6 links per string."""
    ratio = n_links / F.nullif(n_strings, F.lit(0))
    return (n_strings == 0) | ((n_links > 5) & (ratio > 0.6)) | (n_links > 10)


def largest_block(blocks: DataFrame) -> DataFrame:
    """Block with the most strings of each page and tag; the first of equals."""
    top = F.max_by(
        F.struct("node_id", "n_strings", "n_links", "is_link_heavy", "text"),
        F.struct(F.col("n_strings"), -F.col("node_id")),
    )
    return blocks.groupBy("page_id", "tag").agg(top.alias("b")).select("page_id", "tag", "b.*")


def meta_entries(nodes: Column) -> Column:
    """Metadata of a page in document order: ``array<struct<key, value>>``.

    The key is the property or name of the element in lower case, or ``charset``.
    """
    entries = F.transform(
        F.filter(nodes, lambda n: n["tag"] == "meta"),
        lambda n: F.struct(
            F.lower(F.coalesce(
                attribute(n, "property"), attribute(n, "name"),
                F.when(has_attribute(n, "charset"), F.lit("charset")),
            )).alias("key"),
            strip(F.coalesce(attribute(n, "content"), attribute(n, "charset"))).alias("value"),
        ),
    )
    return F.filter(entries, lambda e: e["key"].isNotNull() & (e["value"] != ""))


def meta_value(entries: Column, *keys: str) -> Column:
    """First value of the first of some keys that has one."""
    return F.coalesce(*[first_where(entries, lambda e: e["key"] == k)["value"] for k in keys])


def meta_map(nodes: Column) -> Column:
    """Metadata of a page as a map; the first element of a key counts."""
    def as_map(entries: Column) -> Column:
        keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
        return F.map_from_arrays(
            keys, F.transform(keys, lambda k: first_where(entries, lambda e: e["key"] == k)["value"])
        )

    return let(meta_entries(nodes), as_map)


def page_language(nodes: Column, entries: Column) -> Column:
    """Language of the page in two letters from ``<html lang>`` or metadata."""
    declared = nonempty(strip(attribute(first_where(nodes, lambda n: n["tag"] == "html"), "lang")))
    listed = meta_value(entries, "lang", "language", "content-language", "og:locale")
    return F.lower(F.substring(F.coalesce(declared, listed), 1, 2))
