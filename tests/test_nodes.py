import random
import time

import pytest
from pyspark.sql import functions as F

from pressloom.functions.columns import prefix_sums, running
from pressloom.operators import content, nodes
from pressloom.operators.dom import parse_html

TAGS = ["div", "article", "p", "span", "section", "a", "ul", "nav"]
ATTRS = ["", "", "", ' class="content"', ' class="comment"', ' id="main"', ' href="/x"', ' class="newsletter content"']


def markup(rng, depth=0):
    out = []
    for _ in range(rng.randint(1, 5)):
        if rng.random() < 0.45 or depth > 7:
            out.append(" ".join(rng.choice(["storm", "coast", "rain", " "]) for _ in range(rng.randint(1, 30))))
        else:
            tag = rng.choice(TAGS)
            out.append(f"<{tag}{rng.choice(ATTRS)}>{markup(rng, depth + 1)}</{tag}>")
    return " ".join(out)


@pytest.fixture(scope="module")
def parsed(spark):
    rng = random.Random(7)
    rows = [(i, f"before <body>{markup(rng)}{markup(rng)}</body>" if i % 3 else markup(rng)) for i in range(60)]
    rows += [(60, ""), (61, None), (62, "text only")]
    df = spark.createDataFrame(rows, "page_id long, html string").repartition(4)
    return df.select("page_id", parse_html(F.col("html")).alias("dom"))


def lineage(dom, node):
    line = []
    while node.parent_id is not None:
        node = dom.nodes[node.parent_id]
        line.append(node.node_id)
    return line[::-1]


def test_node_rows_match_the_tree(parsed):
    doms = {r.page_id: r.dom for r in parsed.collect() if r.dom is not None}
    dropped = {i: [n for n in d.nodes if n.tag in ("nav", "ul")] for i, d in doms.items()}
    want, left = {}, set()
    for i, d in doms.items():
        for n in d.nodes:
            own = [(k, s.text.strip()) for k, s in enumerate(d.strings) if s.node_id == n.node_id and s.text.strip()]
            want[i, n.node_id] = (n.parent_id, lineage(d, n), n.tag, n.depth, n.end_id, own)
            if not any(r.node_id <= n.node_id <= r.end_id for r in dropped[i]):
                left.add((i, n.node_id))
    table = nodes.node_table(parsed)
    got = {(r.page_id, r.node_id): (r.parent_id, r.path, r.tag, r.depth, r.end_id, [tuple(s) for s in r.own_strings]) for r in table.collect()}
    assert got == want
    in_row = nodes.node_table(parsed, lambda n: n["tag"].isin("nav", "ul"))
    by_rows = nodes.drop_tags(table, ["nav", "ul"])
    for df in (in_row, by_rows):
        assert {(r.page_id, r.node_id) for r in df.select("page_id", "node_id").collect()} == left
    plan = in_row._jdf.queryExecution().toString()
    assert "Join" not in plan


def test_counts_of_blocks_match_the_tree(parsed):
    doms = {r.page_id: r.dom for r in parsed.collect() if r.dom is not None}
    got = {(r.page_id, r.node_id): (r.n_strings, r.n_links, r.text) for r in nodes.text_blocks(parsed, ["div", "article"]).collect()}
    want = {}
    for i, d in doms.items():
        for n in d.nodes:
            if n.tag in ("div", "article"):
                texts = [s.text.strip() for s in d.strings[n.s_from:n.s_to] if s.text.strip()]
                links = sum(m.tag == "a" and any(a.name == "href" for a in m.attrs) for m in d.nodes[n.node_id + 1:n.end_id + 1])
                want[i, n.node_id] = (len(texts), links, "\n".join(texts))
    assert got == want


def test_running_folds(values):
    rows = [(list(range(n)),) for n in (0, 1, 127, 128, 129, 700)] + [(None,)]
    got = values(rows, "v array<int>", running(F.col("v"), F.lit(0), lambda a, x: F.greatest(a, x % 97)))
    for (row,), out in zip(rows, got, strict=True):
        state, want = 0, []
        for x in row or []:
            state = max(state, x % 97)
            want.append(state)
        assert out == (None if row is None else want)
    sums = values(rows[:4], "v array<int>", prefix_sums(F.col("v")))
    assert [s[-1] for s in sums] == [sum(r) for (r,) in rows[:4]] and sums[0] == [0]


@pytest.mark.parametrize("shape", ["flat", "content", "deep"])
def test_time_is_in_proportion_to_the_elements(spark, shape):
    def page(n):
        if shape == "deep":
            return "<font>" * 150 + "x" + "<p>a</p>" * n
        block = '<p class="content">some words of text</p>' if shape == "content" else "<p>a</p>b"
        return f"<body><article>{block * n}</article></body>"

    def seconds(n):
        df = spark.createDataFrame([(1, page(n))], "page_id long, html string").select(
            "page_id", parse_html(F.col("html")).alias("dom"))
        began = time.perf_counter()
        assert nodes.node_table(df).agg(F.count("tag"), F.max(F.size("own_strings"))).first()[0] >= n
        if shape != "deep":
            df.select(content.candidate_nodes(F.col("dom")).alias("c")).select(F.to_json(content.candidate_lists(F.col("c")))).collect()
        return time.perf_counter() - began

    seconds(500)
    few, many = seconds(3_000), seconds(12_000)
    assert many < 6 * few + 3
