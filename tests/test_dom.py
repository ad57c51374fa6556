import pyarrow.parquet as pq
import pytest

from pressloom.operators import dom as D

SF = "/root/testdata/sf0.001"


def parse(html, drop=(), plain=True, monkeypatch=None):
    out = D._Columns()
    tree_error = None
    if plain:
        tree_error = D._read_page(out, html, frozenset(drop))
    else:
        tree = D._Tree(out, frozenset(drop))
        tree.feed(html)
        tree.close()
        tree.finish()
    out.node_offsets.append(len(out.node_id))
    out.string_offsets.append(len(out.string_node))
    out.error.append(tree_error)
    out.present.append(True)
    return out.to_arrow().to_pylist()[0]


def shape(dom):
    return [(n["tag"], n["parent_id"], n["end_id"]) for n in dom["nodes"]], [
        (s["node_id"], s["text"]) for s in dom["strings"]
    ]


def test_void_and_unclosed_and_unmatched():
    got = shape(parse("<div>a<br>b<b>c<p>d</div></i>e"))
    assert got == (
        [("div", None, 3), ("br", 0, 1), ("b", 0, 3), ("p", 2, 3)],
        [(0, "a"), (0, "b"), (2, "c"), (3, "d"), (-1, "e")],
    )


def test_dropped_element_joins_its_neighbours():
    got = shape(parse("<p>a<aside>x<b>y</aside>b<!-- c -->d</p>", drop=["aside"]))
    assert got == ([("p", None, 0)], [(0, "ab"), (0, "d")])


def test_dropped_element_closed_by_its_parent():
    got = shape(parse("<p>a<aside>x</p>b", drop=["aside"]))
    assert got == ([("p", None, 0)], [(0, "a"), (-1, "b")])


def test_script_text_is_no_text():
    got = shape(parse('<p>a</p><script>if (a</b) x("</p>")</script><style>p{}</style><p>b</p>'))
    assert [s for _, s in got[1]] == ["a", "b"] and [n[0] for n in got[0]] == ["p", "script", "style", "p"]


def test_attributes():
    dom = parse('<a CLASS="x  y" href="/q?a=1&amp;b" data-x checked rel=author id=\'i\' id="j">t</a>')
    assert [(a["name"], a["is_list"], a["values"]) for a in dom["nodes"][0]["attrs"]] == [
        ("class", True, ["x", "y"]), ("href", False, ["/q?a=1&b"]), ("data-x", False, [""]),
        ("checked", False, [""]), ("rel", True, ["author"]), ("id", False, ["j"]),
    ]


@pytest.mark.parametrize("html", [
    "", "text only", "a & b &copy; &lt;c&gt; &#8217;", "<p", "<p x=>y</p>", "<p x='1\"2'>y", "< p>q</p>",
    "<!DOCTYPE html><html><!-- a -- b --><p>x</p>", "<!--><p>x</p>-->", "<!-- x --!><p>y</p>-->",
    "<title>a & b</title>", "<title>a <b>c</b></title>", "<textarea><p>x</p></textarea>",
    "<script>a<!-- </script> --></script><p>x", "<SCRIPT>x</SCRIPT ><p>y", "<script>never closed <p>x</p>",
    "<div/>a<br/>b</br>c", "<p>a</p >b</ p>c</>d", "<?php x ?><p>y", "<![CDATA[x]]><p>y", "<a b=c/d>e</a>",
    "<p\x0bx>y", "<p>\n \n</p>", "a<b>c", "<iframe><p>x</p></iframe>y", "x &amp", "<style/>p{}</style>q",
    "<ruby>a<rt>b</rt></ruby>", "<template><p>x</p></template>y", "<noscript><p>x</p></noscript>",
])
@pytest.mark.parametrize("drop", [(), ("p",)])
def test_fast_path_equals_general_parser(html, drop):
    assert parse(html, drop) == parse(html, drop, plain=False)


def test_fast_path_equals_general_parser_on_pages():
    pages = pq.read_table(f"{SF}/pages.parquet").column("html").to_pylist()
    for i, html in enumerate(pages):
        for text in (html, html[: len(html) * (i % 7 + 1) // 8], html.replace("</p>", "<p", i % 3)):
            assert parse(text, ("script",)) == parse(text, ("script",), plain=False)


def lineage(dom, node):
    line = [node["node_id"]]
    while dom["nodes"][line[-1]]["parent_id"] is not None:
        line.append(dom["nodes"][line[-1]]["parent_id"])
    return line


def test_subtree_ranges():
    dom = parse("<div><p>a</p>b<ul><li>c</ul>d</div>")
    for n in dom["nodes"]:
        below = [m["node_id"] for m in dom["nodes"] if n["node_id"] in lineage(dom, m)]
        assert below == list(range(n["node_id"], n["end_id"] + 1))
        owned = [i for i, s in enumerate(dom["strings"]) if s["node_id"] in below]
        assert owned == list(range(n["s_from"], n["s_to"]))


def test_unquoted_attributes_equal_general_parser():
    for html in ("<a b=c d=e>x</a>", "<a b=c d='e' f>x</a>", "<a s=sss t=s>x</a>"):
        assert parse(html) == parse(html, plain=False)
