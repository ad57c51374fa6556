import pyarrow as pa
from pyspark.sql import functions as F

from pressloom import vocab
from pressloom.functions.batches import PIECE_BYTES, pieces
from pressloom.operators import content
from pressloom.operators import dom as D


def test_pieces_are_bounded_and_keep_all_rows_in_order():
    rows = pa.array(["x" * n for n in (0, 10, 500, 20, 20, 0, 700, 5)] + [None, "y"])
    parts = list(pieces(rows, 100))
    assert pa.concat_arrays(parts).equals(rows)
    assert all(len(p) == 1 or p.nbytes <= 100 for p in parts)
    batch = pa.record_batch({"a": pa.array([["k" * 30, "l"]] * 9), "b": pa.array(range(9))})
    parts = list(pieces(batch, 100))
    assert len(parts) > 3 and all(len(p) == 1 or p.nbytes <= 100 for p in parts)
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
    assert [len(p) for p in pieces(rows.slice(0, 0))] == [0]


def test_no_task_holds_the_trees_of_a_whole_batch():
    html = "<div class='a b'><p>some words</p><br>tail</div>"
    rows = [None, ""] + [html * (i % 7) for i in range(60_000)]
    pages = pa.array(rows, pa.string())
    got = list(D._parse_batches(iter([pages, pages.slice(0, 3)]), frozenset()))
    sizes = [len(g) for g in got]
    assert sum(sizes) == len(rows) + 3 and sizes[-1] == 3
    # Pieces of the markup, not the batch, become Python objects.
    assert len(sizes) > pages.nbytes / PIECE_BYTES
    assert pa.concat_arrays(got[:-1]).equals(D._parse_batch(pages, frozenset()))


def test_parse_and_body_are_the_same_in_many_pieces(spark):
    """One partition whose batches hold several pieces, pages of all sizes among them."""
    line = "<p>Storm warning for the coast, with words enough to fill a line of the page.</p>"
    size = F.when(F.col("id") % 50 == 0, 2000).otherwise(F.col("id") % 5 * 10).cast("int")
    html = F.concat(F.lit("<html><body><h1>Storm "), F.col("id"), F.lit("</h1><article>"),
                    F.repeat(F.lit(line), size), F.lit("</article></body></html>"))
    pages = spark.range(400).coalesce(1).select("id", F.when(F.col("id") % 41 != 7, html).alias("html"), size.alias("n"))
    got = pages.select("id", "n", D.parse_html(F.col("html")).alias("dom")).collect()
    assert len(got) == 400
    for r in got:
        if r.id % 41 == 7:
            assert r.dom is None
        else:
            assert r.dom.strings[0].text == f"Storm {r.id}" and len(r.dom.nodes) == 4 + r.n
    lists = F.struct(F.array(F.array_repeat(F.lit("storm warning reached northern coast towns before midnight"), F.col("n"))).alias("first"),
                     F.lit(None).cast("array<array<string>>").alias("second"))
    rows = pages.select("id", "n", F.lit("Storm coast").alias("title"), F.lit("en").alias("site_lang"),
                        F.when(F.col("n") > 0, lists).alias("candidates"))
    bodies = content.with_content(rows).collect()
    assert [r.id for r in bodies] == list(range(400))
    stop, invalid = frozenset(vocab.STOPWORDS_EN), content._Words(vocab.CONTENT_INVALID_KEYS)
    want = {n: content.body_text([["storm warning reached northern coast towns before midnight"] * n], None, ["storm", "coast"], stop, invalid) if n else None
            for n in {r.n for r in bodies}}
    assert want[2000] and all(r.content == want[r.n] for r in bodies)
