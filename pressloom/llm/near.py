"""Near duplicates: ProbMinHash sketches of weighted and of plain shingles, banding, exact
verification of candidate pairs, and classes of linked documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import stage
from .words import hash_words, scramble, split_words, window_hashes

SHINGLE = 5
BANDS = 32
ROWS = 6
SLOTS = BANDS * ROWS
LEAST = 0.8
#: Estimates below this are not compared in the second search: four standard
#: deviations under ``LEAST`` for ``SLOTS`` slots.
LEAST_ESTIMATE = LEAST - 4 * (LEAST * (1 - LEAST) / SLOTS) ** 0.5
#: Partners of one hub; members and searching members of one comparison.
PER_HUB, PER_CHUNK, PER_BLOCK = 512, 512, 1024
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of five words, ascending, and their weights: one
    plus the log of how often each occurs, so that a phrase said a thousand times is
    not most of a text. A text of fewer words is one shingle; one without words has
    none."""
    words = split_words(text)
    hashes = window_hashes(hash_words(words), min(SHINGLE, len(words))) if words else np.empty(0, np.uint64)
    items, counts = np.unique(hashes, return_counts=True)
    return items, 1 + np.log(counts)


def sketch(items: np.ndarray, weights: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Winner of each slot: two weighted sets agree in a slot with the chance of their
    probability Jaccard similarity.

    Every element is a Poisson process of rate ``weight``: its arrivals follow from
    its hash alone and each falls in a random slot, which keeps the earliest. Arrivals
    are drawn in rounds for all elements at once; an element stops as soon as its next
    arrival is later than the worst slot, where it can no longer win anything.
    """
    best, winner = np.full(slots, np.inf), np.zeros(slots, np.uint64)
    at, drawn = np.zeros(len(items)), 0
    while len(items):
        more = max(1, -(-2 * slots // len(items)))
        draws = np.arange(drawn + 1, drawn + 1 + more, dtype=np.uint64) * _STEP
        random = scramble(items[:, None] + draws)
        gaps = -np.log(((random >> np.uint64(11)) + 0.5) * 2.0 ** -53) / weights[:, None]
        times = at[:, None] + np.cumsum(gaps, axis=1)
        slot = (scramble(random + _STEP) % np.uint64(slots)).astype(np.int64).ravel()
        order = np.argsort(-times, axis=None)
        first, who = np.full(slots, np.inf), np.zeros(slots, np.uint64)
        first[slot[order]] = times.ravel()[order]
        who[slot[order]] = items[order // more]
        won = first < best
        best[won], winner[won] = first[won], who[won]
        at, drawn = times[:, -1], drawn + more
        going = at < best.max()
        items, weights, at = items[going], weights[going], at[going]
    return winner


def bands(winner: np.ndarray) -> np.ndarray:
    """One hash per band of ``ROWS`` slots; the band's number is part of it."""
    rows = winner.reshape(-1, ROWS)
    out = np.arange(1, len(rows) + 1, dtype=np.uint64)
    for j in range(ROWS):
        out = scramble(out * _STEP + rows[:, j])
    return out.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[float, float]:
    """Jaccard similarity of the shingle sets, and probability Jaccard similarity of
    the weighted ones."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0, 0.0
    plain = len(common) / (len(a[0]) + len(b[0]) - len(common))
    if a[1].max() == 1 and b[1].max() == 1:
        return plain, plain
    # For an element d of both: 1 / sum over all e of max(a_e / a_d, b_e / b_d). With
    # the elements in order of a_e / b_e, b decides before d and a after it.
    x, y = a[1][i], b[1][j]
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    ahead = np.cumsum(y)
    behind = x.sum() - np.cumsum(x)
    only_a, only_b = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    return plain, float((1 / ((behind + only_a) / x + (ahead + only_b) / y)).sum())


def sketches(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint (128 bits of its words), band hashes and the low
    16 bits of each slot; null where it has no words.

    A text that repeats a shingle has a second sketch with all weights 1, whose bands
    follow those of the first, null where they are the same, and so do its marks. Other
    texts have one sketch for both similarities.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, first, second, keys, marks = [], [], [], [], []
            for i, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = split_words(text)
                ids.append(i)
                if not words:
                    for column in (first, second, keys, marks):
                        column.append(None)
                    continue
                whole = xxhash.xxh3_128_digest(b" ".join(words))
                items, weights = shingles(text)
                won = sketch(items, weights)
                own = bands(won)
                buckets, slots = own.tolist(), [won]
                if (weights != 1).any():
                    plain = sketch(items, np.ones(len(items)))
                    buckets += [p if p != o else None for p, o in zip(bands(plain).tolist(), own.tolist())]
                    slots.append(plain)
                first.append(int.from_bytes(whole[:8], "big", signed=True))
                second.append(int.from_bytes(whole[8:], "big", signed=True))
                keys.append(buckets)
                marks.append((np.concatenate(slots) & np.uint64(0xFFFF)).astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()),
                pa.array(keys, pa.list_(pa.int64())), pa.array(marks, pa.binary()),
            ], ["doc_id", "f1", "f2", "bands", "marks"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, f1 long, f2 long, bands array<long>, marks binary"
    )


def verified(pairs: DataFrame, texts: DataFrame, least: float = LEAST) -> DataFrame:
    """Those of the pairs (a, b) that are similar enough, by their whole texts.

    A hub ``a`` of many pairs is copied to as many salted keys as keep ``PER_HUB``
    partners together, so no key holds more.
    """
    load = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PER_HUB).cast("int").alias("__salts"))
    dealt = pairs.join(load, "a").withColumn("__salt", F.pmod(F.xxhash64("b"), F.col("__salts")).cast("int"))
    hubs = load.join(texts.withColumnRenamed("node", "a"), "a").select(
        "a", F.col("text").alias("__text_a"), F.explode(F.sequence(F.lit(0), F.col("__salts") - 1)).alias("__salt")
    )
    partners = texts.select(F.col("node").alias("b"), F.col("text").alias("__text_b"))
    both = dealt.join(partners, "b").join(hubs, ["a", "__salt"]).select("a", "b", "__text_a", "__text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, hub = None, None
        for batch in batches:
            keep_a, keep_b = [], []
            for a, b, text_a, text_b in zip(*(batch.column(k) for k in range(4))):
                a = a.as_py()
                if last != a:
                    last, hub, own = a, shingles(text_a.as_py()), text_a
                elif text_a != own:
                    hub, own = shingles(text_a.as_py()), text_a
                if max(similarity(hub, shingles(text_b.as_py()))) >= least:
                    keep_a.append(a)
                    keep_b.append(b.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(keep_a, pa.int64()), pa.array(keep_b, pa.int64())], ["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of every node of the links (a, b): ``comp`` is the least node it is
    connected with. Each round takes the least label among the neighbours and then
    the label of that label, which halves the way left."""
    edges = stage(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stage(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("comp")).select(
        "node", F.least("node", "comp").alias("comp")), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("comp").alias("__near")
        )
        step = labels.join(near, "node").select("node", F.col("comp").alias("__old"), F.least("comp", "__near").alias("comp"))
        jump = step.select(F.col("node").alias("comp"), F.col("comp").alias("__next"))
        moved = stage(
            step.join(jump, "comp").select("node", F.least("comp", "__next").alias("comp"), "__old"), "labels"
        )
        labels = moved.select("node", "comp")
        if not moved.filter("comp != __old").limit(1).count():
            return labels


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Groups of equal keys from sorted batches, each whole."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = np.column_stack([batch.column(k).to_numpy() for k in keys])
        edges = np.flatnonzero((columns[1:] != columns[:-1]).any(1)) + 1
        for start, end in zip([0, *edges], [*edges, batch.num_rows]):
            now = tuple(columns[start])
            if held and now != key:
                yield pa.Table.from_batches(held)
                held = []
            key = now
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def _joining_links(group: pa.Table, least: float) -> Iterator[tuple[int, int]]:
    """Links of one comparison that join two components.

    Every searching row meets all rows of other components that are likely enough by
    their slots, the likeliest first; components joined on the way need no second link.
    A pair is as likely as the better of its two sketches says. It counts in the first
    band it shares, and two searching rows once.
    """
    node, comp = group["node"].to_pylist(), group["comp"].to_pylist()
    both = [m if len(m) > 2 * SLOTS else m + m for m in map(bytes, group["marks"].to_pylist())]
    marks = np.frombuffer(b"".join(both), "<u2").reshape(len(node), 2, BANDS, ROWS)
    # Bands of one sketch also meet those of the other.
    kinds = [(0, 0)] if (marks[:, 0] == marks[:, 1]).all() else [(0, 0), (1, 1), (0, 1), (1, 0)]
    seeks, outside = (group[c].to_numpy(zero_copy_only=False) for c in ("seeks", "outside"))
    there = np.flatnonzero(~seeks)
    band = group["band"][0].as_py()
    joined: dict[int, int] = {}
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def root(c: int) -> int:
        while joined.get(c, c) != c:
            c = joined[c]
        return c

    def profile(i: int) -> tuple[np.ndarray, np.ndarray]:
        if node[i] not in known:
            known[node[i]] = shingles(group["text"][i].as_py())
        return known[node[i]]

    for i in np.flatnonzero(seeks).tolist():
        same = [marks[there, p] == marks[i, q] for p, q in kinds]
        share = np.max([x.mean((1, 2)) for x in same[:2]], axis=0)
        likely = (share >= least) & (np.any([x.all(2) for x in same], axis=0).argmax(1) == band)
        for k in np.argsort(-share, kind="stable").tolist():
            j = int(there[k])
            if likely[k] and not (outside[j] and node[j] <= node[i]) and root(comp[i]) != root(comp[j]):
                if max(similarity(profile(i), profile(j))) >= LEAST:
                    joined[root(comp[j])] = root(comp[i])
                    yield min(node[i], node[j]), max(node[i], node[j])


def remaining_links(members: DataFrame, labels: DataFrame, nodes: DataFrame, least: float = LEAST_ESTIMATE) -> DataFrame:
    """Verified links (a, b) that still join components which meet in a bucket.

    ``members`` is (bucket, band, node, hub), ``nodes`` (node, marks, text). Hubs have
    been compared with all of their bucket. Of the rest, members outside the bucket's
    largest component search all other members; a large bucket is divided into blocks
    of searching rows and chunks of the others, which meet once each. Nothing but links
    leaves a comparison, at most one for every component it joins.
    """
    known = members.filter("node != hub").select("bucket", "band", "node").join(labels, "node", "left").select(
        "bucket", "band", "node", F.coalesce("comp", "node").alias("comp")
    )
    sizes = known.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    split = sizes.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("comps"), F.sum("n").alias("n"), F.max("n").alias("most"),
        F.max(F.struct("n", "comp")).getField("comp").alias("main"),
    ).filter("comps > 1").select(
        "bucket", "main", F.ceil(F.col("n") / PER_CHUNK).cast("int").alias("chunks"),
        F.ceil((F.col("n") - F.col("most")) / PER_BLOCK).cast("int").alias("blocks"),
    )
    rows = known.join(split, "bucket").withColumn("outside", F.col("comp") != F.col("main"))
    columns = ["bucket", "band", "block", "chunk", "node", "comp", "seeks", "outside"]
    seeking = rows.filter("outside").withColumn("block", F.pmod(F.xxhash64(F.lit(1), "node"), F.col("blocks")).cast("int")).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn("seeks", F.lit(True))
    others = rows.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("seeks", F.lit(False))
    keys = ["bucket", "block", "chunk"]
    dealt = seeking.select(*columns).unionByName(others.select(*columns)).join(nodes, "node").select(*columns, "marks", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, keys):
            links = list(_joining_links(group, least))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], ["a", "b"])

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Class of every document: (doc_id, class_id, copy_of), one row per input row.

    Documents are linked if the Jaccard similarity of their sets of five-word shingles,
    or the probability Jaccard similarity of the weighted shingles, is 0.8 or more;
    ``class_id`` is the least doc_id a document is connected with. ``copy_of`` is the
    least doc_id with the same words. Documents of the same words are one node from the
    start, so a group of copies costs one row whatever its size.

    In every bucket of a band all members are compared with its least one (its hub).
    In buckets whose other members still lie in several components, every pair across
    components is compared unless its slots put both similarities four standard
    deviations below 0.8. A pair at 0.8 by either similarity shares none of the bands of
    that similarity's sketches with a chance of 6e-5.

    Null texts and texts without words are alone in their class. Rows without doc_id
    get null classes. Rows that share a doc_id are one document: they get one class. Long
    texts are sketched whole. Ties go to the least doc_id. Other columns are ignored. No
    documents give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    drawn = stage(sketches(docs), "sketches")
    copies = Window.partitionBy("f1", "f2").orderBy("doc_id")
    nodes = stage(
        drawn.filter("f1 is not null and doc_id is not null").withColumn("__rank", F.row_number().over(copies))
        .filter("__rank = 1").drop("__rank"), "nodes",
    )
    drawn = drawn.select("doc_id", "f1", "f2")
    banded = nodes.select(F.posexplode("bands").alias("at", "bucket"), F.col("doc_id").alias("node")).filter(
        "bucket is not null").select((F.col("at") % BANDS).alias("band"), "bucket", "node")
    shared = banded.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("__last")).filter("hub < __last")
    members = stage(banded.join(shared.drop("__last"), "bucket"), "members")
    chosen = members.select("node").distinct()
    firsts = nodes.select("doc_id", "f1", "f2").join(chosen.withColumnRenamed("node", "doc_id"), "doc_id", "left_semi")
    texts = stage(
        docs.join(firsts.select("doc_id").distinct(), "doc_id").select(F.col("doc_id").alias("node"), "text"), "texts"
    )
    links = stage(verified(
        members.filter("node != hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), texts
    ), "links")
    labels = components(links)
    marks = nodes.select(F.col("doc_id").alias("node"), "marks").dropDuplicates(["node"])
    found = stage(remaining_links(members, labels, marks.join(texts, "node")), "links")
    if found.limit(1).count():
        labels = components(links.unionByName(found))
    classes = nodes.select("f1", "f2", F.col("doc_id").alias("copy_of")).join(
        labels.withColumnRenamed("node", "copy_of"), "copy_of", "left"
    )
    return drawn.join(classes, ["f1", "f2"], "left").select(
        "doc_id", F.coalesce("comp", "copy_of", "doc_id").alias("class_id"), F.coalesce("copy_of", "doc_id").alias("copy_of"),
    )


def first_of_class(docs: DataFrame) -> DataFrame:
    """The documents that are the least of their class, once each; rows without doc_id
    stay."""
    classes = near_duplicates(docs)
    kept = classes.filter("doc_id = class_id").select("doc_id").distinct()
    named = docs.filter("doc_id is not null").join(kept, "doc_id", "left_semi")
    once = named.withColumn("__row", F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))).filter("__row = 1")
    return once.select(*docs.columns).unionByName(docs.filter("doc_id is null"))
