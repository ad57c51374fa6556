"""Exact search for the highest inner products: vectors in buckets by length, and in each
bucket pruning by length or by coordinates, as the local cosine threshold tells."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import stage
from .vectors import floors, matrix, usable

SCALE, TOP, EVERY = 256, 5, 50
#: Numbers that a task holds of its shard of vectors, and rows of one bucket in it.
SHARD_CELLS, BUCKET_ROWS = 2 ** 22, 2 ** 14
#: Lengths in a bucket are at least this part of its longest one.
LEAST_RATIO = 0.9
#: Vectors of the first round; every further round takes in ``GROWTH`` times as many.
FIRST_ROWS, GROWTH = 2_048, 8
#: Queries that one task streams past its shard, and those compared at once.
TASK_QUERIES, CHUNK = 2 ** 20, 256
MOST_PARTITIONS = 20_000
#: Coordinates by which a query prunes; cost of a query's lookup and of a fetched number,
#: as multiplications of a matrix product.
FOCUS, LOOKUP_COST, FETCH_COST = 3, 400_000, 8
#: Allowance for rounding in bounds; products themselves are exact.
_SLACK = 1e-9
_LAST = 2 ** 63 - 1
_NONE = -_LAST
#: Products are held within this.
LARGEST_PRODUCT = _LAST - 1
FOUND = "query long, query_id long, vec_id long, score long"


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of whole-number rows, exact; those beyond a long are cut to
    ``LARGEST_PRODUCT``."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2.0 ** 53:
        return a.astype(float) @ b.astype(float).T
    whole = a.astype(object) @ b.astype(object).T
    return np.clip(whole, -LARGEST_PRODUCT, LARGEST_PRODUCT).astype(np.int64)


def _cosines(threshold: np.ndarray, lengths: np.ndarray, longest: float) -> np.ndarray:
    """Least cosine by which a vector no longer than ``longest`` reaches a threshold."""
    reach = lengths * longest
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(reach > 0, threshold / reach, np.where(threshold <= 0, -np.inf, np.inf))


class Bucket:
    """Vectors of similar length, longest first."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, lengths: np.ndarray) -> None:
        self.ids, self.x, self.lengths = ids, x, lengths
        self._unit = self._order = self._sorted = None
        self.counts = {"pruned": 0, "length": 0, "coordinate": 0}

    def index(self) -> None:
        """Sort each coordinate of the unit vectors; only where a query asks for it."""
        if self._unit is None:
            self._unit = self.x / np.where(self.lengths > 0, self.lengths, 1)[:, None]
            self._order = np.argsort(self._unit, axis=0, kind="stable")
            self._sorted = np.take_along_axis(self._unit, self._order, axis=0)

    def ranges(self, unit: np.ndarray, cosine: float) -> list[tuple[int, int, int, float, float]]:
        """For the query's largest coordinates: rows and bounds between which a unit
        vector's coordinate lies if its cosine with the query is at least ``cosine``."""
        turn = np.arccos(min(1.0, cosine))
        out = []
        for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS]:
            angle = np.arccos(np.clip(unit[f], -1, 1))
            low = np.cos(min(np.pi, angle + turn)) - _SLACK
            high = np.cos(max(0.0, angle - turn)) + _SLACK
            column = self._sorted[:, f]
            out.append((int(f), int(np.searchsorted(column, low)), int(np.searchsorted(column, high, "right")), low, high))
        return sorted(out, key=lambda r: r[2] - r[1])

    def by_coordinates(self, unit: np.ndarray, cosine: float) -> np.ndarray:
        """Rows that may reach ``cosine``: those in the narrowest range, within the other
        ranges, and whose part on these coordinates leaves enough for the rest."""
        (f, begin, end, _, _), *others = self.ranges(unit, cosine)
        rows = self._order[begin:end, f]
        for g, _, _, low, high in others:
            rows = rows[(self._unit[rows, g] >= low) & (self._unit[rows, g] <= high)]
        focus = [f, *(g for g, *_ in others)]
        part = self._unit[np.ix_(rows, focus)]
        left = np.sqrt(np.maximum(0, 1 - (part * part).sum(1))) * np.sqrt(max(0.0, 1 - float((unit[focus] ** 2).sum())))
        return rows[part @ unit[focus] + left >= cosine - _SLACK]

    def switch(self, units: np.ndarray, cosines: np.ndarray, prefix: np.ndarray) -> float:
        """The cosine from which coordinates prune more cheaply than lengths, from the
        costs of up to 16 of the queries."""
        some = np.flatnonzero((cosines > 0) & (cosines <= 1))
        width = self.x.shape[1]
        some = some[prefix[some] * width > LOOKUP_COST]
        if not len(some):
            return np.inf
        self.index()
        some = some[:: -(-len(some) // 16)]
        some = some[np.argsort(cosines[some])]
        length = prefix[some] * width
        ranges = [self.ranges(units[i], cosines[i])[0] for i in some]
        lookup = np.array([LOOKUP_COST + FETCH_COST * width * (end - begin) for _, begin, end, _, _ in ranges])
        costs = np.append(0, np.cumsum(length)) + np.append(np.cumsum(lookup[::-1])[::-1], 0)
        best = int(costs.argmin())
        return float(cosines[some[best]]) if best < len(some) else np.inf


class Best:
    """The highest products of each query of a chunk so far, no id twice."""

    def __init__(self, queries: int, top: int) -> None:
        self.top = top
        self.scores = np.full((queries, top), _NONE, np.int64)
        self.ids = np.full((queries, top), _LAST, np.int64)

    def offer(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Take in products of some of the queries; ``rows`` ascend."""
        touched = np.unique(rows)
        if not len(touched):
            return
        rows = np.concatenate([rows, np.repeat(touched, self.top)])
        scores = np.concatenate([scores.astype(np.int64), self.scores[touched].ravel()])
        ids = np.concatenate([ids, self.ids[touched].ravel()])
        for once in (True, False):
            # First each id's best product, then the best ids.
            order = np.lexsort((-scores, ids, rows) if once else (ids, -scores, rows))
            rows, scores, ids = rows[order], scores[order], ids[order]
            if once:
                first = np.append(True, (rows[1:] != rows[:-1]) | (ids[1:] != ids[:-1])) | (scores == _NONE)
                rows, scores, ids = rows[first], scores[first], ids[first]
        start = np.searchsorted(rows, touched)
        place = np.arange(len(rows)) - np.repeat(start, np.diff(np.append(start, len(rows))))
        kept = place < self.top
        self.scores[rows[kept], place[kept]] = scores[kept]
        self.ids[rows[kept], place[kept]] = ids[kept]


def buckets(ids: np.ndarray, x: np.ndarray, lengths: np.ndarray, top: int) -> list[Bucket]:
    """Cut a shard, longest vectors first, into buckets.

    Of a run of equal vectors only the ``top + 1`` least ids can be among the best of any
    query, its own id aside; the others are left out of the comparison.
    """
    if len(ids):
        same = np.append(False, (x[1:] == x[:-1]).all(1))
        run = np.cumsum(~same)
        order = np.lexsort((ids, run))
        again = np.append(False, (run[order][1:] == run[order][:-1]) & (ids[order][1:] == ids[order][:-1]))
        order = order[~again]
        start = np.searchsorted(run[order], run[order])
        kept = np.sort(order[np.arange(len(order)) - start <= top])
        ids, x, lengths = ids[kept], x[kept], lengths[kept]
    out, begin = [], 0
    while begin < len(ids):
        end = min(begin + BUCKET_ROWS, int(np.searchsorted(-lengths, -LEAST_RATIO * lengths[begin], "right")))
        end = max(end, begin + 1)
        out.append(Bucket(ids[begin:end], x[begin:end], lengths[begin:end]))
        begin = end
    return out


def search(shard: list[Bucket], ids: np.ndarray, q: np.ndarray, lengths: np.ndarray, least: np.ndarray, top: int) -> Best:
    """The best products of some queries in a shard, of those not below ``least``."""
    best = Best(len(ids), top)
    units = q / np.where(lengths > 0, lengths, 1)[:, None]
    least = least.astype(np.int64).copy()
    for bucket in shard:
        longest = float(bucket.lengths[0])
        # What cannot be below any product is no bound.
        bound = np.where(least == _NONE, -np.inf, least.astype(float))
        cosines = _cosines(bound, lengths, longest) - _SLACK
        live = cosines <= 1
        bucket.counts["pruned"] += int((~live).sum())
        with np.errstate(divide="ignore", invalid="ignore"):
            needed = np.where(lengths > 0, bound / lengths, -np.inf) * (1 - _SLACK)
        prefix = np.where(needed > 0, np.searchsorted(-bucket.lengths, -needed, "right"), len(bucket.ids))
        switch = bucket.switch(units[live], cosines[live], prefix[live])
        narrow = live & (cosines > 0) & (cosines >= switch)
        wide = np.flatnonzero(live & ~narrow & (prefix > 0))
        bucket.counts["length"] += len(wide)
        bucket.counts["coordinate"] += int(narrow.sum())
        if len(wide):
            rows = int(prefix[wide].max())
            products = _exact(q[wide], bucket.x[:rows])
            own = ids[wide][:, None] == bucket.ids[None, :rows]
            reach = np.maximum(least[wide], _NONE + 1).astype(products.dtype)
            if rows > top + 1 and len(np.unique(bucket.ids)) == len(bucket.ids):
                # One of these may be the query's own.
                reach = np.maximum(reach, np.partition(products, rows - top - 1, axis=1)[:, rows - top - 1])
            at, column = np.nonzero((products >= reach[:, None]) & ~own)
            best.offer(wide[at], products[at, column], bucket.ids[column])
        for i in np.flatnonzero(narrow):
            rows = bucket.by_coordinates(units[i], cosines[i])
            rows = rows[bucket.ids[rows] != ids[i]]
            products = _exact(q[i:i + 1], bucket.x[rows])[0]
            fit = products >= least[i]
            best.offer(np.full(int(fit.sum()), i), products[fit], bucket.ids[rows][fit])
        least = np.maximum(least, best.scores[:, -1])
    return best


def _searched(width: int, top: int) -> Callable:
    """Read the vectors of each cell, then stream its queries past them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, shard, held = None, None, []
        for batch in batches:
            cells, queries = batch.column("cell").to_numpy(), batch.column("is_query").to_numpy(zero_copy_only=False)
            x, lengths = matrix(batch.column("v"), width), batch.column("length").to_numpy()
            ids = batch.column("vec_id").fill_null(_LAST).to_numpy()
            edges = np.flatnonzero(np.append(True, (cells[1:] != cells[:-1]) | (queries[1:] != queries[:-1]))) if len(cells) else []
            for begin, end in zip(edges, [*edges[1:], len(cells)], strict=True):
                if cells[begin] != cell:
                    cell, shard, held = cells[begin], None, []
                if not queries[begin]:
                    held.append((ids[begin:end], x[begin:end], lengths[begin:end]))
                    continue
                if shard is None:
                    shard = buckets(*map(np.concatenate, zip(*held, strict=True)), top) if held else []
                    held = []
                for at in range(begin, end, CHUNK):
                    part = slice(at, min(at + CHUNK, end))
                    least = batch.column("least").slice(at, part.stop - at).fill_null(_NONE).to_numpy()
                    best = search(shard, ids[part], x[part], lengths[part], least, top)
                    row, place = np.nonzero(best.scores != _NONE)
                    found = best.ids[row, place]
                    yield pa.RecordBatch.from_pydict({
                        "query": batch.column("row").slice(at, part.stop - at).take(pa.array(row)),
                        "query_id": pa.array(ids[part][row]),
                        "vec_id": pa.array(found, mask=found == _LAST),
                        "score": pa.array(best.scores[row, place])})
    return run


def _best(found: DataFrame, top: int) -> DataFrame:
    """The ``top`` highest products of each query, ties to the smaller id."""
    once = found.groupBy("query", "query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query", "query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def top_products(table: DataFrame, top: int = TOP, every: int = EVERY, scale: int = SCALE) -> DataFrame:
    """The highest inner products of every query among all vectors, exactly.

    ``table`` has vec_id and embedding; a component becomes ``floor(scale * c)``. Queries
    are the rows whose id is divisible by ``every``; candidates are all rows of other ids.
    Returns query_id, rank (from 1), vec_id, score, ties to the smaller id; all candidates
    where there are fewer than ``top``.

    The vectors are sorted by length over the whole table and dealt into shards of bounded
    size; equal vectors lie side by side and are cut as evenly as all others. Rounds over
    geometrically growing numbers of shards, longest vectors first, each start with the
    products found before as thresholds: a query goes only to shards whose longest vector
    can still reach its threshold, so few new products leave a round. In a task, queries
    stream past the buckets of a shard. From the cosine that a query needs in a bucket
    follows whether lengths or coordinates prune it, and what is left is multiplied.

    Null vectors and those with null or non-finite components take no part. Short vectors
    have zeros where others are longer, so an empty vector has product 0 with all. Rows
    that share an id and a vector are one row; an id is found once a query, with its best
    product. Rows that share an id but not the vector are queries of their own. Rows
    without an id are no queries; as results they stand as one and lose ties. Components
    beyond 2**50 count as that, products beyond a long as ``LARGEST_PRODUCT``. An empty table, and
    one whose queries have no candidates, gives no rows. Other columns are ignored.
    """
    spark = table.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    squares = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    vectors = table.filter(usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), floors(F.col("embedding"), scale).alias("v")).select(
        "vec_id", "v", F.size("v").alias("width"), F.sqrt(squares).alias("length"), F.xxhash64("v").alias("hash"))
    order = [F.desc("length"), F.asc("hash"), F.asc_nulls_last("vec_id")]
    row = F.monotonically_increasing_id()
    sorted_ = stage(
        vectors.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select(
            "vec_id", "v", "width", "length", row.alias("row"), F.spark_partition_id().alias("part")), "by-length")
    width = sorted_.agg(F.max("width")).first()[0]
    if width is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows = max(1, SHARD_CELLS // max(1, width))
    shard = F.floor(F.col("row").bitwiseAND(F.lit((1 << 33) - 1)) / rows)
    dealt = sorted_.withColumn("sub", shard)
    # One row a shard: its place in the order of lengths and the vectors before it.
    before = Window.orderBy("part", "sub")
    shards = stage(
        dealt.groupBy("part", "sub").agg(F.count("*").alias("n"), F.max("length").alias("longest")).select(
            "part", "sub", "n", "longest", (F.row_number().over(before) - 1).alias("shard"),
            (F.sum("n").over(before) - F.col("n")).alias("before")), "shards")
    queries = stage(
        sorted_.filter(F.col("vec_id") % every == 0).groupBy("vec_id", "v").agg(
            F.min("row").alias("row"), F.first("length").alias("length")), "queries")
    asked = queries.count()
    found, begin, size = None, 0, FIRST_ROWS
    while asked:
        known = queries.withColumn("least", F.lit(None).cast("long"))
        reachable = F.lit(True)
        if found is not None:
            least = found.groupBy("query").agg(F.when(F.count("*") >= top, F.min("score")).alias("least"))
            known = queries.join(least, queries["row"] == least["query"], "left").drop("query")
            # A threshold of zero or less, or none, can be reached from any length.
            far = F.when(F.col("least") > 0, F.col("least") / F.col("length")).otherwise(F.lit(0.0))
            needed = known.agg(F.min(far).alias("needed")).first().needed
            reachable = F.col("longest") * (1 + _SLACK) >= needed
        own = shards.filter((F.col("before") >= begin) & (F.col("before") < size) & reachable)
        span = own.agg(
            F.count("*").alias("n"), F.min("shard").alias("first"), F.max("shard").alias("last"),
            F.min("part").alias("low"), F.max("part").alias("high")).first()
        if span.n:
            # As many divisions of the queries as give every task a cell.
            split = max(-(-asked // TASK_QUERIES), -(-tasks // span.n))
            cell = (F.col("shard") - span.first) * split + F.col("division")
            division = F.pmod(F.xxhash64("row"), F.lit(split)).cast("int")
            heads = F.broadcast(own.select("part", "sub", "shard", "longest"))
            here = dealt.filter(F.col("part").between(span.low, span.high)).join(heads, ["part", "sub"]).withColumn(
                "division", F.explode(F.sequence(F.lit(0), F.lit(split - 1)))).select(
                cell.alias("cell"), F.lit(False).alias("is_query"), "row", "vec_id", "v", "length",
                F.lit(None).cast("long").alias("least"))
            every_shard = F.explode(F.sequence(F.lit(span.first), F.lit(span.last))).alias("shard")
            meeting = known.select("*", division.alias("division"), every_shard).join(heads, "shard").filter(
                F.col("least").isNull() | (F.col("least") <= 0)
                | (F.col("longest") * F.col("length") * (1 + _SLACK) >= F.col("least")))
            asking = meeting.select(cell.alias("cell"), F.lit(True).alias("is_query"), "row", "vec_id", "v", "length", "least")
            partitions = min(span.n * split, MOST_PARTITIONS)
            cells = here.unionByName(asking).repartitionById(
                partitions, F.pmod("cell", F.lit(partitions)).cast("int")).sortWithinPartitions("cell", "is_query", "row")
            new = cells.mapInArrow(_searched(width, top), FOUND)
            if found is not None:
                new = new.unionByName(found.select("query", "query_id", "vec_id", "score"))
            found = stage(_best(new, top), "found")
        if not shards.filter((F.col("before") >= size) & reachable).limit(1).count():
            break
        begin, size = size, size * GROWTH
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return found.select("query_id", "rank", "vec_id", "score")


SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
products AS (
  SELECT q.vec_id AS query_id, x.vec_id AS vec_id, list_inner_product(q.v, x.v)::BIGINT AS score
  FROM vectors q JOIN vectors x ON q.vec_id % 50 = 0 AND q.vec_id <> x.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM products)
WHERE rank <= 5
"""
