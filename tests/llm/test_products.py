from fractions import Fraction
from math import floor

import numpy as np
import pytest

from pressloom.llm import products
from pressloom.llm.products import Best, buckets, search

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, score string, length int, row int, v string"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, 2, "x", 3, 4, "y") for r in rows], SCHEMA).repartition(parts)


def usable(v):
    return v is not None and all(c is not None and np.isfinite(c) for c in v)


def whole(v, width):
    x = [floor(Fraction(float(np.float32(c))) * 256) for c in v]
    return [max(-2 ** 50, min(2 ** 50, c)) for c in x] + [0] * (width - len(v))


def brute(rows, top=5, every=50):
    """All products in whole numbers; an id once a query, with its best product."""
    rows = [(i, v) for i, v in rows if usable(v)]
    width = max((len(v) for _, v in rows), default=0)
    rows = [(i, tuple(whole(v, width))) for i, v in rows]
    out = []
    for i, q in {r for r in rows if r[0] is not None and r[0] % every == 0}:
        best = {}
        for j, x in rows:
            if j != i:
                score = sum(a * b for a, b in zip(q, x, strict=True))
                score = max(-products.LARGEST_PRODUCT, min(products.LARGEST_PRODUCT, score))
                best[j] = max(best.get(j, score), score)
        ranked = sorted((-s, j is None, j or 0) for j, s in best.items())[:top]
        out += [(i, n + 1, None if no_id else j, -s) for n, (s, no_id, j) in enumerate(ranked)]
    return sorted(out, key=repr)


def result(df, **options):
    return sorted((tuple(r) for r in products.top_products(df, **options).collect()), key=repr)


def vectors(n, width, spread=1.0, seed=4):
    rng = np.random.default_rng(seed)
    return [(i, (rng.normal(size=width) * np.exp(spread * rng.normal())).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize(("n", "width", "spread", "every"), [(400, 8, 1.0, 10), (300, 3, 0.0, 50)])
def test_matches_all_products(spark, n, width, spread, every):
    rows = vectors(n, width, spread)
    assert result(table(spark, rows), every=every) == brute(rows, every=every)


def test_rounds_and_shards(spark, monkeypatch):
    # Many rounds over shards of a few vectors.
    monkeypatch.setattr(products, "FIRST_ROWS", 16)
    monkeypatch.setattr(products, "GROWTH", 3)
    monkeypatch.setattr(products, "SHARD_CELLS", 60)
    rows = vectors(300, 6)
    assert result(table(spark, rows), every=20) == brute(rows, every=20)


def test_a_vector_that_is_a_third_of_all_rows(spark):
    rows = vectors(100, 4)
    rows += [(i, rows[7][1]) for i in range(100, 150)]
    assert result(table(spark, rows), every=10) == brute(rows, every=10)


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [float(i % 2), 1.0]) for i in range(60, 0, -1)] + [(0, [0.0, 1.0]), (-50, [1.0, 0.0])]
    assert result(table(spark, rows)) == brute(rows)


def test_odd_rows(spark):
    rows = vectors(120, 4) + [
        (200, None), (250, [1.0, None]), (300, [float("nan")]), (350, [float("-inf"), 1.0]), (None, [9.0, 9.0, 9.0, 9.0]),
        (None, [9.5, 9.0, 9.0, 9.0]), (400, []), (450, [2.0, -3.0]), (500, [0.0, 0.0, 0.0, 0.0]), (150, [1.0, 2.0, 3.0, 4.0]),
        (150, [1.0, 2.0, 3.0, 4.0]), (150, [4.0, 3.0, 2.0, 1.0]), (7, [5.0, 5.0, 5.0, 5.0]), (7, [6.0, 5.0, 5.0, 5.0]),
    ]
    assert result(table(spark, rows)) == brute(rows)
    out = products.top_products(table(spark, rows))
    assert out.columns == ["query_id", "rank", "vec_id", "score"]


def test_products_beyond_a_double(spark):
    rows = vectors(60, 3) + [(100, [3e38, -3e38, 1.0]), (101, [3e38, 3e38, 0.5]), (102, [2e10, 1.0, 0.0])]
    assert result(table(spark, rows)) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(0, [1.0])], [(1, [1.0]), (2, [2.0])], [(0, None), (1, [1.0])], [(0, [1.0]), (0, [2.0])]])
def test_nothing_to_find(spark, rows):
    out = products.top_products(table(spark, rows))
    assert out.count() == 0 and out.columns == ["query_id", "rank", "vec_id", "score"]
    assert result(table(spark, [(0, [1.0]), (3, [])])) == [(0, 1, 3, 0)]


def shard(n, width, near, seed=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, width))
    x = np.floor((centres[rng.integers(20, size=n)] + near * rng.normal(size=(n, width))) * 60 * rng.uniform(0.5, 2, size=(n, 1)))
    lengths = np.sqrt((x * x).sum(1))
    order = np.argsort(-lengths, kind="stable")
    return order.astype(np.int64), x[order].astype(np.int64), lengths[order]


@pytest.mark.parametrize("near", [0.02, 0.3])
def test_each_pruning_keeps_the_best(monkeypatch, near):
    ids, x, lengths = shard(1500, 12, near)
    monkeypatch.setattr(products, "BUCKET_ROWS", 200)
    some = np.arange(0, 1500, 30)
    truth = x[some] @ x.T
    truth[np.arange(len(some)), some] = products._NONE
    best = np.sort(truth, axis=1)[:, ::-1][:, :5]
    used = {}
    for cost in (0, 10 ** 9):
        monkeypatch.setattr(products, "LOOKUP_COST", cost)
        monkeypatch.setattr(products, "FETCH_COST", 0.1)
        parts = buckets(ids, x, lengths, 5)
        got = search(parts, ids[some], x[some], lengths[some], np.full(len(some), products._NONE), 5)
        np.testing.assert_array_equal(got.scores, best)
        used[cost] = {k: sum(b.counts[k] for b in parts) for k in parts[0].counts}
    # Short buckets are passed over; high cosine thresholds are met by coordinates where
    # a lookup is cheap, by lengths where it is dear.
    assert used[0]["pruned"] > 0 and used[10 ** 9]["coordinate"] == 0 and used[10 ** 9]["length"] > 0
    if near == 0.02:
        assert used[0]["coordinate"] > 0


def test_coordinates_keep_every_vector_above_the_cosine():
    ids, x, lengths = shard(800, 10, 0.1)
    bucket = products.Bucket(ids, x, lengths)
    bucket.index()
    unit = x / lengths[:, None]
    for i in range(0, 800, 80):
        for cosine in (0.3, 0.9, 0.999):
            rows = bucket.by_coordinates(unit[i], cosine)
            assert set(np.flatnonzero(unit @ unit[i] >= cosine)) <= set(rows)
            assert len(set(rows)) == len(rows)


def test_equal_vectors_are_compared_once_for_the_least_ids():
    ids = np.array([9, 8, 7, 7, 6, 5, 4, 3, 1, 2])
    x = np.array([[2, 2]] * 8 + [[1, 1]] * 2)
    parts = buckets(ids, x, np.sqrt((x * x).sum(1)), 3)
    assert sorted(parts[0].ids) == [3, 4, 5, 6] and sorted(i for b in parts[1:] for i in b.ids) == [1, 2]


def test_best_keeps_an_id_once():
    best = Best(2, 2)
    best.offer(np.array([0, 0, 1]), np.array([5, 7, 1]), np.array([3, 3, 4]))
    best.offer(np.array([0, 0]), np.array([7, 6]), np.array([2, 3]))
    assert best.scores[0].tolist() == [7, 7] and best.ids[0].tolist() == [2, 3]
    assert best.scores[1].tolist() == [1, products._NONE]
