import numpy as np
import pytest

from pressloom.llm import whiten
from pressloom.llm.whiten import Spectrum, rank_one, secular_roots

SCHEMA = "vec_id long, embedding array<float>, label int, n int, x string, component int"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], SCHEMA).repartition(parts)


def integers(rows):
    return np.floor(64 * np.array([np.array(v, np.float32) for _, v in rows], float)) + 1_000_000


def compare(out, rows):
    x = integers(rows)
    n, mean = len(x), x.mean(0)
    cov = (x - mean).T @ (x - mean) / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = min(32, int((values > values[0] * 1e-11).sum()))
    got = {(r.vec_id, r.component): r for r in out}
    assert len(got) == len(out) == n * kept
    white = np.array([[got[i, j + 1].whitened for j in range(kept)] for i, _ in rows])
    sums = x.sum(0).astype(int).tolist()
    for (i, _), row in zip(rows, x.astype(int).tolist(), strict=True):
        assert got[i, 1].deviation == sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True))
    plain = (x - mean) @ vectors[:, :kept] / np.sqrt(values[:kept])
    signs = np.sign((plain * white).sum(0))
    np.testing.assert_allclose(white * signs, plain, atol=1e-6)
    for j in range(kept):
        assert got[rows[0][0], j + 1].explained == pytest.approx(values[j] / values.sum(), rel=1e-9)
    assert {r.n for r in out} == {n} and max(r.identity_error for r in out) < 1e-6


def vectors(n, width, seed=3):
    rng = np.random.default_rng(seed)
    return [(i, (rng.normal(size=width) * np.geomspace(9, 0.5, width)).tolist()) for i in range(n)]


@pytest.mark.parametrize(("n", "width", "parts"), [(300, 40, 11), (60, 5, 2), (20, 33, 4)])
def test_whitened_matches_a_plain_decomposition(spark, n, width, parts):
    rows = vectors(n, width)
    compare(whiten.whitened(table(spark, rows, parts)).collect(), rows)


def test_given_table(spark, folder):
    df = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    compare(whiten.whitened(df).collect(), rows)


def test_a_vector_that_is_a_third_of_all_rows(spark):
    rows = vectors(120, 6)
    rows += [(i, rows[0][1]) for i in range(120, 180)]
    compare(whiten.whitened(table(spark, rows)).collect(), rows)


def test_odd_rows(spark):
    rows = vectors(12, 4)
    odd = [(90, None), (91, [1.0, None, 2.0, 3.0]), (92, [float("nan"), 1.0, 2.0, 3.0]), (93, [float("inf"), 0.0, 0.0, 0.0])]
    compare(whiten.whitened(table(spark, rows + odd)).collect(), rows)
    # Short and empty vectors have zeros; rows without an id or repeated count as they are.
    short = [*rows, (50, [1.5, 2.0]), (51, [])]
    padded = [*rows, (50, [1.5, 2.0, 0.0, 0.0]), (51, [0.0] * 4)]
    compare(whiten.whitened(table(spark, short)).collect(), padded)
    twice = whiten.whitened(table(spark, [*rows, rows[0], (None, rows[1][1])])).collect()
    assert len(twice) == 14 * 4 and {r.n for r in twice} == {14}
    assert sum(r.vec_id == rows[0][0] for r in twice) == 8 and sum(r.vec_id is None for r in twice) == 4
    # A very large entry is held within bounds, and its deviation is no long.
    far = whiten.whitened(table(spark, [*rows, (60, [3e38, 0.0, 0.0, 0.0])])).collect()
    assert {r.deviation for r in far if r.vec_id == 60} == {None}


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, []), (2, [])], [(1, None)]])
def test_nothing_varies(spark, rows):
    out = whiten.whitened(table(spark, rows))
    assert out.count() == 0 and out.columns == [f.split()[0] for f in whiten.RESULT.split(", ")]


def test_spectra_add_up():
    rng = np.random.default_rng(5)
    for width, n in ((1, 6), (7, 3), (24, 200)):
        x = np.floor(rng.normal(size=(n, width)) * 40) * np.geomspace(1, 1e-3, width)
        x[1] = x[0]
        one, two = Spectrum.empty(width), Spectrum.empty(width)
        for row in x[: n // 2]:
            one.add(row)
        two.add(x[n // 2], 3)
        for row in x[n // 2 + 1:]:
            two.add(row)
        one.merge(two)
        whole = np.concatenate([x, x[n // 2][None], x[n // 2][None]])
        cov = (whole - whole.mean(0)).T @ (whole - whole.mean(0))
        np.testing.assert_allclose(one.vectors @ np.diag(one.values) @ one.vectors.T, cov, atol=1e-11 * np.trace(cov))
        np.testing.assert_allclose(one.vectors.T @ one.vectors, np.eye(width), atol=1e-12)


def test_secular_roots_interlace_and_solve():
    rng = np.random.default_rng(6)
    for _ in range(50):
        poles = np.sort(rng.choice([rng.random(12), rng.random(12) * 1e-9, np.arange(12.0)], 1)[0])
        weights = 10.0 ** rng.uniform(-12, 3, 12)
        roots, away = secular_roots(poles, weights)
        assert (roots[:-1] <= poles[1:]).all() and (roots >= poles).all()
        size = np.abs(weights / away).sum(1)
        assert (np.abs(1 + (weights / away).sum(1)) <= 1e-10 * (1 + size)).all()


def test_components_that_an_update_does_not_touch_stay():
    values, basis = np.array([1.0, 2.0, 2.0, 5.0]), np.eye(4)
    new, turned = rank_one(values, basis, np.array([0, 0, 0, 3.0]), 2.0)
    np.testing.assert_allclose(new, [1, 2, 2, 23])
    np.testing.assert_allclose(np.abs(turned), np.eye(4), atol=1e-15)
