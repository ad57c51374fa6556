import numpy as np
import pytest

from pressloom.llm import decontaminate as D

WORDS = [f"w{i}" for i in range(300)]


@pytest.fixture(scope="module")
def items():
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(WORDS, n)) + "." for n in (5, 20, 33, 48, 90, 150)]
    idf = np.ones(D.BUCKETS, np.float32)
    ids = np.unique(np.concatenate([D.buckets(D.terms(t)) for t in texts]))
    place = np.full(D.BUCKETS, -1, np.int32)
    place[ids] = np.arange(len(ids))
    return D.Items(list(range(6)), [D.terms(t) for t in texts], [D.answer_of(t) for t in texts], idf, place,
                   np.eye(len(ids), dtype=np.float32)), texts


def dense(own, items):
    """Every passage against every item passage, one by one."""
    for at in D.passages(len(own)):
        part = own[at:at + D.PASSAGE]
        row = np.zeros(items.vectors.shape[0])
        np.add.at(row, items.place[part][items.place[part] >= 0], 1.0)
        length = np.sqrt((items.idf[part] ** 2).sum())
        for k, point, norm in zip(items.owner.tolist(), items.points, items.norms):
            product = float(row @ point)
            if product >= max(min(D.LEAST_COSINE * length, D.LEAST_PART * norm), 1e-6):
                yield int(at), k, min(1.0, product / length)


@pytest.mark.parametrize("n", [1, 15, 32, 33, 64, 100, 700])
def test_near_is_every_passage_that_reaches_its_bound(items, n):
    items, texts = items
    rng = np.random.default_rng(n)
    foreign = [f"x{i}" for i in range(2000)]
    words = list(rng.choice(WORDS + foreign, n))
    words[n // 3:n // 3 + 40] = texts[3].split()[:max(0, min(40, n - n // 3))]
    own = D.buckets(D.terms(" ".join(words)))
    got, want = sorted(items.near(own)), sorted(dense(own, items))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want], atol=1e-4)


def test_near_skips_passages_apart_from_each_other(items):
    """Passages with and without words of the items in turn: strides that do not lie side by side."""
    items, texts = items
    words = [w for k in range(6) for w in [*texts[5].split()[:60], *[f"y{k}{i}" for i in range(150)]]]
    own = D.buckets(D.terms(" ".join(words)))
    got, want = sorted(items.near(own)), sorted(dense(own, items))
    assert [g[:2] for g in got] == [w[:2] for w in want] and len({g[0] for g in got}) > 6
