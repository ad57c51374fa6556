import random

import numpy as np

from pressloom.llm import near


def brute_j_p(a, b):
    """Probability Jaccard by its definition, on dicts of weights."""
    return sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in set(a) | set(b)) for d in set(a) & set(b))


def weighted(pairs):
    keys = np.array(sorted(pairs), np.uint64)
    return keys, np.array([float(pairs[int(k)]) for k in keys])


def test_similarity_matches_the_definition():
    rng = random.Random(3)
    for _ in range(50):
        a = {k: rng.randint(1, 4) for k in rng.sample(range(30), 12)}
        b = {k: rng.randint(1, 4) for k in rng.sample(range(30), 15)}
        plain, probability = near.similarity(weighted(a), weighted(b))
        assert abs(plain - len(set(a) & set(b)) / len(set(a) | set(b))) < 1e-12
        assert abs(probability - brute_j_p(a, b)) < 1e-9


def test_sketch_estimates_probability_jaccard():
    rng = np.random.default_rng(4)
    errors = []
    for _ in range(40):
        keys = rng.integers(0, 2 ** 63, 60, dtype=np.uint64)
        a = {int(k): int(w) for k, w in zip(keys[:45], rng.integers(1, 5, 45))}
        b = {int(k): a.get(int(k), 2) for k in keys[10:]}
        one, two = (near.sketch(*map(np.array, weighted(x)), slots=192) for x in (a, b))
        errors.append((one == two).mean() - brute_j_p(a, b))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def classes(rows):
    """Connected components of all pairs at 0.8, by brute force."""
    known = [(i, near.shingles(t)) for i, t in rows if t and t.split()]
    label = {i: i for i, _ in rows}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for x, (i, a) in enumerate(known):
        for j, b in known[:x]:
            if max(near.similarity(a, b)) >= 0.8:
                p, q = find(i), find(j)
                label[max(p, q)] = min(p, q)
    return {i: find(i) for i, _ in rows}


def test_classes_match_all_pairs(spark, docs, folder):
    rng = random.Random(5)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
    first = [rng.choice(words) + str(rng.randint(0, 99)) for _ in range(120)]
    at = 100_000
    for _ in range(60):  # a chain of edits: neighbours are close, the ends are not
        first = list(first)
        first[rng.randrange(len(first))] = f"new{at}"
        rows.append((at, " ".join(first)))
        at += 1
    base = [f"t{i}" for i in range(40)]
    for i in range(80):  # a common passage that links nobody
        rows.append((at, " ".join(base + [f"own{i}_{k}" for k in range(40)])))
        at += 1
    got = {r.doc_id: r.class_id for r in near.near_duplicates(docs(rows)).collect()}
    assert got == classes(rows)


def test_members_that_fail_with_the_hub_still_meet(spark, monkeypatch):
    """The least of a bucket is like nobody; the others are like one another."""
    base = [f"w{i}" for i in range(60)]
    texts = {10: " ".join(f"x{i}" for i in range(60))}
    for n in range(11, 31):
        texts[n] = " ".join([*base, f"own{n}"])
    for n in range(31, 41):
        texts[n] = " ".join(f"far{n}_{i}" for i in range(50))
    won = {n: near.sketch(*near.shingles(t)) for n, t in texts.items()}
    buckets = {}
    for n, w in won.items():
        for band, key in enumerate(near.bands(w).tolist()):
            buckets.setdefault((key, band), []).append(n)
    rows = [(key, band, n, 10) for (key, band), own in buckets.items() if len(own) > 1 for n in [10, *own]]
    members = spark.createDataFrame(rows, "bucket long, band int, node long, hub long")
    labels = spark.createDataFrame([(12, 11), (11, 11)], "node long, comp long")
    nodes = spark.createDataFrame(
        [(n, bytearray((w & np.uint64(0xFFFF)).astype("<u2").tobytes()), texts[n]) for n, w in won.items()],
        "node long, marks binary, text string")
    for chunk, block in ((512, 1024), (4, 3)):
        monkeypatch.setattr(near, "PER_CHUNK", chunk)
        monkeypatch.setattr(near, "PER_BLOCK", block)
        links = near.remaining_links(members, labels, nodes)
        joined = near.components(links.unionByName(spark.createDataFrame([(11, 12)], "a long, b long")))
        assert {r.node: r.comp for r in joined.collect()} == {n: 11 for n in range(11, 31)}


def repeated(number, times):
    """Two texts of the same lines; the second says one of them many times."""
    body, line = [f"b{number}_{i}" for i in range(60)], [f"l{number}_{i}" for i in range(10)]
    return " ".join([*body, *line]), " ".join([*body, *line * times])


def test_texts_alike_as_sets_only_are_linked(spark, docs):
    """One line said 200 or 1000 times leaves the sets alike and the weighted sets not."""
    rows = []
    for n in range(20):
        once, many = repeated(n, 200 if n % 2 else 1000)
        rows += [(2 * n, once), (2 * n + 1, many)]
    plain, probability = near.similarity(near.shingles(rows[0][1]), near.shingles(rows[1][1]))
    assert plain > 0.8 > near.LEAST_ESTIMATE > probability
    got = {r.doc_id: r.class_id for r in near.near_duplicates(docs(rows)).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}


def test_texts_alike_as_sets_only_meet_without_the_hub(spark):
    """The bucket's least row is like nobody; the pair shares a bucket and must be linked."""
    once, many = repeated(0, 200)
    texts = {1: " ".join(f"x{i}" for i in range(60)), 2: once, 3: many}
    made = {r.doc_id: r for r in near.sketches(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    band = next(k for k, b in enumerate(made[2].bands) if b in made[3].bands)
    members = spark.createDataFrame([(7, band, n, 1) for n in texts], "bucket long, band int, node long, hub long")
    labels = spark.createDataFrame([], "node long, comp long")
    nodes = spark.createDataFrame([(n, made[n].marks, t) for n, t in texts.items()], "node long, marks binary, text string")
    assert [(r.a, r.b) for r in near.remaining_links(members, labels, nodes).collect()] == [(2, 3)]


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101)], "a long, b long")
    got = {r.node: r.comp for r in near.components(links).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 101: 100}


def test_odd_rows(odd, odd_rows, none):
    got = near.near_duplicates(odd).collect()
    assert len(got) == len(odd_rows)
    by = {r.doc_id: r.class_id for r in got}
    assert by == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 8, None: None}
    kept = near.first_of_class(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 3, 4, 5, 6, 7, 8]
    assert kept.filter("doc_id is null").count() == 2
    assert near.near_duplicates(none).count() == 0 and near.first_of_class(none).count() == 0
