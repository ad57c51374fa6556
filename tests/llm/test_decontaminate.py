import random

import numpy as np

from pressloom.llm import decontaminate as d


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


def test_common_subsequence_matches_dynamic_programming():
    rng = random.Random(1)
    for _ in range(200):
        a = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randint(1, 80))]
        b = [rng.choice([b"a", b"b", b"c", b"e"]) for _ in range(rng.randint(0, 60))]
        assert d.common_subsequence(a, b) == lcs(a, b)
        assert abs(d.common_share(a, b, np.ones(len(a))) - lcs(a, b) / len(a)) < 1e-9


def test_passages_cover_every_word():
    for n in (0, 1, 31, 32, 33, 48, 49, 500):
        starts = d.passages(n)
        words = {w for s in starts for w in range(s, min(n, s + d.PASSAGE))}
        assert words == set(range(n))


def test_space_spans_the_passages(spark):
    """With a rank above that of the matrix, cosines are those of the full space."""
    texts = [(i, " ".join(f"w{(i * 7 + k) % 41}" for k in range(20))) for i in range(12)]
    items = spark.createDataFrame(texts, "item_id long, text string")
    idf = np.ones(d.BUCKETS, np.float32)
    ids, vectors = d.latent_space(items.repartition(3), idf)
    assert np.allclose(vectors.T @ vectors, np.eye(vectors.shape[1]), atol=1e-4)
    for _, text in texts:
        row = np.zeros(len(ids))
        np.add.at(row, np.searchsorted(ids, d.buckets(d.terms(text))), 1)
        assert np.linalg.norm(row - vectors @ (vectors.T @ row)) < 1e-3 * np.linalg.norm(row)


def fixture(spark, folder):
    """Documents with items whole, shortened, reworded and in part."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    known = {(i, k) for i, t in docs for k, b in bench if b in t}
    rng = random.Random(2)
    at, planted, partial = 10_000, set(), set()
    for k, text in bench[:25]:
        words = text.split()
        reworded = [f"other{at}{j}" if rng.random() < 0.2 else w for j, w in enumerate(words)]
        for version, where in ((words, planted), (reworded, planted), (words[:len(words) // 5], partial)):
            fill = docs[rng.randrange(100)][1].split()[:200]
            cut = rng.randrange(len(fill) + 1)
            docs.append((at, " ".join(fill[:cut] + version + fill[cut:])))
            where.add((at, k))
            at += 1
    return docs, bench, known, planted, partial


def test_planted_items_are_found_and_nothing_else(spark, docs, folder):
    rows, bench, known, planted, partial = fixture(spark, folder)
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in d.contaminated(docs(rows), items).collect()}
    assert known <= got
    assert len(planted & got) >= 0.95 * len(planted)
    assert not got & partial
    hosts = {i for i, _ in known | planted}
    assert {i for i, _ in got if i < 10_000} <= hosts


def test_rare_words_around_or_inside_an_item_hide_nothing():
    """Words that no item has are the heaviest of a large corpus; every copy that the
    rule accepts must be found among them, verbatim ones without exception."""
    rng = random.Random(4)
    words = [[b"w%d" % rng.randrange(60) for _ in range(n)] for n in (10, 12, 16, 20, 40, 80)]
    idf = np.full(d.BUCKETS, 14, np.float32)
    ids = np.unique(np.concatenate([d.buckets(w) for w in words]))
    idf[ids] = np.random.default_rng(5).uniform(1, 5, len(ids))
    place = np.full(d.BUCKETS, -1, np.int32)
    place[ids] = np.arange(len(ids))
    answers = [w[-len(w) // 4:] for w in words]
    items = d.Items(list(range(len(words))), words, answers, idf, place, np.eye(len(ids), dtype=np.float32))
    verbatim = accepted = 0
    for unseen in (0, 0.2, 0.3, 0.4):
        for k, item in enumerate(words * 5):
            k %= len(words)
            copy = [b"new%d" % rng.randrange(10 ** 9) if rng.random() < unseen else w for w in item]
            worth = idf[d.buckets(item)]
            share = d.common_share(item, copy, worth)
            answer = d.common_share(answers[k], copy, worth[-len(answers[k]):])
            if share < d.VERBATIM and (share < d.PARAPHRASE or answer < d.ANSWER):
                continue
            around = [b"rare%d" % rng.randrange(10 ** 9) for _ in range(120)]
            at = rng.randrange(len(around))
            text = b" ".join(around[:at] + copy + around[at:]).decode()
            assert k in {found for found, *_ in d.findings(text, items)}, (unseen, len(item))
            accepted, verbatim = accepted + 1, verbatim + (unseen == 0)
    assert verbatim == 30 and accepted > 80


def test_every_region_is_judged():
    """A larger piece without the answer does not hide a smaller one that has it."""
    item = [b"w%d" % i for i in range(40)]
    ids = np.unique(d.buckets(item))
    place = np.full(d.BUCKETS, -1, np.int32)
    place[ids] = np.arange(len(ids))
    items = d.Items([5], [item], [item[-10:]], np.ones(d.BUCKETS, np.float32), place, np.eye(len(ids), dtype=np.float32))
    gap = [b"x%d" % i for i in range(400)]
    piece, reworded = item[:22], item[20:38]
    def found(words):
        return list(d.findings(b" ".join(words).decode(), items))
    assert not found(gap + piece + gap) and found(gap + reworded + gap)
    assert found(gap + piece + gap + reworded + gap) == found(gap + reworded + gap)


def test_blocks_of_items_find_the_same(spark, docs, folder, monkeypatch):
    rows, bench, *_ = fixture(spark, folder)
    items = spark.createDataFrame(bench[:10], "item_id long, text string")
    whole = {(r.doc_id, r.item_id) for r in d.contaminated(docs(rows), items).collect()}
    monkeypatch.setattr(d, "BLOCK_WORDS", 200)
    assert {(r.doc_id, r.item_id) for r in d.contaminated(docs(rows), items).collect()} == whole


def test_odd_rows(spark, odd, none):
    same = "one two three four five six seven eight nine ten eleven twelve"
    items = spark.createDataFrame([(1, same), (1, same), (2, None), (3, ""), (None, same)], "item_id long, text string")
    got = d.contaminated(odd, items).collect()
    assert sorted((r.doc_id, r.item_id) for r in got if r.doc_id is not None) == [(1, 1), (2, 1)]
    kept = d.clean(odd, items)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [3, 4, 5, 6, 7, 8]
    assert d.contaminated(odd, items.limit(0)).count() == 0 and d.contaminated(none, items).count() == 0


def test_bounds_never_rule_out_what_the_rule_accepts():
    rng = random.Random(6)
    ruled_out = 0
    for _ in range(300):
        item = [b"%d" % rng.randrange(30) for _ in range(rng.randint(1, 30))]
        region = [b"%d" % rng.randrange(60) for _ in range(rng.randint(0, 60))]
        worth = np.array([rng.random() ** 4 + 0.01 for _ in item])
        may = d.may_reach(item, region, worth, d.PARAPHRASE)
        ruled_out += not may
        assert may or d.common_share(item, region, worth) < d.PARAPHRASE
    assert ruled_out > 50


def item_block(words, idf):
    ids = np.unique(np.concatenate([d.buckets(w) for w in words]))
    place = np.full(d.BUCKETS, -1, np.int32)
    place[ids] = np.arange(len(ids))
    answers = [d.answer_of(b" ".join(w).decode()) for w in words]
    return d.Items(list(range(len(words))), words, answers, idf, place, np.eye(len(ids), dtype=np.float32))


def test_few_heavy_words_in_order_are_found():
    """Seven of twenty words that hold most of the weight."""
    words = [b"w%d" % i for i in range(20)]
    idf = np.full(d.BUCKETS, 1.0, np.float32)
    idf[d.buckets(words[:7])] = 10
    text = " ".join(f"x{i}" for i in range(30)) + " " + b" ".join(words[:7]).decode() + " y" * 30
    (found,) = d.findings(text, item_block([words], idf))
    assert found[0] == 0 and found[1] > 0.8


def test_products_of_passages_match_plain_sums():
    rng = random.Random(9)
    words = [[b"w%d" % rng.randrange(40) for _ in range(n)] for n in (10, 33, 70)]
    idf = np.random.default_rng(3).uniform(1, 5, d.BUCKETS).astype(np.float32)
    items = item_block(words, idf)
    for n in (1, 15, 16, 31, 32, 33, 48, 50, 333):
        own = d.buckets([b"w%d" % rng.randrange(60) for _ in range(n)])
        starts = d.passages(n)
        place = np.append(items.place[own], np.full(d.PASSAGE, -1, np.int32))
        weight = np.append(idf[own], np.zeros(d.PASSAGE, np.float32))
        want = np.zeros((len(starts), len(items.points)))
        for i, s in enumerate(starts):
            for at in range(s, min(n, s + d.PASSAGE)):
                if place[at] >= 0:
                    want[i] += weight[at] * (items.vectors[place[at]] @ items.points.T)
        for table in (None, items.vectors @ items.points.T):
            items.table = table
            np.testing.assert_allclose(items._products(starts, place, weight), want, rtol=1e-4, atol=1e-4)


def test_matches_comparing_every_passage_with_every_item(spark, docs, folder):
    """The whole query against the rule alone, over every region of every text."""
    rows, bench, *_ = fixture(spark, folder)
    rows = rows[-75:] + rows[:40]
    items = spark.createDataFrame(bench, "item_id long, text string")
    table = docs(rows)
    got = {(r.doc_id, r.item_id) for r in d.contaminated(table, items).collect()}
    idf = d.inverse_frequency(table)
    want = set()
    for i, text in rows:
        words = d.terms(text)
        for k, item in bench:
            whole = d.terms(item)
            answer, worth = d.answer_of(item), idf[d.buckets(whole)]
            reach = len(whole)
            for at in d.passages(len(words)):
                region = words[max(0, at - reach):at + d.PASSAGE + reach]
                if not d.may_reach(whole, region, worth, d.PARAPHRASE):
                    continue
                share = d.common_share(whole, region, worth)
                part = d.common_share(answer, region, worth[-len(answer):])
                if share >= d.VERBATIM or (share >= d.PARAPHRASE and part >= d.ANSWER):
                    want.add((i, k))
                    break
    assert len(got & want) >= 0.97 * len(want) and len(got - want) <= 0.03 * len(got)
