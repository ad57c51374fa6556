import itertools
import re

import numpy as np

from pressloom.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    again = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = text.split("\n")
    dup = sum(1 for i, line in enumerate(lines) if line.strip(" \t\n\v\f\r") and line in lines[:i])
    failed = len(words) < 10 or 100 * len(again) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again), failed


def test_base_counts_match_brute_force(spark, folder, docs):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect() if len(r.text or "") < 3000]
    rows += [(-1, "a b c d e\na b c d e\n\n  \n\x1d x y z # <p>"), (-2, "x " * 40), (-3, None), (-4, "")]
    chain = quality.Chain(np.ones(len(quality.FEATURES)), np.zeros((2, 2)))
    got = {r.doc_id: r.verdict for r in quality.judged(docs(rows), chain).collect()}
    for i, text in rows:
        v = got[i]
        assert (v.n_words, v.word_chars, v.n_symbols, v.n_dup_lines, v.n_repeat_words, v.base_failed) == brute(text), i
        assert not (v.kept and v.base_failed)


def test_viterbi_finds_the_best_labelling():
    rng = np.random.default_rng(1)
    for _ in range(30):
        x = rng.normal(size=(6, len(quality.FEATURES)))
        chain = quality.Chain(rng.normal(size=x.shape[1]), rng.normal(size=(2, 2)))

        def score(states):
            own = sum(x[t] @ chain.weights for t, s in enumerate(states) if s)
            return own + sum(chain.moves[a, b] for a, b in zip(states, states[1:]))

        best = max(itertools.product((0, 1), repeat=6), key=score)
        assert tuple(chain.label(x).astype(int)) == best


def test_fit_separates_labelled_lines():
    rng = np.random.default_rng(2)
    xs = [rng.normal(size=(8, len(quality.FEATURES))) for _ in range(60)]
    ys = [x[:, 2] > 0 for x in xs]
    chain = quality.fit_chain(xs, ys)
    right = np.mean([np.mean(chain.label(x) == y) for x, y in zip(xs, ys)])
    assert right > 0.95


def test_labelled_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    # Fitted to one half of the labels, judged on the other.
    chain = quality.train(docs, labels.filter("doc_id % 2 = 0"))
    rows = quality.judged(docs, chain).join(labels.filter("doc_id % 2 = 1"), "doc_id").select("quality", "verdict.kept", "verdict.base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.1


def test_odd_rows(spark, odd, odd_rows, none):
    no_labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    chain = quality.train(odd, no_labels)
    rows = quality.judged(odd, chain, "told").collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        if not (r.text or "").strip():
            assert r.told.n_words == 0 and r.told.base_failed and not r.told.kept
    assert [r.told.kept for r in rows if r.doc_id in (1, 2)] == [True] * 3
    assert quality.judged(none, quality.train(none, no_labels), "told").count() == 0
