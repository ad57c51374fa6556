import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from pressloom.llm import substring
from pressloom.llm.words import window_hashes


def brute(rows):
    size = substring.WINDOW
    first = {}
    cut = [(i, (t or "").encode().split()) for i, t in rows]
    for i, words in cut:
        if i is not None:
            for k in range(len(words) - size + 1):
                w = tuple(words[k:k + size])
                first[w] = min(first.get(w, i), i)
    out = {}
    for i, words in cut:
        gone = set()
        for k in range(len(words) - size + 1):
            if i is not None and first[tuple(words[k:k + size])] < i:
                gone.update(range(k, k + size))
        kept = [w for k, w in enumerate(words) if k not in gone]
        out.setdefault(i, []).append((len(words), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def result(df):
    out = {}
    for r in substring.without_repeats(df).collect():
        out.setdefault(r.doc_id, []).append((r.n_words, r.n_removed, r.kept_sha256))
    return out


def test_matches_brute_force(spark, docs, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rng = random.Random(1)
    passage = [f"p{i}" for i in range(140)]
    for k in range(40):
        own = [f"o{k}_{i}" for i in range(rng.randint(0, 60))]
        part = passage[rng.randint(0, 60):rng.randint(80, 140)]
        rows.append((5000 + k, " \t".join(own + part + own[::-1])))
    rows += [(6000, "same " * 300), (6001, "same " * 120), (6002, "same " * 49)]
    assert result(docs(rows)) == brute(rows)


def test_sketch_counts_too_much_and_never_too_little(docs):
    rows = [(i, " ".join(f"w{(i // 2) * 1000 + k}" for k in range(80))) for i in range(40)]
    bits = substring.repeated_cells(docs(rows).repartition(4), 1 << 16)
    own = docs(rows).withColumn("version", F.lit(1))
    found = substring.suspected(own, bits).select("doc_id", "start").collect()
    assert {(r.doc_id, r.start) for r in found} == {(i, k) for i in range(40) for k in range(31)}


def test_window_hashes_tell_windows_apart():
    words = np.random.default_rng(2).integers(0, 4, 400).astype(np.uint64) * np.uint64(7919)
    for size in (1, 2, 5, 25, 50):
        hashes = window_hashes(words, size)
        same = {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}
        assert len(hashes) == 400 - size + 1 and len(set(hashes.tolist())) == len(same)


def test_odd_rows(odd, odd_rows, none):
    got = result(odd)
    assert sum(map(len, got.values())) == len(odd_rows)
    want = brute([r[:2] for r in odd_rows])
    assert {i: sorted(rows) for i, rows in got.items()} == {i: sorted(rows) for i, rows in want.items()}
    assert substring.without_repeats(none).count() == 0
