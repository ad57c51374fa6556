import random

from pyspark.sql import functions as F

from pressloom.llm import toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_automaton_matches_edit_distance():
    rng = random.Random(1)
    terms = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(3, 11))) for _ in range(25)} | {"idiot", "disgusting"})
    lexicon = toxicity.Lexicon(terms)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 12))) for _ in range(1500)]
    words += ["id1ot", "idiots", "diot", "disgustng", "disgvstinq", "disgust", "", "ïdiot"]
    for word in words:
        fits = [(distance(word, t), t) for t in terms if distance(word, t) <= toxicity.allowed(t)]
        want = (min(fits)[1], min(fits)[0]) if fits else None
        assert lexicon.match(word) == want, word


def test_automaton_forgets_and_stays_right(monkeypatch):
    monkeypatch.setattr(toxicity.Lexicon, "KEPT", 5)
    lexicon = toxicity.Lexicon(["idiot", "worthless"])
    for k in range(50):
        assert lexicon.match(f"w{k}orthless"[:10]) in (None, ("worthless", 1), ("worthless", 2))
        assert lexicon.match("idoit"[:4] + "t") in (None, ("idiot", 1))
        assert lexicon.match("idiot") == ("idiot", 0)


def test_quotation_is_told_from_abuse():
    lexicon = toxicity.Lexicon(["idiot"])
    told = [q for _, _, q in toxicity.hits(toxicity.tokens('he said that idiot is rude'), lexicon)]
    marks = [q for _, _, q in toxicity.hits(toxicity.tokens('the word "idiot" is rude'), lexicon)]
    abuse = [q for _, _, q in toxicity.hits(toxicity.tokens("you are an idiot, go away"), lexicon)]
    assert told == [True] and marks == [True] and abuse == [False]


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    told = toxicity.scored(docs, labels).join(labels, "doc_id").filter("held_out").select("toxic", "predicted", "score").collect()
    toxic = [r.predicted for r in told if r.toxic == 1]
    clean = [r.predicted for r in told if r.toxic == 0]
    assert sum(toxic) / len(toxic) > 0.9 and sum(clean) / len(clean) < 0.01
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in told)


def test_odd_rows(spark, odd, odd_rows, none):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (7, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    for docs, n in ((odd, len(odd_rows)), (none, 0)):
        for known in (labels, labels.limit(0)):
            out = toxicity.scored(docs, known).collect()
            assert len(out) == n and all(0 <= r.score <= 1 for r in out)
