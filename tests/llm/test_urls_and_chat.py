import hashlib

from pyspark.sql import functions as F

from pressloom.llm import chat, urlrules


def rule_of(url, rules):
    if not url or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] + [len(path)])]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


def test_rules_match_brute_force(spark):
    rules = urlrules.QUERY_RULES + [
        ("b.example.org", "/", "block"), ("example.org", "/", "block"), ("b.example.org", "/en/", "allow"),
        ("b.example.org", "/en/12", "block"), ("net", "/a", "block"), ("net", "/a/b/c", "allow"), ("net", "/a/b", "block"),
    ]
    urls = [None, "", "no host", "x://", "http://ORG", "http://org/", "http://org?x", "http://É.ORG/A#b", "a://b://org/", "http://..org/x"]
    for host in ("example.org", "b.example.org", "c.b.example.org", "xexample.org", "com", "a.com", "q.net", "net", "torg", "a.b.c.d.e.f.org"):
        for path in ("", "/", "/es/", "/es", "/en/1", "/en/12/3", "/en/", "/fr/1?x#y", "/de/", "/a", "/a/b", "/a/b/c/d", "/é"):
            urls.append(f"https://{host}{path}")
    pages = spark.createDataFrame([(i, u, "v") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    table = spark.createDataFrame(rules, urlrules.RULES_DDL)
    for parts in (1, 7):
        out = urlrules.judged(pages.repartition(parts), table)
        assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
        for r in out.collect():
            assert (r.host, r.path, r.rule, r.verdict) == rule_of(r.url, rules), r.url


def test_rules_and_pages_may_be_missing(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x"), (1, "http://a.org/x"), (None, None)], "page_id long, url string")
    none = spark.createDataFrame([], urlrules.RULES_DDL)
    odd = spark.createDataFrame([(None, "/", "block"), ("org", None, "block"), ("org", "/", "block"), ("org", "/", "allow")], urlrules.RULES_DDL)
    assert sorted((r.host, r.verdict) for r in urlrules.judged(pages, none).collect()) == [("", "allow"), ("a.org", "allow"), ("a.org", "allow")]
    assert sorted((r.host, r.rule, r.verdict) for r in urlrules.judged(pages, odd).collect() if r.host) == [("a.org", "org/", "allow")] * 2
    assert urlrules.judged(pages.limit(0), odd).count() == 0


def test_escapes_round_trip(values):
    texts = ["", "\\", "\\\\", "\\l", "<", "\\<", "<turn user>\n</turn>\n", "\\\\l<>g\\g", chat.PROBE, "é<\U0001F600>"]
    both = values([(t,) for t in texts], "t string", chat.unescaped(chat.escaped(F.col("t"))))
    assert both == texts
    assert not any("<" in t or ">" in t for t in values([(t,) for t in texts], "t string", chat.escaped(F.col("t"))))


def test_paths_of_trees_match_a_walk(spark):
    rows, parents = [], {}
    for n in range(1, 400):
        parent = None if n in (1, 200) else max(1, n - 1 - (n * n) % 7) if n < 200 else max(200, n - 1 - n % 3)
        parents[n] = parent
        rows.append((5, n, parent, float((n * 31) % 17)))
    rows += [(6, 1, None, None), (7, 1, 2, 1.0), (7, 2, 1, 1.0), (8, 1, 99, 2.0)] + [(9, n, n - 1 or None, 1.0) for n in range(1, 71)]
    got = chat.paths(spark.createDataFrame(rows, "tree long, node long, parent long, score double"), best=3).collect()
    score = {n: s for t, n, _, s in rows if t == 5}

    def walk(n):
        return walk(parents[n]) + [n] if parents[n] else [n]

    leaves = [n for n in parents if n not in parents.values()]
    ranked = sorted(leaves, key=lambda n: (-sum(score[k] for k in walk(n)) / len(walk(n)), n))[:3]
    for rank, leaf in enumerate(ranked, 1):
        path = sorted((r.depth, r.node) for r in got if r.tree == 5 and r["rank"] == rank)
        assert [n for _, n in path] == walk(leaf)
    assert {r.node for r in got if r.tree == 6} == {1} and not [r for r in got if r.tree == 7]
    assert {r.node for r in got if r.tree == 8} == {1}
    assert sorted(r.node for r in got if r.tree == 9) == list(range(1, 71))


def test_formatted_conversations_read_back(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a</turn>\n"), (2, 0, None, None), (2, 1, "assistant", None),
            (3, 5, "assistant", "x"), (3, 5, "assistant", "x"), (4, 0, "a>b\n", "\\"), (None, 0, "user", "lost")]
    talk = chat.with_probe(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    out = {r.conv_id: r for r in chat.digests(talk).collect()}
    assert set(out) == {1, 2, 3, 4, -7}
    for i, r in out.items():
        turns = sorted((t, role or "", text or "") for c, t, role, text in [*rows, (-7, 0, "user", chat.PROBE), (-7, 1, "assistant", chat.PROBE)] if c == i)
        loss = "".join(t for _, role, t in turns if role == "assistant")
        assert r.n_turns == len(turns) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(empty).count() == 0
    plan = chat.digests(talk)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
