import random

from versus.llm import urlfilter
from versus.llm.urlfilter import RULES, Trie, judge


def plain(rules, host, path, default="allow"):
    """Every rule tried."""
    fit = [(0 if h == "" else h.count(".") + 1, len(p), h + p, v) for v, h, p in rules
           if (h == "" or host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[2:] if fit else (None, default)


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host, rest = "".join(c.lower() if c < "\x80" else c for c in rest[:end]), rest[end:]
    return host, rest[:min([i for i in map(rest.find, "?#") if i >= 0], default=len(rest))]


URLS = [None, "", "no scheme", "http://", "http://A.ORG", "http://a.org/", "http://org/x", "http://notorg/x", "http://example.org/es", "http://Example.org/es/",
        "http://x.example.org/en/14?q=/es/", "http://badexample.org/en/1", "http://a.com/de/x", "http://a.com/DE/", "http://a.com/fr/", "http://a.com/fr#/de/",
        "http://a.net/", "x://y://z.org/", "http://a.org:80/", "http://.org/", "http://a..org/", "http://a.org./", "http://a.org?u=/de/", "http://\u212a.org/\n/es/",
        "a\nb://q.com/de/", "http://example.org/en/1", "http://example.org/en/", "http://b.com/" + "long/" * 50_000]


def test_urls_of_every_kind(spark):
    rows = [(i if i % 7 else None, u, "kept out") for i, u in enumerate(URLS * 2)]
    got = judge(spark.createDataFrame(rows, "page_id long, url string, verdict string"), RULES)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    want = sorted((repr(i), *split(u), *map(str, plain(RULES, *split(u)))) for i, u, _ in rows)
    assert sorted((repr(r.page_id), r.host, r.path, str(r.rule), r.verdict) for r in got.collect()) == want


def random_case(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "ab", "c", ""])
    host = lambda: ".".join(word() for _ in range(rng.randint(1, 3)))
    path = lambda: "".join("/" + word() for _ in range(rng.randint(0, 3)))
    rules = [(rng.choice(["allow", "block"]), host().strip("."), path()) for _ in range(rng.randint(0, 30))]
    rules = [r for r in rules if ".." not in r[1]]
    return rules, [(host(), path()) for _ in range(60)]


def test_trie_equals_every_rule_tried():
    for seed in range(200):
        rules, urls = random_case(seed)
        trie = Trie(rules)
        for host, path in urls:
            assert (trie.match(host, path) or (None, "allow")) == plain(rules, host, path), (seed, host, path)


def test_large_rule_tables_are_joined(spark):
    for seed in (3, 4, 5):
        rules, urls = random_case(seed)
        df = spark.createDataFrame([(i, f"http://{h}{p}") for i, (h, p) in enumerate(urls * 3)], "page_id long, url string")
        table = spark.createDataFrame(rules, "verdict string, host string, path string")
        want = sorted((i, *map(str, plain(rules, h, p, "block"))) for i, (h, p) in enumerate(urls * 3))
        for limit in (0, 1000):
            got = judge(df, table, default="block", trie_rules=limit)
            assert sorted((r.page_id, str(r.rule), r.verdict) for r in got.collect()) == want
        assert "ArrowEvalPython" not in judge(df, table, trie_rules=0)._jdf.queryExecution().toString()


def test_no_rules_and_no_rows(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert judge(empty, RULES).collect() == []
    one = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert [tuple(r) for r in judge(one, []).collect()] == [(1, "a.org", "/", None, "allow")]
    assert urlfilter.judge(one, spark.createDataFrame([], "verdict string, host string, path string"), trie_rules=-1, default="block").first().verdict == "block"


def test_a_wrong_rule_is_refused(spark):
    import pytest
    one = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    for rules in ([("deny", "a", "/")], [("allow", "a", "x")]):
        with pytest.raises(ValueError):
            judge(one, rules)
        with pytest.raises(ValueError):
            judge(one, spark.createDataFrame(rules, "verdict string, host string, path string"))
