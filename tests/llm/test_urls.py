"""Verdicts against a plain reading of the rules."""

import random

import pytest

from orderloom.llm import urls

RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com", "block"), ("B.example.org", "block"), ("org/es", "block")]


def plain(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = rest[: min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))]
        path = rest[len(host) :]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = (0, None, default)
    for rule, verdict in rules:
        rule_host, slash, rule_path = rule.partition("/")
        rule_host = rule_host.lower()
        fits = host == rule_host or host.endswith("." + rule_host)
        if fits and path.startswith(slash + rule_path):
            best = max(best, (len(rule), rule, verdict), key=lambda b: b[0])
    return host, path, best[1], best[2]


def test_random_urls(spark):
    rng = random.Random(4)
    hosts = ["example.org", "a.example.org", "b.EXAMPLE.org", "xexample.org", "org", "com", "x.com", "É.com", "", "example.org:80", "a..com", ".", "u@x.org"]
    paths = ["", "/", "/es/", "/es", "/en/12", "/en/", "/fr/x", "/es/é?q=/fr/", "?a", "#b", "/a\nb", "/es/#?x"]
    made = [f"{rng.choice(['http', 'HTTPS', ''])}://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(300)]
    made += [None, "", "no scheme/es/", "://", "a://b://c/d", "http:/x", made[0], made[0]]
    df = spark.createDataFrame(list(enumerate(made)), "page_id long, url string").repartition(4)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(df, RULES).collect()}
    assert got == {k: plain(u, RULES) for k, u in enumerate(made)}


def test_edges(spark):
    rows = [(1, "http://x.org/a", "h"), (1, "http://x.org/a", "h"), (None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    out = urls.judge_urls(df, RULES, default="block")
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    assert sorted(map(str, ((r.page_id, r.host, r.verdict) for r in out.collect()))) == [
        "(1, 'x.org', 'allow')", "(1, 'x.org', 'allow')", "(None, '', 'block')",
    ]
    assert urls.judge_urls(df.limit(0), RULES).count() == 0
    assert {r.verdict for r in urls.judge_urls(df, []).collect()} == {"allow"}
    assert {r.verdict for r in urls.judge_urls(df, [("org/", "allow"), ("org/", "block")]).where("page_id = 1").collect()} == {"block"}
    with pytest.raises(ValueError, match="no host"):
        urls.judge_urls(df, [("/x", "block")])


def test_long_hosts_and_paths(spark):
    rows = [(1, "http://" + "a." * 5000 + "org/" + "x" * 20000)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    assert urls.judge_urls(df, RULES).first().rule == "org/"
