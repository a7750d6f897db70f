import random
import re

from duologue.llm import url_rules

ALPHABET = "ab/.-x"


def as_regex(glob):
    out = ""
    i = 0
    while i < len(glob):
        if glob[i] == "*":
            run = len(glob[i:]) - len(glob[i:].lstrip("*"))
            out += "(?s:.*)" if run > 1 else "[^/]*"
            i += run
        else:
            out += "[^/]" if glob[i] == "?" else re.escape(glob[i])
            i += 1
    return re.compile(out)


def test_globs_against_regexes():
    rng = random.Random(3)
    globs = ["".join(rng.choice(ALPHABET + "*?**") for _ in range(rng.randint(0, 9))) for _ in range(90)]
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 70))) for _ in range(400)]
    hit = url_rules.GlobSet(globs).matches([t.encode() for t in texts])
    assert hit.shape[1] == 90 and url_rules.GlobSet(globs).words > 4
    for g, glob in enumerate(globs):
        want = [bool(as_regex(glob).fullmatch(t)) for t in texts]
        assert hit[:, g].tolist() == want, glob


def judged(spark, urls, **kw):
    rows = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, key string, host string")
    return {r.key: r for r in url_rules.judge_urls(rows, **kw).collect()}


def test_rules_hosts_and_paths(spark):
    urls = [
        "http://Sub.Example.COM/en/1?q#f",
        "https://www.example.com/en/",
        "https://x.www.example.com/en/x",
        "https://notexample.com/en/x",
        "http://a.net/es/x",
        "http://a.net",
        "http://net.org/x.com/en/",
        "mailto:x",
        None,
        "",
        "http://",
        "http://a.org/setup.exe",
        "://com/",
        "x://ÄB.com/é?",
        "http://com?/",
        "http://a.org/" + "b/" * 50_000,
    ]
    got = judged(spark, urls)
    assert [(got[i].host, got[i].rule, got[i].verdict) for i in range(len(urls))] == [
        ("sub.example.com", "example.com/en/", "block"),
        ("www.example.com", "www.example.com/en/", "allow"),
        ("x.www.example.com", "www.example.com/en/", "allow"),
        ("notexample.com", "com/", "allow"),
        ("a.net", "net/es/", "block"),
        ("a.net", None, "allow"),
        ("net.org", None, "allow"),
        ("", None, "block"),
        ("", None, "block"),
        ("", None, "block"),
        ("", None, "block"),
        ("a.org", None, "block"),
        ("com", "com/", "allow"),
        ("Äb.com", "com/", "allow"),
        ("com", None, "allow"),
        ("a.org", None, "allow"),
    ]
    assert got[0].path == "/en/1" and got[13].path == "/é" and got[14].path == ""


def test_ties_and_empty(spark):
    got = judged(spark, ["http://a.b/c/"] * 2, rules=[("block", "a.b/c"), ("allow", "a.b/c")], globs=[])
    assert [(r.rule, r.verdict) for r in got.values()] == [("a.b/c", "block")] * 2
    got = judged(spark, ["http://a.b/c/"], rules=[], globs=[])
    assert [(r.rule, r.verdict, r.glob) for r in got.values()] == [(None, "allow", None)]
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_rules.judge_urls(none).count() == 0
