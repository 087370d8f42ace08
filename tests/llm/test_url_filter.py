"""The automaton against regular expressions, the rules against a plain search."""

import random
import re

import numpy as np
from matchmill.llm import url_filter
from matchmill.llm.queries import URL_GLOBS, URL_RULES


def as_regex(glob: str) -> re.Pattern:
    parts = re.split(r"(\*\*|\*|\?)", glob)
    known = {"**": ".*", "*": "[^/]*", "?": "[^/]"}
    return re.compile("".join(known.get(p, re.escape(p)) for p in parts).encode(), re.DOTALL)


def test_automaton_equals_regular_expressions():
    draw = random.Random(1)
    globs = ["".join(draw.choice(["a", "b", "/", "*", "**", "?", ".", "ab"]) for _ in range(draw.randrange(9))) for _ in range(60)]
    texts = ["".join(draw.choice("ab/.") for _ in range(draw.randrange(14))).encode() for _ in range(400)] + [b"a" * 500]
    offsets = np.cumsum([0, *map(len, texts)])
    found = url_filter.Automaton(globs).matches(b"".join(texts), offsets)
    for j, glob in enumerate(globs):
        pattern = as_regex(glob)
        assert found[:, j].tolist() == [pattern.fullmatch(t) is not None for t in texts], glob


def plain(host: str, path: str):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name)).name if fits else None


def test_rules(spark):
    urls = [
        None,
        "",
        "no scheme",
        "http://",
        "https://A.Example.ORG/es/x?y#z",
        "https://example.org/en/1",
        "https://example.org/en/2",
        "https://badexample.org/es/",
        "https://org/",
        "https://x.org",
        "https://x.com/fr/",
        "https://x.com/de/a",
        "ftp://x.com/DE/",
        "https://x.com:80/de/",
        "https://x.com/a/http://y.org/",
        "https://x.net/de/?q=.org/",
        "http://casino-x.net/a",
        "http://x.net/a/b.exe",
        "http://ü.org/" + "long" * 20_000,
    ]
    rows = [(i, u) for i, u in enumerate(urls)] + [(0, None)]
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 AS host", "2 AS winner")
    got = sorted(url_filter.judge(df, URL_RULES, URL_GLOBS).collect())
    assert len(got) == len(rows)
    for r in got:
        assert r.rule == plain(r.host, r.path)
        url = urls[r.page_id] or ""
        if "://" not in url:
            assert (r.host, r.path, r.verdict) == ("", "", "allow")
    verdicts = {r.page_id: r.verdict for r in got}
    assert verdicts[4] == "block" and verdicts[6] == "allow" and verdicts[7] == "allow" and verdicts[11] == "block"
    assert verdicts[16] == "block" and verdicts[17] == "block"
    assert url_filter.judge(df.limit(0), URL_RULES).count() == 0
    assert {r.verdict for r in url_filter.judge(df, [], default="block").collect()} == {"block"}
