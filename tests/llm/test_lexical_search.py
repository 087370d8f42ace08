"""Ranked search against a plain scan, over crowded strata, small blocks and odd texts."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from matchmill.llm import lexical_search
from tests.llm.helpers import ODD_DOCUMENTS, documents, empty, odd

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return PATTERN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, queries, k=50):
    held = [(d, Counter(t)) for d, text in docs if (t := terms(text))]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    wanted = {}
    for q, text in queries:
        wanted.setdefault(q, set()).update(terms(text))
    rows = []
    for q, words in wanted.items():
        found = []
        for d, count in held:
            m = 100 - 50 + 50 * sum(count.values()) * n // total
            score = 0
            for w in words & count.keys():
                df = sum(w in c for _, c in held)
                weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
                score += weight * (1_000_000_000 * count[w] // (1000 * count[w] + 20 * m))
            if score:
                found.append((-score, d is None, d or 0, d))
        rows += [(q, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return sorted(rows, key=repr)


def got(spark, docs, queries, k=50):
    df = spark.createDataFrame(queries, "query_id string, text string").selectExpr("*", "1 AS term", "2 AS query", "3 AS terms")
    found = lexical_search.rank_documents(docs, df, k)
    assert found.columns == ["query_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


def corpus(seed, n):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Ähre", "ähre", "日本", "x’y"]
    weight = [1 / (i + 1) for i in range(len(words))]
    docs = []
    for i in range(n):
        size = draw.choice([1, 2, 5, 8, 8, 8, 30, 200])
        docs.append((i * 31 % 997, draw.choice([" ", ", ", "\n"]).join(draw.choices(words, weight, k=size)).upper()))
    docs += docs[5:9] * 3
    queries = [(f"q{i}", " ".join(draw.choices(words, k=draw.randrange(1, 15)))) for i in range(12)]
    return docs, [*queries, ("q1", "w3 w4"), ("none", "unheard of"), ("blank", " .,- "), ("null", None), (None, "w1")]


@pytest.mark.parametrize("block, postings, held, vocabulary", [(4096, 1 << 18, 32 << 20, 200_000), (3, 10, 200, 200_000), (50, 100, 1, 20)])
def test_plain_scan(spark, settings, monkeypatch, block, postings, held, vocabulary):
    settings(spark__sql__execution__arrow__maxRecordsPerBatch="17")
    for name, value in (("BLOCK_DOCS", block), ("BLOCK_POSTINGS", postings), ("HELD", held), ("TERMS", vocabulary)):
        monkeypatch.setattr(lexical_search, name, value)
    docs, queries = corpus(block, 300)
    assert got(spark, documents(spark, docs), queries, 20) == plain(docs, queries, 20)


def test_slices_of_long_texts(monkeypatch):
    text = "One two-three  " * 300 + "x" * 500 + " end Überall ’s 4"
    for size in (1, 7, 64, 1 << 20):
        monkeypatch.setattr(lexical_search, "SLICE", size)
        assert [t.decode() for part in lexical_search.terms_of(text) for t in part] == terms(text)
    assert [p for part in lexical_search.terms_of(None) for p in part] == []


def test_odd_rows(spark):
    queries = [("a", "one another TEXT line"), ("b", "word xx"), ("c", "schön 日本語テキスト")]
    assert got(spark, odd(spark), queries) == plain(ODD_DOCUMENTS, queries)
    assert got(spark, empty(spark), queries) == [] and got(spark, odd(spark), []) == []
    assert got(spark, documents(spark, [(1, None), (2, " . ")]), queries) == []


def test_bounds_order_and_end_the_visits():
    """A stratum that cannot reach the best is not scored, and nothing is lost."""
    weights = np.array([50, 900], np.int64)

    def block(m, docs, groups):
        starts = np.cumsum([0, *[len(g[2]) for g in groups[:-1]]]).astype(np.int32)
        return {
            "m": m, "block": 0, "docs": docs,
            "terms": np.array([g[0] for g in groups], np.int32).tobytes(), "tfs": np.array([g[1] for g in groups], np.int64).tobytes(),
            "starts": starts.tobytes(), "postings": np.concatenate([np.array(g[2], np.int32) for g in groups]).tobytes(),
        }

    rows = [block(500, [7, 8], [(0, 1, [0, 1])]), block(60, [1, 2, 3], [(0, 1, [0]), (1, 1, [1, 2])]), block(70, [4], [(1, 9, [0])])]
    seen = []
    scores = lexical_search._Block.scores
    try:
        lexical_search._Block.scores = lambda self, t: seen.append(self.docs) or scores(self, t)
        best = dict(lexical_search._best(iter([pa.RecordBatch.from_pylist(rows)]), (np.array([0, 1], np.int32), np.array([0])), weights, 3))
    finally:
        lexical_search._Block.scores = scores
    assert seen == [[4], [1, 2, 3]]
    assert [d for _, d in best[0]] == [4, 2, 3]
