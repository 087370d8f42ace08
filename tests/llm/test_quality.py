"""Trees against a plain walk, held-out accuracy, odd rows."""

import zlib

import numpy as np
from matchmill.llm import quality
from matchmill.llm.queries import QUERIES, table
from tests.conftest import SF_DIR
from tests.llm.helpers import empty, odd


def walk(forest, row):
    margin = forest.base
    for feature, threshold, leaf in zip(forest.feature, forest.threshold, forest.leaf):
        node = 0
        for _ in range(forest.depth):
            node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
        margin += leaf[node - (2**forest.depth - 1)]
    return 1 / (1 + np.exp(-margin))


def test_trees():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 6))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    forest = quality.fit(x[:1000], y[:1000], trees=60, depth=3)
    p = forest.probability(x)
    assert np.allclose(p[:50], [walk(forest, r) for r in x[:50]])
    assert ((p[1000:] > 0.5) == y[1000:]).mean() > 0.95
    assert quality.fit(x[:0], y[:0]).probability(x[:2]).tolist() == [0.5, 0.5]
    assert (quality.fit(x[:10], np.ones(10)).probability(x[:2]) > 0.9).all()


def test_statistics_read_whole_texts(monkeypatch):
    texts = [None, "", "a b\nA B!\n" * 50, "é" * 5000 + " ### tail"]
    whole = quality.statistics(texts)
    monkeypatch.setattr(quality, "CHUNK", 7)
    assert np.allclose(quality.statistics(texts), whole)
    assert np.array_equal(whole[0], whole[1]) and np.isfinite(whole).all()


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in QUERIES["op10_quality"].run(spark, SF_DIR).collect()}
    assert len(rows) == table(spark, SF_DIR, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    known = [(rows[r.doc_id], r.quality) for r in table(spark, SF_DIR, "labels").collect() if rows[r.doc_id].held_out]
    assert sum(r.predicted == q for r, q in known) >= 0.85 * len(known)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows.values())


def test_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 0), (6, 0), (77, 1)], "doc_id long, quality int")
    forest = quality.train(odd(spark), labels)
    got = quality.score_documents(odd(spark), forest).collect()
    assert len(got) == 9 and [r.held_out for r in got if r.doc_id is None] == [False]
    assert quality.train(empty(spark), labels.limit(0)).probability(np.zeros((1, len(quality.FEATURES)))).tolist() == [0.5]
    assert quality.keep_good(odd(spark), forest, 0.0).count() == 9
    assert quality.keep_good(odd(spark), forest, 0.0).columns == odd(spark).columns
    assert quality.score_documents(empty(spark), forest).count() == 0
