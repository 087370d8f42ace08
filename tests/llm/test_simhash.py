"""Fingerprints against a plain version, components against all pairs, and crowded keys."""

import random

import numpy as np
import pytest
import xxhash
from matchmill.llm import components, simhash
from pyspark.sql import functions as F
from tests.llm.helpers import documents, empty, odd


def plain_print(text, size):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints: dict, distance: int) -> dict:
    parent = {k: k for k in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if bin(prints[a] ^ prints[b]).count("1") <= distance:
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {k: root(k) for k in ids}


def test_hash_is_sparks_own(spark):
    text = "Ein Überblick über alles mögliche"
    row = spark.createDataFrame([(text,)], "t string").select(F.xxhash64("t")).first()[0]
    assert row & (1 << 64) - 1 == xxhash.xxh64_intdigest(text.encode(), 42)


def test_fingerprint(monkeypatch):
    draw = random.Random(3)
    for n in (0, 1, 2, 3, 4, 50, 500):
        text = " ".join(draw.choice(["The", "Übel", "cat", "sat", "x1"]) for _ in range(n))
        for chunk in (1 << 18, 16):
            monkeypatch.setattr(simhash, "CHUNK", chunk)
            assert simhash.simhash(text, 3)[0] & (1 << 64) - 1 == plain_print(text, 3)
    assert simhash.simhash(None, 3, 3) == [0, 0, 0] and simhash.simhash(" \n", 3) == [0]


def with_prints(spark, prints):
    rows = [(i, int(np.uint64(p).astype(np.int64))) for i, p in enumerate(prints)]
    return spark.createDataFrame(rows, "node long, w0 long").repartition(4)


@pytest.mark.parametrize("block, batch", [(512, 10_000), (3, 10_000), (5, 4), (512, 1)])
def test_links_find_all_within_two_bits(spark, settings, monkeypatch, block, batch):
    settings(spark__sql__execution__arrow__maxRecordsPerBatch=str(batch))
    monkeypatch.setattr(simhash, "BLOCK", block)
    draw = random.Random(block)
    centres = [draw.getrandbits(64) for _ in range(12)]
    prints = {c ^ sum(1 << b for b in draw.sample(range(64), draw.randrange(4))) for c in centres for _ in range(25)}
    prints = sorted(prints)
    found = components.components(simhash.links(with_prints(spark, prints), simhash.EXACT_64))
    got = {i: i for i in range(len(prints))} | {r.node: r.root for r in found.collect()}
    assert got == plain_components(dict(enumerate(prints)), 2)


def test_only_keys_that_bring_classes_together_are_kept():
    """Any cut into batches gives the groups of a member and another row."""
    import pyarrow as pa

    draw = random.Random(6)
    rows = []
    for key in range(60):
        members, lookups = draw.choice([(0, 1), (0, 4), (1, 1), (1, 3), (2, 2), (3, 9)])
        rows += [(key, 2 * m) for m in range(members)] + [(key, 2 * m + 1) for m in range(lookups)]
    want = [r for r in rows if sum(k == r[0] for k, _ in rows) > 2 and (r[0], 0) in rows]
    for size in (1, 2, 3, 5, 17, 1000):
        batches = [pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows[i : i + size])], names=["key", "code"]) for i in range(0, len(rows), size)]
        got = [tuple(r.values()) for b in simhash._met(iter(batches)) for r in b.to_pylist()]
        assert got == want, size


def test_crowded_key_gives_few_links(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 64)
    prints = sorted({1 << 40 | 1 << a | 1 << b for a in range(32) for b in range(32)})
    links = simhash.links(with_prints(spark, prints), simhash.EXACT_64)
    rows = links.count()
    assert rows < 40 * len(prints)
    assert {r.root for r in components.components(links).collect()} == {0}


def test_pairs_in_doubt_come_once(spark, monkeypatch):
    """Links keep what all pairs under common samples connect; of the rest every pair in doubt between roots comes, once."""
    monkeypatch.setattr(simhash, "BLOCK", 7)
    draw = random.Random(14)
    base = draw.getrandbits(1024)
    prints = [base ^ sum(1 << b for b in draw.sample(range(1024), draw.randrange(30, 110))) for _ in range(60)]
    columns = [[(p >> 64 * (15 - w) & (1 << 64) - 1) for w in range(16)] for p in prints]
    signed = [(i, *[w - (w >> 63 << 64) for w in words]) for i, words in enumerate(columns)]
    index = simhash.SIMILAR_1024
    classes = spark.createDataFrame(signed, ["node", *index.columns]).repartition(3)
    masks = [sum(1 << 1023 - b for b in s) for s in index.samples]
    sure, doubt = set(), set()
    for i, p in enumerate(prints):
        for j, q in enumerate(prints[:i]):
            if any((p ^ q) & m == 0 for m in masks) and (far := (p ^ q).bit_count()) <= index.max_distance:
                (sure if far <= index.sure_distance else doubt).add((j, i))
    assert len(sure) > 20 and len(doubt) > 500
    met = simhash._meetings(classes, index)
    found = [tuple(r) for r in simhash.links(classes, index, met).collect()]
    assert {(min(a, b), max(a, b)) for a, b, yes in found if yes} <= sure
    assert {(min(a, b), max(a, b)) for a, b, yes in found if not yes} <= doubt

    def groups(edges) -> dict[int, int]:
        root = {i: i for i in range(60)}
        for a, b in edges:
            low, high = sorted((root[a], root[b]))
            root = {i: low if r == high else r for i, r in root.items()}
        return root

    assert groups((a, b) for a, b, yes in found if yes) == groups(sure)
    assert groups((a, b) for a, b, _ in found) == groups(sure | doubt)
    with_root = classes.withColumn("root", simhash.F.col("node") % 5)
    got = [tuple(sorted(r)) for r in simhash.doubtful(met, with_root, index).collect()]
    assert len(got) == len(set(got)) and set(got) == {(a, b) for a, b in doubt if a % 5 != b % 5}


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000 - i, 1000) for i in range(1, 50)] + [(5, 5), (7, 6)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {i: 951 for i in range(951, 1001)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_copies_and_one_of_each(spark):
    draw = random.Random(9)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(400)]
    near = base[:200] + ["changed"] + base[201:]
    rows = [(i, " ".join(word() for _ in range(300))) for i in range(20)]
    rows += [(100, " ".join(base)), (101, " ".join(near)), (102, " ".join(base).upper()), (103, " ".join(base)), (103, " ".join(base))]
    df = documents(spark, rows)
    got = simhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    assert {r.component_id for r in got if r.doc_id >= 100} == {100}
    assert all(r.component_id == r.doc_id for r in got if r.doc_id < 100)
    left = simhash.one_of_each(df)
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect()) == [*range(20), 100]


def test_similarity_recall(spark):
    """Pairs that share 90 % of their five-word shingles are found but for a few."""
    draw = random.Random(11)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(6))
    rows = []
    for i in range(120):
        base = [word() for _ in range(600)]
        near = list(base)
        for at in range(30, 600, 100):
            near[at] = word()
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(near))]
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(documents(spark, rows)).collect()}
    assert sum(got[2 * i + 1] == 2 * i for i in range(120)) >= 108
    assert all(got[i] // 2 == i // 2 for i in got)


def test_recall_from_0_8_against_all_pairs(spark):
    """Pairs of a similarity from 0.8 to 0.85 are found but for very few, and none below 0.8."""
    draw = random.Random(12)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(6))
    rows = []
    for i in range(300):
        base = [word() for _ in range(600)]
        near = list(base)
        for at in draw.sample(range(5, 595, 10), draw.randrange(9, 17)):
            near[at] = word()
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(near))]
    shingles = {i: {tuple(t.split()[k : k + 5]) for k in range(596)} for i, t in rows}
    true = {i: len(shingles[2 * i] & shingles[2 * i + 1]) / len(shingles[2 * i] | shingles[2 * i + 1]) for i in range(300)}
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(documents(spark, rows)).collect()}
    found = {i for i in range(300) if got[2 * i + 1] == 2 * i}
    edge = {i for i in range(300) if 0.8 <= true[i] < 0.85}
    assert len(edge) > 80 and len(edge & found) >= 0.97 * len(edge)
    assert not [i for i in found if true[i] < 0.8] and sum(t < 0.8 for t in true.values()) > 50
    assert all(got[i] // 2 == i // 2 for i in got)


def test_odd_rows(spark):
    got = simhash.near_duplicates(odd(spark), 3, simhash.EXACT_64).collect()
    assert len(got) == 9
    assert {r.component_id for r in got if r.w0 == 0} == {2}
    assert sum(r.stays for r in got if r.component_id == 2) == 1
    assert sorted(str(r.doc_id) for r in simhash.one_of_each(odd(spark)).collect()) == ["1", "1", "2", "5", "6", "None"]
    assert simhash.near_duplicates(empty(spark)).count() == 0 and simhash.one_of_each(empty(spark)).count() == 0


@pytest.mark.parametrize("held", [1 << 17, 2])
def test_drawn_segments_have_balls_of_one_flip(spark, monkeypatch, held):
    """Pairs meet, once, if any segment differs in one bit at most, also where more rows share a half than a task holds."""
    monkeypatch.setattr(simhash, "HELD", held)
    monkeypatch.setattr(simhash, "ARROW_ROWS", 3)
    draw = random.Random(15)
    segments = simhash._drawn(64, 18, 5)
    index = simhash.Index(words=1, segments=(), max_distance=64, drawn=segments, sure_distance=-1, similarity=0.8)
    centres = [draw.getrandbits(64) for _ in range(4)]
    prints = sorted({c ^ sum(1 << b for b in draw.sample(range(64), draw.randrange(14))) for c in centres for _ in range(30)})
    masks = [sum(1 << 63 - b for b in s) for s in segments]
    meet = {(j, i) for i, p in enumerate(prints) for j, q in enumerate(prints[:i]) if any(((p ^ q) & m).bit_count() <= 1 for m in masks)}
    exact = {(j, i) for i, p in enumerate(prints) for j, q in enumerate(prints[:i]) if any((p ^ q) & m == 0 for m in masks)}
    assert len(exact) + 100 < len(meet)
    classes = with_prints(spark, prints)
    met = simhash._meetings(classes, index)
    got = [tuple(sorted(r)) for r in simhash.doubtful(met, classes.withColumn("root", F.col("node")), index).collect()]
    assert len(got) == len(set(got)) and set(got) == meet
