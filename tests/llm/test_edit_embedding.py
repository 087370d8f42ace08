"""Fingerprints: a plain walk, likeness against edits, neighbours in order."""

import random

import numpy as np
import pytest
from matchmill.llm import edit_embedding as E
from tests.llm.helpers import documents, empty, odd


def plain_print(text: str) -> bytes:
    symbols = E._symbols(text)
    samples, written, at, step = E._sampled(64 * (len(text) + 1)), [0] * E.BITS, 0, 0
    due, slots = next(samples)
    while at < len(symbols):
        if step == due:
            for s in slots:
                written[s] = symbols[at]
            due, slots = next(samples, (-1, []))
        at += E._COINS[step % E._PERIOD][symbols[at]]
        step += 1
    return np.packbits([E._SIGNS[i, w] if w else 0 for i, w in enumerate(written)]).tobytes()


def test_many_at_once_equal_one_by_one():
    draw = random.Random(2)
    texts = ["", "a", "日本語", *["".join(draw.choice("abcde é") for _ in range(draw.randrange(700))) for _ in range(60)]]
    assert [r.tobytes() for r in E.embed(texts)] == [plain_print(t) for t in texts]
    assert E.embed([]).shape == (0, E.BITS // 8)


def test_likeness_follows_edits():
    draw = random.Random(4)
    make = lambda n: "".join(draw.choice("abcdefghijklmnop ") for _ in range(n))
    texts = [make(3000) for _ in range(30)]

    def changed(text, edits):
        text = list(text)
        for _ in range(edits):
            at = draw.randrange(len(text))
            draw.choice([lambda: text.insert(at, "x"), lambda: text.pop(at), lambda: text.__setitem__(at, "y")])()
        return "".join(text)

    own = E.embed(texts)
    near = [E.likeness(own, E.embed([changed(t, n) for t in texts])).mean() for n in (0, 3, 30)]
    assert near[0] == 1.0 and near[0] > near[1] > near[2] > 0.5
    assert E.likeness(own, np.roll(own, 1, axis=0)).mean() < 0.25


@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_next_documents(spark, settings, partitions):
    settings(spark__sql__shuffle__partitions=str(partitions), spark__sql__execution__arrow__maxRecordsPerBatch="3")
    rows = [(i * 7 % 101, f"text {i} " * (1 + i % 4)) for i in range(101)]
    got = {r.doc_id: (r["text"], r["next"]) for r in E.with_next(documents(spark, rows)).collect()}
    by_id = dict(rows)
    ids = sorted(by_id)
    assert got == {a: (by_id[a], by_id[b]) for a, b in zip(ids, [*ids[1:], ids[0]])}


def test_table(spark):
    rows = [(1, "abcdefgh"), (2, "ABCDEFGHIJKL"), (3, None), (4, "xyz")]
    got = {r.doc_id: r for r in E.compare_neighbours(documents(spark, rows)).collect()}
    assert got[1].edited == "abcdefAB" and got[2].edited == "ABCDEFGHI" and got[3].edited == "" and got[4].edited == "xyz"
    assert [got[i].n_chars for i in (1, 2, 3, 4)] == [8, 12, 0, 3]
    assert got[3].near_edited == 1.0 and got[3].fingerprint == "0" * 64
    assert got[4].near_edited == 1.0 and got[4].bands_edited == E.BITS // E.BAND
    single = E.compare_neighbours(documents(spark, [(9, "abcd")])).collect()
    assert single[0].edited == "abca" and single[0].near_next == 1.0


def test_odd_rows(spark):
    got = E.compare_neighbours(odd(spark)).collect()
    assert len(got) == 9 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    same = [r for r in got if r.doc_id == 1 and r.n_chars == 33]
    assert len({r.fingerprint for r in same}) == 1
    assert E.compare_neighbours(empty(spark)).count() == 0


def test_search(spark):
    draw = random.Random(8)
    texts = ["".join(draw.choice("abcdefghij ") for _ in range(900)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t[:700] + "z" + t[700:]) for i, t in enumerate(texts)]
    prints = documents(spark, rows, clash=False).select("doc_id", E.fingerprint("text").alias("fingerprint"))
    found = {(r.query_id, r.doc_id): r.likeness for r in E.search(prints, prints.where("doc_id % 50 = 0"), 0.5).collect()}
    # 50 and 150 have one fingerprint, whose smallest id stands for both
    assert {(0, 0), (0, 100), (50, 50), (100, 0)} <= set(found)
    assert found[0, 0] == 1.0 and all(b % 100 == a % 100 for a, b in found)
