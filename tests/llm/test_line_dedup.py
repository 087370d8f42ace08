"""Kept lines against a plain version, with groups that spread over many partitions."""

import random
from collections import defaultdict

import pytest
from matchmill.llm import line_dedup
from tests.llm.helpers import ODD_DOCUMENTS, documents, empty, odd

BLANK = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def plain(rows, min_docs, min_chars, keep_first):
    found = defaultdict(set)
    rows = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    for doc, text in rows:
        for line in (text or "").split("\n"):
            found[key(line)].add((doc, text))
    out, seen = {}, set()
    for doc, text in rows:
        kept = []
        for line in (text or "").split("\n"):
            k = key(line)
            goes = len(k) >= min_chars and len(found[k]) >= min_docs
            if goes and keep_first and k not in seen:
                goes = False
                seen.add(k)
            if not goes:
                kept.append(line)
        out[doc, text] = "\n".join(kept)
    return out


def kept(df, min_docs, min_chars, keep_first):
    bitmaps = line_dedup.keep_bitmaps(df, min_docs, min_chars, keep_first)
    return line_dedup.apply_bitmaps(df, bitmaps).collect()


@pytest.mark.parametrize("partitions", [1, 3, 16])
@pytest.mark.parametrize("keep_first", [True, False])
def test_equals_plain_version(spark, settings, partitions, keep_first):
    settings(spark__sql__shuffle__partitions=str(partitions), spark__sql__adaptive__coalescePartitions__enabled="false")
    draw = random.Random(partitions)
    lines = ["Everywhere", " everywhere\t", "", "  ", "rare É", *[f"line {i}" for i in range(12)]]
    rows = [(i, "\n".join(draw.choice(lines) for _ in range(draw.randrange(1, 9)))) for i in range(120)]
    rows += [(1000 + i, "hot line\n" * 30 + f"own {i}") for i in range(60)]
    got = kept(documents(spark, rows), 10, 1, keep_first)
    want = plain(rows, 10, 1, keep_first)
    assert {(r.doc_id, r["text"]): r.kept_text for r in got} == want
    assert all(r.n_lines == r["text"].count("\n") + 1 for r in got)


def test_batches_within_a_partition(spark, settings):
    settings(spark__sql__execution__arrow__maxRecordsPerBatch="5", spark__sql__shuffle__partitions="2")
    rows = [(i, f"same\n{i % 7} of seven\nown {i}") for i in range(90)]
    for keep_first in (True, False):
        assert {(r.doc_id, r["text"]): r.kept_text for r in kept(documents(spark, rows), 10, 1, keep_first)} == plain(rows, 10, 1, keep_first)


def test_a_row_repeated_often_is_held_once(spark):
    """A row many times over in a group of few documents; what the stream holds does not grow with it."""
    rows = [(1, "often\nown")] * 30_000 + [(2, "often\nother"), (2, "often\nother"), (3, "often")]
    for least in (3, 4):
        got = kept(documents(spark, rows, clash=False), least, 1, False)
        assert len(got) == len(rows)
        assert {(r.doc_id, r["text"]): r.kept_text for r in got} == plain(rows, least, 1, False)
    told = line_dedup.dropped_lines(documents(spark, rows, clash=False), 3, 1, False)
    assert sorted((r.doc_id, r.pos) for r in told.collect()) == [(1, 0), (2, 0), (3, 0)]


def test_odd_rows(spark):
    got = kept(odd(spark), 1, 3, False)
    want = plain(ODD_DOCUMENTS, 1, 3, False)
    assert len(got) == len(ODD_DOCUMENTS)
    for r in got:
        assert (r.kept_text or "") == want[r.doc_id, r["text"]]
    assert kept(empty(spark), 1, 1, True) == []


def test_bitmap_round_trip():
    assert line_dedup.read_bitmap(line_dedup._bitmap([0, 8], 9), 9).tolist() == [False, *[True] * 7, False]
