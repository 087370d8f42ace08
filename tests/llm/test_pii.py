"""Pseudonyms: the formats hold, equal values stay equal, different ones different, decoys stay."""

import datetime as dt
import re

import pytest
from matchmill.llm import pii
from tests.llm.helpers import documents, empty, odd


def luhn_ok(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def card(prefix: str) -> str:
    return next(prefix + str(d) for d in range(10) if luhn_ok(prefix + str(d)))


def changed(spark, texts, key="k"):
    df = documents(spark, list(enumerate(texts)))
    return {r.doc_id: r for r in pii.pseudonymise(df, key).collect()}


def test_formats(spark):
    number = card("411111111111111")
    texts = [
        f"pay {number[:4]} {number[4:8]} {number[8:12]} {number[12:]} now",
        f"again {number}.",
        "from 10.0.0.255, to 192.168.1.1.",
        "born 1985-02-28 or 28.02.1985 or 13/12/2001",
        "call +1 (017) 555-7713 or 555-123-4567",
        "ssn 219-09-9999",
        "mail Jo.Do+1@Mail7.example.com!",
        'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"',
    ]
    got = changed(spark, texts)
    shape = lambda t: re.sub(r"[0-9]", "9", t)
    for i in (0, 1, 3, 4, 5):
        assert got[i].text != texts[i] and shape(got[i].text) == shape(texts[i])
    first, again = re.sub(r"\D", "", got[0].text), re.sub(r"\D", "", got[1].text)
    assert first == again != number and luhn_ok(first)
    for address in re.findall(r"\d+\.\d+\.\d+\.\d+", got[2].text):
        assert all(int(x) < 256 for x in address.split("."))
    assert got[2].n_found == 2 and got[2].text.endswith(".")
    a, b, c = re.findall(r"\d{4}-\d{2}-\d{2}|\d{2}.\d{2}.\d{4}", got[3].text)
    assert dt.date.fromisoformat(a) == dt.datetime.strptime(b, "%d.%m.%Y").date()
    assert 1800 <= dt.datetime.strptime(c, "%d/%m/%Y").year < 2200
    assert got[4].text.startswith("call +1 (")
    assert re.fullmatch(r"mail [a-z0-9]{2}\.[a-z0-9]{2}\+[a-z0-9]@[a-z0-9]{5}\.[a-z0-9]{7}\.com!", got[6].text)
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', got[7].text) and got[7].text != texts[7]


def test_decoys_stay(spark):
    number = card("411111111111111")
    wrong = number[:-1] + str((int(number[-1]) + 1) % 10)
    texts = [f"x {wrong} y", "1999-02-30 and 1799-01-01", "300.1.1.1 and 1.2.3.4.5", "000-12-1234 666-12-1234", "version 3.0 of 12,345", "24be64439e"]
    got = changed(spark, texts)
    assert all(got[i].text == t and got[i].n_found == 0 for i, t in enumerate(texts))


@pytest.mark.parametrize("kind, values", [
    ("ip", [f"10.0.{i // 250}.{i % 250}" for i in range(2000)]),
    ("date", [str(dt.date(1950, 1, 1) + dt.timedelta(i)) for i in range(2000)]),
    ("card", sorted({card(f"{i:015d}") for i in range(4 * 10**14, 4 * 10**14 + 2000)})),
    ("ssn", [f"{1 + i % 665:03d}-{1 + i % 99:02d}-{1 + i:04d}" for i in range(2000)]),
])
def test_different_values_stay_different(spark, kind, values):
    got = changed(spark, [" ; ".join(values)])[0]
    assert [f.kind for f in got.found] == [kind] * len(values)
    assert len({f.pseudonym for f in got.found}) == len(values)
    other = changed(spark, [" ; ".join(values)], key="another")[0]
    assert sum(a.pseudonym == b.pseudonym for a, b in zip(got.found, other.found)) < 20


def test_odd_rows(spark):
    rows = pii.pseudonymise(odd(spark), "k").collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in rows) == sorted((r.doc_id or 0, r["text"] or "") for r in odd(spark).collect())
    assert sum(r.text is None for r in rows) == 1
    assert pii.pseudonymise(empty(spark), "k").count() == 0
