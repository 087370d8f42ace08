"""Extracts, table steps, joins, guards and dates on hand-made tables."""

import datetime as dt

import pytest
from matchmill.functions import dates
from matchmill.functions import scalars as S
from matchmill.operators import guards, joins, transforms
from matchmill.operators.extract import Join, extract
from pyspark.sql import functions as F
from tests.conftest import rows

D1, D2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def frame(spark, data, ddl):
    return spark.createDataFrame(data, ddl)


@pytest.fixture
def queue(spark):
    return frame(spark, [("n", None), ("b", D2), ("a", D1)], "k string, at timestamp_ntz")


def test_null_order(queue):
    assert extract(queue, ["k"], order="at ASC", limit=1).first()[0] == "a"
    assert extract(queue, ["k"], order="at DESC", limit=1).first()[0] == "n"
    assert extract(queue, ["k"], order="at", limit=1).first()[0] == "a"
    assert extract(queue, ["k"], order="at desc nulls last", limit=1).first()[0] == "b"
    assert extract(queue, ["k"], order="at ASC NULLS FIRST", limit=1).first()[0] == "n"


def test_limit_zero_is_no_limit(queue):
    assert extract(queue, limit=0).count() == 3
    assert extract(queue, limit=2).count() == 2


def test_where(spark):
    t = frame(spark, [(True, 1), (False, 2), (None, 3)], "b boolean, v int")
    assert rows(extract(t, ["v"], where={"b": "is false"})) == [(2,)]
    assert rows(extract(t, ["v"], where={"b": "IS NOT NULL", "v": 1})) == [(1,)]
    assert rows(extract(t, ["v"], where={"b": None})) == []


def test_order_before_select(spark):
    t = frame(spark, [(1, 9), (2, 8)], "a int, b int")
    assert [r[0] for r in extract(t, ["a"], order="b").collect()] == [2, 1]


@pytest.mark.parametrize(
    "kind, expected",
    [
        ("INNER", [(1, "x"), (1, "y")]),
        ("LEFT", [(1, "x"), (1, "y"), (2, None), (None, None)]),
        ("RIGHT", [(1, "x"), (1, "y"), (None, "n"), (None, "z")]),
        ("FULL", [(1, "x"), (1, "y"), (2, None), (None, "n"), (None, "z"), (None, None)]),
    ],
)
@pytest.mark.parametrize("on", ["t_main.id = r.id", [("id", "id")]])
def test_join_types(spark, kind, expected, on):
    left = frame(spark, [(1,), (2,), (None,)], "id int")
    right = frame(spark, [(1, "x"), (1, "y"), (3, "z"), (None, "n")], "id int, v string")
    out = extract(left, ["t_main.id", "r.v"], joins=[Join(right, on, "r", kind)])
    assert rows(out) == sorted(expected, key=repr)


def test_join_after_full_join(spark):
    a = frame(spark, [(1, 10), (2, 20)], "id int, av int")
    b = frame(spark, [(2, 7), (3, 8)], "id int, bv int")
    c = frame(spark, [(7, "seven"), (8, "eight")], "bv int, name string")
    out = extract(
        a,
        ["t_main.*", "b.bv", "c.name"],
        joins=[Join(b, [("id", "id")], "b", "FULL"), Join(c, [("b.bv", "bv")], "c", "LEFT")],
        order="t_main.id",
    )
    assert rows(out) == [(1, 10, None, None), (2, 20, 7, "seven"), (None, None, 8, "eight")]


def test_join_needs_select_and_known_type(queue):
    with pytest.raises(ValueError):
        extract(queue, joins=[Join(queue, "true", "q")])
    with pytest.raises(ValueError):
        extract(queue, ["k"], joins=[Join(queue, "true", "q", "CROSS")])


def test_semi_anti_null_keys(spark):
    left = frame(spark, [(1,), (2,), (None,)], "id int")
    right = frame(spark, [(1,), (1,), (None,)], "id int")
    assert rows(joins.semi_join(left, right, ["id"])) == [(1,)]
    assert rows(joins.anti_join(left, right, ["id"])) == [(2,), (None,)]


def test_keep_and_rename(queue):
    assert transforms.keep_columns(queue, ["at", "k"]).columns == ["at", "k"]
    with pytest.raises(KeyError):
        transforms.keep_columns(queue, ["absent"])
    assert transforms.rename_columns(queue, {"k": "id", "absent": "x"}).columns == ["id", "at"]


def test_dedupe_keeps_first_and_treats_nulls_as_equal(spark):
    t = frame(spark, [("a", 2), ("a", 1), (None, 4), (None, 3), ("b", None), ("b", 5)], "k string, v int")
    once = transforms.dedupe_first(t, ["k"], [F.col("v").asc_nulls_last()])
    assert rows(once) == [("a", 1), ("b", 5), (None, 3)]
    assert rows(transforms.dedupe_first(once, ["k"], ["v"])) == rows(once)


def test_dedupe_of_few_keys_shuffles_only_what_repeats(spark, monkeypatch):
    t = frame(spark, [("a", 2), ("a", 1), (None, 4), (None, 3), ("b", None), ("c", 5)], "k string, v int")
    wanted = [("a", 1), ("b", None), ("c", 5), (None, 3)]
    few = transforms.dedupe_few(t, ["k"], ["v"])
    assert few.columns == ["k", "v"] and rows(few) == wanted
    text = few._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in text and text.index("Window") < text.index("LeftSemi")
    alone = frame(spark, [("a", 2), ("b", 1)], "k string, v int")
    assert "Window" not in transforms.dedupe_few(alone, ["k"], ["v"])._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(transforms, "FEW_KEYS", 1)
    many = transforms.dedupe_few(t, ["k"], ["v"])
    assert rows(many) == wanted and "LeftSemi" not in many._jdf.queryExecution().optimizedPlan().toString()


def test_union(spark):
    a = frame(spark, [(1, "x")], "id int, t string")
    out = transforms.union_sources([a, None, frame(spark, [("y",)], "t string")])
    assert rows(out) == [(1, "x"), (None, "y")]
    with pytest.raises(ValueError):
        transforms.union_sources([None])


def test_paris_stamps(queue):
    summer = transforms.tech_info(queue, "job", dt.datetime(2026, 7, 1, 23, 30))
    assert summer.first()["tech_execution_date"] == "2026-07-02 01:30:00"
    aware = dt.datetime(2026, 7, 2, 1, 30, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    assert transforms.tech_info(queue, "job", aware).first()["tech_execution_date"] == "2026-07-02 01:30:00"
    photo = transforms.tech_photo(queue, "2027-01-01 09:00:00", date_format="%d/%m/%Y").first()
    assert (photo["tech_date_photo"], photo["tech_annee_photo"], photo["tech_semaine_photo"]) == ("01/01/2027", 2026, 53)


def test_date_patterns():
    assert dates.spark_pattern("%Y-%m-%d %H:%M:%S") == "yyyy-MM-dd HH:mm:ss"
    assert dates.spark_pattern("%dT%H") == "dd'T'HH"
    with pytest.raises(ValueError):
        dates.spark_pattern("%Q")


def test_sundays(spark):
    days = [r[0] for r in dates.sundays(spark, [2023], dt.date(2023, 1, 20)).collect()]
    assert days == [dt.date(2023, 1, 1), dt.date(2023, 1, 8), dt.date(2023, 1, 15)]
    both = [r[0] for r in dates.sundays(spark, [2021, 2023], dt.date(2023, 1, 9)).collect()]
    assert len(both) == 52 + 2 and {d.weekday() for d in both} == {6} and both == sorted(both)
    assert dates.sundays(spark, [2030], dt.date(2023, 1, 1)).count() == 0
    with pytest.raises(ValueError):
        dates.sundays(spark, [], dt.date(2023, 1, 1))


def test_kda(spark):
    t = frame(spark, [(1, 8, 0), (5, 0, 3), (5, 2, 0), (27, 10, 0)], "k int, d int, a int")
    ratio = S.kda(F.col("k"), F.col("d"), F.col("a"))
    assert [tuple(r) for r in t.select(ratio, S.stored_as_int(ratio)).collect()] == [
        (0.12, 0),
        (8.0, 8),
        (2.5, 2),
        (2.7, 3),
    ]


def test_texts(spark):
    t = frame(spark, [(["a", "b"],), ([],), (None,)], "tags array<string>")
    assert [r[0] for r in t.select(S.joined_text(F.col("tags"))).collect()] == ["a,b", "", ""]
    t = frame(spark, [("m", "p"), (None, "p")], "a string, b string")
    assert [r[0] for r in t.select(S.row_id(F.col("a"), F.col("b"))).collect()] == [
        "7df277d9664a7f8b42e7942e9cc325c8",
        None,
    ]


def test_guards(spark):
    t = frame(spark, [("a",), ("",)], "puuid string")
    with pytest.raises(guards.SkipJob):
        guards.skip_if_empty(t.where("false"), "t")
    with pytest.raises(guards.SkipJob):
        guards.require_column(t, "match_id")
    with pytest.raises(Exception, match="invalid puuid"):
        guards.require_valid_text(t, "puuid").collect()
    assert guards.require_valid_text(t.where("puuid = 'a'"), "puuid").count() == 1
    assert rows(guards.before_after(t, t.where("puuid = 'a'"))) == [(2, 1, 1)]
    with pytest.raises(ValueError):
        guards.require_unique(t.union(t), ["puuid"], "t")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Europe/Paris"])
def test_epochs_do_not_depend_on_the_session_zone(spark, settings, zone):
    settings(spark__sql__session__timeZone=zone)
    text = ["2024-03-31 02:30:00.123", "2024-10-27 02:30:00", "1969-12-31 23:59:59.5", "2024-03-10 02:15:00"]
    t = spark.createDataFrame([(x,) for x in text], "x string").selectExpr("CAST(x AS TIMESTAMP_NTZ) AS x")
    epoch = dt.datetime(1970, 1, 1)
    ms = [(dt.datetime.fromisoformat(x) - epoch) // dt.timedelta(milliseconds=1) for x in text]
    assert [r[0] for r in t.select(S.to_epoch_ms(F.col("x"))).collect()] == ms
    back = t.select(S.from_epoch_ms(S.to_epoch_ms(F.col("x"))), "x")
    assert all(r[0] == r[1] for r in back.collect())
    assert transforms.tech_info(t, "job", dt.datetime(2026, 7, 1, 23, 30)).first()[2] == "2026-07-02 01:30:00"
