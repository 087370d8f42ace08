"""Merge, update and insert-or-ignore on hand-made tables."""

import datetime as dt

import pytest
from matchmill.functions import dates
from matchmill.operators import merge
from pyspark.sql import functions as F
from tests.conftest import NOW, rows

KV = "k string, v int"


def frame(spark, data, ddl=KV):
    return spark.createDataFrame(data, ddl)


def upsert(target, source, **extra):
    return merge.merge_into(
        target, source, ["k"], ["v"], {"k": "k", "v": "v"}, has_matched=True, has_not_matched=True, **extra
    )


def test_null_key_is_inserted_again(spark):
    out = upsert(frame(spark, [(None, 1)]), frame(spark, [(None, 2)]))
    assert rows(out) == [(None, 1), (None, 2)]


def test_null_value_overwrites(spark):
    out = merge.merge_into(frame(spark, [("a", 1)]), frame(spark, [("a", None)]), ["k"], ["v"], has_matched=True)
    assert rows(out) == [("a", None)]


def test_duplicate_source_for_one_target_row_fails(spark):
    with pytest.raises(Exception, match="two source rows"):
        upsert(frame(spark, [("a", 0)]), frame(spark, [("a", 1), ("a", 2)])).collect()


def test_duplicate_source_without_target_row_is_inserted(spark):
    out = upsert(frame(spark, [("b", 0)]), frame(spark, [("a", 1), ("a", 2), ("b", 3)]))
    assert rows(out) == [("a", 1), ("a", 2), ("b", 3)]


def test_insert_only_per_match(spark):
    ddl = "match_id string, id string"
    source = frame(spark, [("m1", f"p{i}") for i in range(10)], ddl)
    columns = {"match_id": "match_id", "id": "id"}

    def insert(target):
        return merge.merge_into(
            target, source, ["match_id"], (), columns, has_not_matched=True
        )

    first = insert(frame(spark, [], ddl))
    assert first.count() == 10
    assert insert(first).count() == 10
    assert insert(frame(spark, [("m1", "p3")], ddl)).count() == 1


def test_other_columns_are_untouched(spark):
    early = dt.datetime(2020, 1, 1)
    ddl = "k string, tier string, tag string, tech_date_creation timestamp_ntz, tech_date_modification timestamp_ntz"
    target = frame(spark, [("a", "IRON", "t", early, early), ("b", "IRON", "u", early, early)], ddl)
    source = frame(spark, [("a", "GOLD")], "k string, tier string")
    out = merge.merge_into(target, source, ["k"], {"tier": "ignored"}, has_matched=True, now=dates.utc_timestamp(NOW))
    assert rows(out) == [("a", "GOLD", "t", early, NOW), ("b", "IRON", "u", early, early)]


def test_inserted_rows_get_defaults_dates_and_renames(spark):
    ddl = "k string, v int, done boolean, tech_date_creation timestamp_ntz, tech_date_modification timestamp_ntz"
    source = frame(spark, [("a", 2.7), ("b", 2.5)], "k string, x double")
    out = merge.merge_into(
        frame(spark, [], ddl),
        source,
        ["k"],
        (),
        {"k": "k", "v": "x"},
        has_not_matched=True,
        now=dates.utc_timestamp(NOW),
        defaults={"done": "false"},
    )
    assert rows(out) == [("a", 3, False, NOW, NOW), ("b", 2, False, NOW, NOW)]


def test_branches_are_mandatory(spark):
    t = frame(spark, [("a", 1)])
    with pytest.raises(ValueError):
        merge.merge_into(t, t, ["k"], ["v"])
    with pytest.raises(ValueError):
        merge.merge_into(t, t, ["k"], has_matched=True)
    with pytest.raises(ValueError):
        merge.merge_into(t, t, ["k"], has_not_matched=True)


def test_update_guards(spark):
    t = frame(spark, [("a", 1)])
    with pytest.raises(ValueError):
        merge.update_where(t, {}, {"k": "a"})
    with pytest.raises(ValueError):
        merge.update_where(t, {"v": 1}, {})
    with pytest.raises(KeyError):
        merge.update_where(t, {"w": 1}, {"k": "a"})


def test_update_sql_functions_and_null_conditions(spark):
    t = frame(spark, [("a", "x", None), (None, "y", None)], "k string, t string, at timestamp_ntz")
    out = merge.update_where(t, {"at": "CURRENT_TIMESTAMP", "t": "null"}, {"k": "a"}).collect()
    by_key = {r["k"]: r for r in out}
    assert by_key["a"]["at"] is not None and by_key["a"]["t"] is None and by_key["a"]["_updated"]
    assert by_key[None]["at"] is None and by_key[None]["t"] == "y" and not by_key[None]["_updated"]


def test_update_with_scalar_from_table(spark):
    t = frame(spark, [("a", 1), ("b", 2)])
    pick = frame(spark, [("b", 9), ("a", 1)]).orderBy(F.desc("v")).select("k")
    assert rows(merge.update_where(t, {"v": 0}, {"k": pick}).drop("_updated")) == [("a", 1), ("b", 0)]


def test_update_where_in_ignores_nulls_and_repeats(spark):
    t = frame(spark, [("a", 1), (None, 2), ("c", 3)])
    members = frame(spark, [("a",), ("a",), (None,)], "k string")
    out = merge.update_where_in(t, {"v": 0}, "k", members)
    assert rows(out.drop("_updated")) == [("a", 0), ("c", 3), (None, 2)]


def test_insert_ignore(spark):
    t = frame(spark, [("a", 1)])
    assert rows(merge.insert_ignore(t, frame(spark, [("a", 5), ("b", 6), ("b", 6)]), ["k"])) == [("b", 6)]


def test_values_that_are_all_replaced_are_not_read(spark, tmp_path):
    target, source = str(tmp_path / "target"), str(tmp_path / "source")
    spark.range(20).selectExpr("id AS k", "id AS kept", "-id AS v").write.parquet(target)
    spark.range(25).selectExpr("id AS k", "id * 2 AS v").write.parquet(source)
    target, source = spark.read.parquet(target), spark.read.parquet(source)
    changed = merge.matched_rows(target, source, ["k"], ["v"], F.current_timestamp(), written=True)
    assert "ReadSchema: struct<k:bigint,kept:bigint>" in changed._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, changed.collect())) == [(i, i, 2 * i, True) for i in range(20)]
    # One row, or one without a key, that the source has not: its old value stays.
    for other in (spark.range(99, 100).selectExpr("id AS k"), spark.range(1).selectExpr("CAST(NULL AS BIGINT) AS k")):
        more = target.unionByName(other.selectExpr("k", "7L AS kept", "8L AS v"))
        changed = merge.matched_rows(more, source, ["k"], ["v"], F.current_timestamp(), written=True)
        assert changed.where("NOT _matched").select("kept", "v").collect() == [(7, 8)] and changed.count() == 21
