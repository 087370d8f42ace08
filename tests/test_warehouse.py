"""Warehouse tables: DDL, inserts, versions, merges by partition."""

import uuid
from urllib.parse import unquote, urlparse

import pytest
from matchmill import schemas
from matchmill.operators import guards
from matchmill.sources.versions import VersionedWarehouse
from matchmill.sources.warehouse import BUCKET, Warehouse
from pyarrow import parquet
from pyspark.sql import functions as F
from tests.conftest import NOW, rows

KV = {"k": "STRING", "v": "INT"}


def frame(spark, data, ddl="k string, v int"):
    return spark.createDataFrame(data, ddl)


def test_append_replace_fail(spark, warehouse):
    done = warehouse.insert(frame(spark, [("a", 1)]), "raw.t", "fail")
    assert done == {"table_name": "t", "schema": "raw", "rows_inserted": 1}
    warehouse.insert(frame(spark, [("b", 2)]), "raw.t")
    assert rows(warehouse.read("raw.t")) == [("a", 1), ("b", 2)]
    with pytest.raises(ValueError):
        warehouse.insert(frame(spark, [("c", 3)]), "raw.t", "fail")
    warehouse.insert(frame(spark, [("c", 3)]), "raw.t", "replace")
    assert rows(warehouse.read("raw.t")) == [("c", 3)]
    warehouse.insert(frame(spark, [(1.5,)], "other double"), "raw.t", "replace")
    assert rows(warehouse.read("raw.t")) == [(1.5,)]
    with pytest.raises(ValueError):
        warehouse.insert(frame(spark, [("c", 3)]), "raw.t", "upsert")


def test_replace_may_read_the_table_it_replaces(spark, warehouse):
    warehouse.insert(frame(spark, [("a", 1), ("b", 2)]), "raw.t")
    warehouse.insert(warehouse.read("raw.t").where("v > 1"), "raw.t", "replace")
    assert rows(warehouse.read("raw.t")) == [("b", 2)]


def test_empty_insert_fails_and_changes_nothing(spark, warehouse):
    warehouse.insert(frame(spark, [("a", 1)]), "raw.t")
    for mode in ("append", "replace"):
        with pytest.raises(guards.NoRows):
            warehouse.insert(frame(spark, []), "raw.t", mode)
    assert rows(warehouse.read("raw.t")) == [("a", 1)]


def test_job_columns_on_insert(spark, warehouse):
    warehouse.insert(frame(spark, [("a", 1)]), "raw.t", "replace", "job", NOW)
    assert rows(warehouse.read("raw.t")) == [("a", 1, "job", "2026-01-02 04:04:05")]


def test_names_are_checked(warehouse):
    with pytest.raises(ValueError):
        warehouse.create_table("raw.t; drop", KV)
    with pytest.raises(ValueError):
        warehouse.create_table("raw.t", {"a b": "INT"})
    with pytest.raises(ValueError):
        warehouse.create_table("raw.t", KV, ["absent"])


def test_defaults_and_lines(spark, warehouse):
    warehouse.create_table("raw.t", {**KV, "done": "BOOLEAN"}, ["k"], {"done": "false"})
    warehouse.create_table("raw.t", {**KV, "done": "BOOLEAN"}, ["k"])
    assert warehouse.insert_lines("raw.t", []) is None
    assert warehouse.insert_lines("raw.t", [{"v": 1, "k": "a"}, {"k": "b"}])["rows_inserted"] == 2
    assert rows(warehouse.read("raw.t")) == [("a", 1, False), ("b", None, False)]
    with pytest.raises(KeyError):
        warehouse.insert_lines("raw.t", [{"x": 1}])
    warehouse.insert_lines("raw.new", [{"k": "a"}], KV)
    assert rows(warehouse.read("raw.new")) == [("a", None)]
    warehouse.check_key("raw.t")


@pytest.mark.parametrize("bucket_key", [None, "k"])
def test_primary_keys_are_kept(spark, warehouse, bucket_key):
    warehouse.create_table("raw.t", KV, ["k"], bucket_key=bucket_key)
    warehouse.insert_lines("raw.t", [{"k": "a", "v": 1}, {"k": "b"}])
    for bad in ([{"k": "a"}], [{"k": "c"}, {"k": "c"}]):
        with pytest.raises(ValueError):
            warehouse.insert_lines("raw.t", bad)
        with pytest.raises(ValueError):
            warehouse.insert(frame(spark, [(x["k"], 2) for x in bad]), "raw.t")
    with pytest.raises(ValueError):
        warehouse.merge(frame(spark, [("z", 1), ("z", 2)]), "raw.t", ["k"], (), {"k": "k", "v": "v"}, has_not_matched=True)
    assert rows(warehouse.read("raw.t")) == [("a", 1), ("b", None)]
    warehouse.check_key("raw.t")


def test_text_lengths_are_kept(spark, warehouse):
    warehouse.create_table("raw.t", {"k": "VARCHAR(5)", "v": "INT"}, ["k"])
    warehouse.insert_lines("raw.t", [{"k": "short", "v": 1}])
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        warehouse.insert(frame(spark, [("longer", 2)]), "raw.t")
    warehouse.create_table("raw.u", {"k": "STRING", "v": "VARCHAR(5)"}, ["k"], bucket_key="k")
    warehouse.insert_lines("raw.u", [{"k": "a", "v": "short"}])
    for change in (
        lambda: warehouse.update("raw.u", {"v": "longer"}, {"k": "a"}),
        lambda: warehouse.merge(frame(spark, [("a", "longer")], "k string, v string"), "raw.u", ["k"], ["v"], has_matched=True),
    ):
        with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
            change()
    assert rows(warehouse.read("raw.t")) == [("short", 1)] and rows(warehouse.read("raw.u")) == [("a", "short")]


def test_updates_rewrite_only_what_changes(spark, warehouse):
    warehouse.create_table("fact.t", KV, ["k"], bucket_key="k")
    warehouse.insert(frame(spark, [(f"k{i}", i) for i in range(100)]), "fact.t")
    for where in ({"k": "k7"}, {"v": 9}):
        before = set(warehouse._stored("fact.t").inputFiles())
        assert warehouse.update("fact.t", {"v": -1}, where)["rows_updated"] == 1
        after = set(warehouse._stored("fact.t").inputFiles())
        assert len(after - before) == 1 and len(after & before) == len(before) - 1
    assert warehouse.update("fact.t", {"v": -2}, {"v": 10**6})["rows_updated"] == 0
    assert warehouse.read("fact.t").count() == 100 and warehouse.read("fact.t").where("v = -1").count() == 2


def test_both_branches_of_a_merge_read_their_partitions_only(spark, warehouse, monkeypatch):
    columns = {**KV, "tech_date_creation": "TIMESTAMP_NTZ", "tech_date_modification": "TIMESTAMP_NTZ"}
    warehouse.create_table("fact.t", columns, ["k"], bucket_key="k")
    warehouse.insert(frame(spark, [(f"k{i}", i) for i in range(100)]), "fact.t")
    seen = []
    from matchmill.operators import merge

    for name in ("unmatched_source", "matched_rows"):
        def spy(target, *rest, real=getattr(merge, name), **options):
            seen.append(target._jdf.queryExecution().executedPlan().toString())
            return real(target, *rest, **options)

        monkeypatch.setattr(merge, name, spy)
    warehouse.merge(frame(spark, [("k7", -1)]), "fact.t", ["k"], ["v"], {"k": "k", "v": "v"}, has_matched=True, has_not_matched=True)
    assert len(seen) == 2 and all(f"PartitionFilters: [{BUCKET}" in p or f"({BUCKET}" in p.split("PartitionFilters")[1][:60] for p in seen)


def test_fraction_is_rounded_into_whole_column(spark, warehouse):
    warehouse.create_table("raw.t", KV)
    warehouse.insert(frame(spark, [("a", 2.5), ("b", 2.7)], "k string, v double"), "raw.t")
    assert rows(warehouse.read("raw.t")) == [("a", 2), ("b", 3)]


@pytest.mark.parametrize("bucket_key", [None, "k"])
def test_merge_branches(spark, warehouse, bucket_key):
    columns = {**KV, "tech_date_creation": "TIMESTAMP_NTZ", "tech_date_modification": "TIMESTAMP_NTZ"}
    warehouse.create_table("fact.t", columns, ["k"], bucket_key=bucket_key)
    options = {"match_columns": ["v"], "non_match_columns": {"k": "k", "v": "v"}, "now": NOW}
    first = warehouse.merge(
        frame(spark, [("a", 1), ("b", 2), (None, 3)]), "fact.t", ["k"], has_not_matched=True, **options
    )
    assert first["operations_performed"] == ["INSERT"] and first["rows_affected"] == 3
    second = warehouse.merge(frame(spark, [("b", 5), ("z", 9)]), "fact.t", ["k"], has_matched=True, **options)
    assert second["operations_performed"] == ["UPDATE"] and second["rows_affected"] == 1
    third = warehouse.merge(
        frame(spark, [("a", 7), ("c", 8), (None, 4)]),
        "fact.t",
        ["k"],
        has_matched=True,
        has_not_matched=True,
        **options,
    )
    assert third["rows_affected"] == 3
    out = warehouse.read("fact.t")
    assert rows(out.select("k", "v")) == [("a", 7), ("b", 5), ("c", 8), (None, 3), (None, 4)]
    assert out.where(F.col("tech_date_creation") != F.lit(NOW)).count() == 0
    assert BUCKET not in out.columns


def test_merge_rewrites_only_touched_partitions(spark, warehouse):
    warehouse.create_table("fact.t", KV, ["k"], bucket_key="k")
    warehouse.insert(frame(spark, [(f"k{i}", i) for i in range(100)]), "fact.t")

    def files():
        return set(warehouse._stored("fact.t").inputFiles())

    before = files()
    warehouse.merge(frame(spark, [("k7", -1)]), "fact.t", ["k"], ["v"], has_matched=True)
    after = files()
    assert len(after & before) >= 3 and after - before
    assert warehouse.read("fact.t").where("v = -1").count() == 1
    assert warehouse.read("fact.t").count() == 100


def test_update_and_update_in(spark, warehouse):
    warehouse.create_table("fact.t", KV, ["k"], bucket_key="k")
    warehouse.insert(frame(spark, [("a", 1), ("b", 2), ("c", 3)]), "fact.t")
    assert warehouse.update("fact.t", {"v": 0}, {"k": "a"})["rows_updated"] == 1
    members = frame(spark, [("b",), ("c",), ("x",)], "k string")
    assert warehouse.update_in("fact.t", {"v": 9}, "k", members)["rows_updated"] == 2
    assert rows(warehouse.read("fact.t")) == [("a", 0), ("b", 9), ("c", 9)]
    with pytest.raises(ValueError):
        warehouse.update("fact.t", {"k": "z"}, {"v": 0})


def test_insert_ignore(spark, warehouse):
    warehouse.create_table("fact.t", KV, ["k"])
    warehouse.insert(frame(spark, [("a", 1)]), "fact.t")
    assert warehouse.insert_ignore(frame(spark, [("a", 2), ("b", 3)]), "fact.t", ["k"]) == 1
    assert rows(warehouse.read("fact.t")) == [("a", 1), ("b", 3)]


def test_fixed_tables(spark, warehouse):
    warehouse.create_fixed()
    for table in schemas.FIXED_TABLES:
        assert warehouse.read(table.name).columns == list(table.columns)
    warehouse.insert_lines(schemas.FACT_MATCH.name, [{"match_id": "m"}])
    row = warehouse.read(schemas.FACT_MATCH.name).first()
    assert row["is_processed"] is False and row["game_in_progress"] is False and row["tech_date_creation"] is not None


def test_extract_by_name(spark, warehouse):
    warehouse.insert(frame(spark, [("a", 1), ("b", 2)]), "fact.t")
    warehouse.insert(frame(spark, [("a", 10)]), "fact.u")
    warehouse.insert(frame(spark, [("b", 20)]), "mart.u")
    out = warehouse.extract(
        "fact.t",
        ["t_main.k", "x.v", "m.v AS w"],
        joins=[
            {"table": "u", "on": "t_main.k = x.k", "alias": "x", "type": "LEFT"},
            {"table": "mart.u", "on": "t_main.k = m.k", "alias": "m", "type": "LEFT"},
        ],
        order="t_main.k",
    )
    assert rows(out) == [("a", 10, None), ("b", None, 20)]
    plain = warehouse.extract("fact.t", ["t_main.v + u.v AS total"], joins=[{"table": "u", "on": "t_main.k = u.k"}])
    assert rows(plain) == [(11,)]
    with pytest.raises(guards.SkipJob):
        warehouse.extract("fact.t", where={"k": "z"}, skip_empty=True)


@pytest.mark.parametrize("bucket_key", [None, "k"])
def test_upkeep(spark, warehouse, bucket_key):
    warehouse.create_table("fact.t", KV, ["k"], bucket_key=bucket_key)
    for i in range(3):
        warehouse.insert(frame(spark, [(f"k{i}-{j}", j) for j in range(20)]), "fact.t")
    warehouse.update("fact.t", {"v": -1}, {"k": "k0-3"})
    files = len(warehouse._stored("fact.t").inputFiles())
    want = rows(warehouse.read("fact.t"))
    assert warehouse.compact("fact.t") == 60
    assert len(warehouse._stored("fact.t").inputFiles()) < files
    assert warehouse.remove_replaced("fact.t") >= 1 and warehouse.remove_replaced("fact.t") == 0
    assert rows(warehouse.read("fact.t")) == want
    warehouse.insert(frame(spark, [("later", 1)]), "fact.t")
    assert warehouse.read("fact.t").count() == 61


def test_a_partitioned_update_lost_midway_is_completed_by_its_rerun(spark, warehouse, monkeypatch):
    warehouse.create_table("fact.t", KV, ["k"], bucket_key="k")
    warehouse.insert(frame(spark, [(f"k{i}", i) for i in range(40)]), "fact.t")
    source = frame(spark, [(f"k{i}", -1) for i in range(40)])
    switched, real = [], type(spark).sql

    def lost(self, text, *args, **options):
        if "PARTITION" in text and "SET LOCATION" in text:
            switched.append(text)
            if len(switched) == 2:
                raise RuntimeError("lost")
        return real(self, text, *args, **options)

    monkeypatch.setattr(type(spark), "sql", lost)
    with pytest.raises(RuntimeError):
        warehouse.merge(source, "fact.t", ["k"], ["v"], has_matched=True)
    between = warehouse.read("fact.t")
    assert between.count() == 40 and 0 < between.where("v = -1").count() < 40
    warehouse.merge(source, "fact.t", ["k"], ["v"], has_matched=True)
    assert rows(warehouse.read("fact.t")) == sorted((f"k{i}", -1) for i in range(40))


def test_keyed_rows_are_written_once(spark, warehouse, monkeypatch):
    """Into a partitioned table: no copy for the key check, defaults and lengths as in an append; rows widen after they are gathered."""
    from matchmill.sources import warehouse as module

    cuts, real = [], module.cut_lineage
    monkeypatch.setattr(module, "cut_lineage", lambda df, name: cuts.append(name) or real(df, name))
    warehouse.create_table("fact.t", {**KV, "w": "VARCHAR(5)", "done": "BOOLEAN"}, ["k"], {"done": "false"}, "k")
    derive = lambda rows: rows.withColumn("w", F.concat(F.lit("w"), "v"))
    assert warehouse.insert(frame(spark, [(f"k{i}", i) for i in range(20)]), "fact.t", derive=derive)["rows_inserted"] == 20
    assert warehouse.insert(frame(spark, [(f"k{i}", i) for i in range(20, 45)]), "fact.t", derive=derive)["rows_inserted"] == 25
    assert cuts == []
    assert rows(warehouse.read("fact.t")) == sorted((f"k{i}", i, f"w{i}", False) for i in range(45))
    for bad in ([("k3", 1)], [("x", 1), ("x", 1)], [("x", 100000)], [(None, 1), (None, 2)]):
        with pytest.raises(Exception, match="keys already|not unique|EXCEED_LIMIT_LENGTH"):
            warehouse.insert(frame(spark, bad), "fact.t", derive=derive)
    assert warehouse.read("fact.t").count() == 45
    with pytest.raises(guards.NoRows):
        warehouse.insert(frame(spark, []), "fact.t")


def test_a_merge_into_an_empty_table_copies_nothing(spark, warehouse, monkeypatch):
    from matchmill.operators import merge
    from matchmill.sources import warehouse as module

    cuts = []
    for where in (module, merge):
        monkeypatch.setattr(where, "cut_lineage", lambda df, name, real=where.cut_lineage: cuts.append(name) or real(df, name))
    columns = {**KV, "tech_date_creation": "TIMESTAMP_NTZ", "tech_date_modification": "TIMESTAMP_NTZ"}
    warehouse.create_table("mart.t", columns)
    warehouse.insert(frame(spark, [("a", 1), ("b", 2), (None, 3)]), "raw.t")
    options = {"match_columns": ["v"], "non_match_columns": {"k": "k", "v": "v"}, "has_matched": True, "has_not_matched": True, "now": NOW}
    assert warehouse.merge(warehouse.read("raw.t"), "mart.t", ["k"], **options)["rows_affected"] == 3
    assert cuts == []
    warehouse.insert(frame(spark, [("a", 10), ("b", 20)]), "raw.t", "replace")
    assert warehouse.merge(warehouse.read("raw.t"), "mart.t", ["k"], **options)["rows_affected"] == 2
    assert "merge-source" not in cuts  # its keys do not repeat
    assert rows(warehouse.read("mart.t").select("k", "v")) == [("a", 10), ("b", 20), (None, 3)]
    warehouse.insert(frame(spark, [("c", 1), ("c", 2)]), "raw.t", "replace")
    warehouse.merge(warehouse.read("raw.t"), "mart.t", ["k"], **options)
    with pytest.raises(Exception, match="two source rows"):
        warehouse.merge(warehouse.read("raw.t"), "mart.t", ["k"], **options)


@pytest.mark.parametrize("kind", [Warehouse, VersionedWarehouse])
@pytest.mark.parametrize("bucket_key", [None, "k"])
def test_tables_are_stored_compressed_however_they_are_written(spark, tmp_path, kind, bucket_key):
    made = kind(spark, str(tmp_path / "codec"), f"codec_{uuid.uuid4().hex[:12]}_", 2)
    made.create_table("fact.t", KV, ["k"], bucket_key=bucket_key)
    made.insert(frame(spark, [(f"k{i}", i) for i in range(9)]), "fact.t")
    made.insert(frame(spark, [(f"k{i}", i) for i in range(9, 20)]), "fact.t")
    made.update("fact.t", {"v": 7}, {"k": "k3"})
    made.insert(frame(spark, [("x", 1)]), "raw.t")
    made.insert(frame(spark, [("y", 1)]), "raw.t", "replace")
    made.insert(frame(spark, [("z", 1)]), "raw.t")
    files = [f for name in ("fact.t", "raw.t") for f in made.read(name).inputFiles()]
    found = [parquet.ParquetFile(unquote(urlparse(f).path)).metadata for f in files]
    assert {m.row_group(0).column(0).compression for m in found if m.num_rows} == {"ZSTD"}
    assert made.read("fact.t").count() == 20
