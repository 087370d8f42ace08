"""Versioned tables: readers between any two statements, and the same results as the plain warehouse."""

import pytest
from matchmill import schemas
from matchmill.operators import guards
from matchmill.sources.versions import Generation, VersionedWarehouse
from matchmill.sources.warehouse import BUCKET
from tests.conftest import NOW, rows

KV = {"k": "STRING", "v": "INT"}


class Lost(Exception):
    pass


@pytest.fixture
def versioned(spark, tmp_path):
    return VersionedWarehouse(spark, str(tmp_path / "wh"), f"v_{tmp_path.name.replace('-', '_')}_", buckets=4, generations=3)


def frame(spark, data, ddl="k string, v int"):
    return spark.createDataFrame(data, ddl)


def upsert(warehouse, source, **more):
    return warehouse.merge(source, "raw.t", ["k"], ["v"], {"k": "k", "v": "v"}, True, True, now=NOW, **more)


def every_loss(monkeypatch, warehouse, change, read):
    """What readers see when the job is lost before its first, second, ... statement, and after the last."""
    seen = []
    for allowed in range(30):
        run, left = VersionedWarehouse._sql, [allowed]

        def counted(self, statement, run=run, left=left):
            if left[0] == 0 and not statement.startswith(("SHOW", "DESCRIBE")):
                raise Lost(statement)
            left[0] -= not statement.startswith(("SHOW", "DESCRIBE"))
            return run(self, statement)

        with monkeypatch.context() as patch:
            patch.setattr(VersionedWarehouse, "_sql", counted)
            try:
                change()
            except Lost:
                seen.append(read())
                continue
        seen.append(read())
        return seen
    raise AssertionError("never done")


@pytest.mark.parametrize("bucket_key", [None, "k"])
def test_readers_see_before_or_after(spark, versioned, monkeypatch, bucket_key):
    """Upserts, updates, appends and replacements by other columns, lost before each of their statements."""
    versioned.create_table("raw.t", KV, ["k"], bucket_key=bucket_key)
    versioned.insert(frame(spark, [(f"k{i}", i) for i in range(20)]), "raw.t")
    source = frame(spark, [(f"k{i}", 100 + i) for i in range(15, 25)])
    read = lambda: rows(versioned.read("raw.t"))
    changes = [
        lambda: upsert(versioned, source),
        lambda: versioned.update("raw.t", {"v": 0}, {"k": "k3"}),
        lambda: versioned.insert(frame(spark, [("new", 1), ("newer", 2)]), "raw.t"),
        lambda: versioned.compact("raw.t"),
        lambda: versioned.insert(frame(spark, [("a", 1)]), "raw.t", "replace"),
        lambda: versioned.insert(frame(spark, [(1.5, True)], "other double, flag boolean"), "raw.t", "replace"),
    ]
    for change in changes:
        before = read()
        seen = every_loss(monkeypatch, versioned, change, read)
        after = seen[-1]
        assert len(seen) > 1 and all(s in (before, after) for s in seen)
        assert seen.count(after) <= 2 or before == after
    assert read() == [(1.5, True)]


def test_an_open_frame_keeps_its_version(spark, versioned):
    versioned.create_table("raw.t", KV, bucket_key="k")
    versioned.insert(frame(spark, [("a", 1), ("b", 2)]), "raw.t")
    before = versioned.read("raw.t")
    upsert(versioned, frame(spark, [("a", 10), ("c", 3)]))
    assert rows(before) == [("a", 1), ("b", 2)]
    assert rows(versioned.read("raw.t")) == [("a", 10), ("b", 2), ("c", 3)]


def test_untouched_partitions_are_not_written(spark, versioned):
    versioned.create_table("raw.t", KV, bucket_key="k")
    versioned.insert(frame(spark, [(f"k{i}", i) for i in range(40)]), "raw.t")
    first = set(versioned._stored("raw.t").inputFiles())
    upsert(versioned, frame(spark, [("k1", 7)]))
    assert rows(versioned.read("raw.t").where("k = 'k1'")) == [("k1", 7)] and versioned.read("raw.t").count() == 40
    touched = versioned._touched(frame(spark, [("k1", 7)]), "k", 4)
    assert len(touched) == 1
    current = versioned._of_buckets("raw.t", [b for b in range(4) if b not in touched]).inputFiles()
    assert current and set(current) <= first
    only = versioned.rows_of("raw.t", frame(spark, [("k1",)], "k string")).inputFiles()
    assert only and all(f"{BUCKET}={touched[0]}/" in f for f in only if "/wh/raw/" in f)


def test_generations_are_folded_and_removed(spark, versioned):
    versioned.create_table("raw.t", KV, ["k"], {"v": "5"}, bucket_key="k")
    for i in range(7):
        versioned.insert(frame(spark, [(f"k{i}",)], "k string"), "raw.t")
        assert len(versioned._listed("raw.t")) <= 3
    assert rows(versioned.read("raw.t")) == [(f"k{i}", 5) for i in range(7)]
    with pytest.raises(ValueError):
        versioned.insert(frame(spark, [("k1", 1)]), "raw.t")
    assert versioned.remove_replaced("raw.t") > 0 and versioned.remove_replaced("raw.t") == 0
    assert rows(versioned.read("raw.t")) == [(f"k{i}", 5) for i in range(7)]


def test_updates_to_nothing_lengths_and_empty_inserts(spark, versioned):
    versioned.create_table("raw.t", {"k": "VARCHAR(3)", "v": "INT"}, bucket_key="k")
    with pytest.raises(guards.NoRows):
        versioned.insert(frame(spark, []), "raw.t")
    versioned.insert(frame(spark, [("a", 1), (None, 2)]), "raw.t")
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        versioned.insert(frame(spark, [("long", 1)]), "raw.t")
    with pytest.raises(KeyError):
        versioned.insert(frame(spark, [(1,)], "x int"), "raw.t")
    assert versioned.update("raw.t", {"v": 9}, {"k": "none"})["rows_updated"] == 0
    assert rows(versioned.read("raw.t")) == [("a", 1), (None, 2)]
    assert Generation.of(Generation("t__1", (0, 5, 4095), False).text()) == Generation("t__1", (0, 5, 4095), False)


def test_fixed_tables(versioned):
    versioned.create_fixed()
    for table in schemas.FIXED_TABLES:
        assert versioned.read(table.name).columns == list(table.columns)
    assert versioned._properties(schemas.FACT_STATS.name)["primary_key"] == "id"


def test_a_merge_into_an_empty_table_writes_its_rows_once(spark, versioned, monkeypatch):
    """The source is written already: it is not copied, nor joined with nothing."""
    versioned.create_table("raw.t", {"k": "STRING", "v": "INT"})
    source = frame(spark, [("a", 1), ("b", 2), (None, 3)])
    with monkeypatch.context() as patch:
        patch.setattr("matchmill.sources.versions.cut_lineage", None)
        patch.setattr("matchmill.sources.versions.merge.matched_rows", None)
        assert upsert(versioned, source)["rows_affected"] == 3
    assert rows(versioned.read("raw.t").select("k", "v")) == rows(source)
    assert upsert(versioned, frame(spark, [("a", 5), ("c", 6)]))["rows_affected"] == 2
