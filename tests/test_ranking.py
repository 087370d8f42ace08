"""Distributed numbering against plain windows."""

import pytest
from matchmill.operators.ranking import numbered_in_groups
from pyspark.sql import Window
from pyspark.sql import functions as F
from tests.conftest import rows


def skewed(spark, n=4000):
    """A third of the rows share one group and one key; some groups and keys are NULL."""
    g = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 5)
    k = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 11 == 0, None).otherwise((F.col("id") * 7919) % 200)
    return spark.range(n).select(g.cast("int").alias("g"), k.cast("int").alias("k"), "id")


@pytest.mark.parametrize("direction", ["", " desc"])
def test_equals_window(spark, tmp_path, direction):
    path = str(tmp_path / "t")
    skewed(spark).write.parquet(path)
    t = spark.read.parquet(path)
    key = F.col("k").desc() if direction else F.col("k").asc()
    by_key = Window.partitionBy("g").orderBy(key)
    total = Window.partitionBy("g").orderBy(key, "id")
    want = t.select("g", "k", "id", F.row_number().over(total).cast("long"), F.rank().over(by_key).cast("long"))
    numbered = numbered_in_groups(t, ["g"], [f"k{direction}", "id"]).select("id", "row_number")
    ranked = numbered_in_groups(t, ["g"], [f"k{direction}"], rank="rank")
    got = ranked.drop("row_number").join(numbered, "id").select("g", "k", "id", "row_number", "rank")
    assert rows(got) == rows(want)


def test_numbers_are_a_permutation_when_all_rows_tie(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select(F.lit(1).alias("g"), F.lit(2).alias("k"), "id").repartition(6).write.parquet(path)
    out = numbered_in_groups(spark.read.parquet(path), ["g"], ["k"], rank="rank")
    assert sorted(r["row_number"] for r in out.collect()) == list(range(1, 1001))
    assert {r["rank"] for r in out.collect()} == {1}


def test_a_hot_group_is_spread_over_tasks(spark, tmp_path):
    from matchmill.operators.ranking import _range_sorted

    path = str(tmp_path / "t")
    spark.range(200000).select(F.lit(1).alias("g"), F.lit(2).alias("k"), "id").repartition(8).write.parquet(path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = _range_sorted(spark.read.parquet(path), ["g"], ["k"])
        sizes = [r["count"] for r in placed.groupBy("_task").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 200000 / 3


def test_ranks_shuffle_whole_rows_once(spark, tmp_path):
    """The table is range-sorted and written; numbers and ranks are then taken from it without an exchange or a sort of its rows."""
    path = str(tmp_path / "t")
    skewed(spark).write.parquet(path)
    ranked = numbered_in_groups(spark.read.parquet(path), ["g"], ["k"], rank="rank")
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "Window" not in plan and "Exchange hashpartitioning" not in plan and "Sort " not in plan


@pytest.mark.parametrize("batch", [1, 7])
def test_ties_over_batches(spark, tmp_path, batch):
    path, name = str(tmp_path / "t"), "spark.sql.execution.arrow.maxRecordsPerBatch"
    skewed(spark, 600).write.parquet(path)
    t, before = spark.read.parquet(path), spark.conf.get(name)
    spark.conf.set(name, str(batch))
    try:
        got = numbered_in_groups(t, ["g"], ["k"], rank="rank").select("g", "k", "id", "rank").collect()
    finally:
        spark.conf.set(name, before)
    want = t.select("g", "k", "id", F.rank().over(Window.partitionBy("g").orderBy("k")).cast("long"))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, map(tuple, want.collect())))
