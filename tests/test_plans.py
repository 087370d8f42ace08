"""What the plans must look like to hold at scale."""

import contextlib
import io
import pathlib
import re

import pytest
from matchmill.operators import joins, merge, transforms
from matchmill.plans import kpi as K
from matchmill.plans import star_views as V
from matchmill.plans import workloads as W
from matchmill.plans.queries import REGISTRY
from matchmill.plans.queries.kpis import champion_input
from pyspark.sql import functions as F
from tests.conftest import SF_DIR

PACKAGE = pathlib.Path(__file__).parent.parent / "matchmill"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    """The plan with untruncated scan details."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def run_plan(df) -> str:
    """The plan after adaptive execution, of a query that really computes all columns."""
    total = df.agg(F.bit_xor(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])).alias("x"))
    total.collect()
    return plan(total).split("Initial Plan")[0]


def test_no_row_loops_or_python_functions():
    source = {p: p.read_text() for p in PACKAGE.rglob("*.py")}
    for path, text in source.items():
        assert not re.search(r"toPandas|\.rdd\b|mapPartitions|crossJoin|localCheckpoint|@F\.udf|pandas_udf", text), path



def test_filters_and_columns_reach_the_scan(spark):
    text = formatted(REGISTRY["d11"].run(spark, SF_DIR))
    assert "GreaterThanOrEqual(s_acctbal,0.0)" in text and "EqualTo(s_name,Supplier#000000003)" in text
    text = plan(REGISTRY["extract_where_order_limit"].run(spark, SF_DIR))
    assert "TakeOrderedAndProject" in text and "EqualTo(o_orderstatus,F)" in text
    text = plan(REGISTRY["d06"].run(spark, SF_DIR))
    assert "l_discount" not in text and "avg(" not in text  # only total_games is computed


def test_kpi_aggregates_before_its_one_shuffle(spark, tmp_path):
    path = str(tmp_path / "stats")
    champion_input(spark, SF_DIR).write.parquet(path)
    text = plan(K.kpi(spark.read.parquet(path), K.CHAMPION))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_avg" in text
    assert "PushedFilters: [IsNotNull(game_duration), GreaterThan(game_duration,120)]" in text
    states = K.kpi_states(spark.read.parquet(path).withColumn("game_name", F.lit("n")), K.PLAYER + K.CHAMPION)
    text = run_plan(K.kpi_grouping_sets(states, [K.PLAYER, K.PLAYER + K.CHAMPION]))
    assert "ReusedExchange" in text and text.count("FileScan") == 1


def test_dedupe_cuts_groups_before_the_shuffle(spark):
    lines = V.table(spark, SF_DIR, "lineitem")
    text = plan(transforms.dedupe_first(lines, ["l_orderkey", "l_linenumber"], V.FIRST_ORDER))
    assert re.search(r"WindowGroupLimit .*Final.*Exchange hashpartitioning.*WindowGroupLimit .*Partial", text, re.S)


def test_sample_join_broadcasts_only_the_sample(spark):
    text = plan(W.self_join_sample(V.table(spark, SF_DIR, "orders").select("o_orderkey"), "o_orderkey"))
    assert "TakeOrderedAndProject(limit=1000" in text and "BroadcastHashJoin" in text


def test_a_sampled_key_finds_each_row_once(spark):
    rows = spark.range(5000).select(F.lit(1).alias("k"), "id")
    assert W.self_join_sample(rows, "k").count() == 5000


def test_joins_without_an_equality_are_refused(spark):
    from matchmill.operators.extract import Join, extract

    t = spark.range(3).withColumnRenamed("id", "k")
    for on in ("t_main.k < r.k", "t_main.k <> r.k", "true"):
        with pytest.raises(ValueError):
            extract(t, ["t_main.k"], joins=[Join(t, on, "r")])
    assert extract(t, ["t_main.k"], joins=[Join(t, "t_main.k = r.k AND r.k >= 1", "r")]).count() == 2


@pytest.fixture
def hot(spark, tmp_path, settings):
    """Two tables in which one key holds a third of the rows, and settings that call that skew."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__forceOptimizeSkewedJoin="true",
    )
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))
    tables = {}
    for name, step in (("left", 1), ("right", 2)):
        path = str(tmp_path / name)
        spark.range(0, 200000, step, 8).select(key.alias("k"), F.xxhash64("id").alias("v")).write.parquet(path)
        tables[name] = spark.read.parquet(path)
    path = str(tmp_path / "unique")
    spark.range(0, 200000, 2, 8).select(F.col("id").alias("k"), F.col("id").alias("v")).write.parquet(path)
    return tables | {"unique": spark.read.parquet(path)}


def test_joins_split_a_hot_key(hot):
    left, right, unique = hot["left"], hot["right"], hot["unique"]
    assert "skew=true" in run_plan(left.join(unique.withColumnRenamed("v", "w"), "k"))
    assert "skew=true" in run_plan(joins.semi_join(left, right, ["k"]))
    assert "skew=true" in run_plan(joins.anti_join(left, right, ["k"]))
    assert "skew=true" in run_plan(joins.lookup(left, unique.withColumnRenamed("v", "w"), on=["k"]))


def test_merges_and_updates_split_a_hot_key(hot):
    left, unique = hot["left"], hot["unique"]
    now = F.current_timestamp()
    assert "skew=true" in run_plan(merge.matched_rows(left, unique, ["k"], ["v"], now))
    assert "skew=true" in run_plan(merge.unmatched_source(unique, left, ["k"]))
    assert "skew=true" in run_plan(merge.update_where_in(left, {"v": 0}, "k", hot["right"]))


def test_full_join_splits_a_hot_key_and_keeps_all_rows(spark, hot):
    from matchmill.operators.extract import Join, extract

    left, right = hot["left"], hot["unique"].where("k > 1000")
    full = extract(left, ["t_main.k", "t_main.v", "r.v AS w"], joins=[Join(right, [("k", "k")], "r", "FULL")])
    assert "skew=true" in run_plan(full)
    want = left.join(right.select("k", F.col("v").alias("w")), "k", "full_outer").count()
    assert full.count() == want


def test_workload_with_cache(spark):
    orders = V.table(spark, SF_DIR, "orders")
    done = W.memory_workload(orders, "o_orderkey")
    assert done == {"count": orders.count(), "aggregated": orders.count(), "joined": 1000}


def test_thirty_math_columns_in_one_projection(spark):
    rows = W.math_columns(V.table(spark, SF_DIR, "orders").select("o_orderkey"), "o_orderkey", 30)
    assert len(rows.columns) == 31 and plan(rows).count("Project") == 1
    wide = W.wide_aggregate(rows, rows.columns[1:])
    assert len(wide.columns) == 150


def test_partitioned_writes_can_be_split(spark):
    from matchmill.sources.warehouse import BUCKET, _few_files

    text = plan(_few_files(spark.range(10).withColumn(BUCKET, F.lit(1))))
    assert "REBALANCE_PARTITIONS_BY_COL" in text
