"""Merges, updates and writes over the star-schema tables.

A merge's target is the orders a first load would have seen, its source what a later load
brings: some orders again, with new values, and some new ones.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmill.functions import dates
from matchmill.operators import merge
from matchmill.plans import star_views as V
from matchmill.plans.queries.common import Query
from matchmill.session import scratch_path
from matchmill.sources.versions import VersionedWarehouse
from matchmill.sources.warehouse import Warehouse
from matchmill.streaming import drain

NOW = dt.datetime(2026, 1, 2, 3, 4, 5)
_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]


def first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.table(spark, sf_dir, "orders").where("o_orderstatus IN ('F', 'P')").select(*_COLUMNS)


def second_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending and open orders; a pending one's price is unknown when it was a high-priority one."""
    return (
        V.table(spark, sf_dir, "orders")
        .where("o_orderstatus IN ('P', 'O')")
        .selectExpr(
            "o_orderkey",
            "o_custkey",
            "'F' AS o_orderstatus",
            "CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE o_totalprice + 1000 END AS o_totalprice",
        )
    )


_FIRST = "first_load AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'P'))"
_SECOND = """second_load AS (SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus,
  CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE o_totalprice + 1000 END AS o_totalprice
  FROM orders WHERE o_orderstatus IN ('P', 'O'))"""
_UPDATED = """SELECT f.o_orderkey, f.o_custkey,
  CASE WHEN s.o_orderkey IS NULL THEN f.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
  CASE WHEN s.o_orderkey IS NULL THEN f.o_totalprice ELSE s.o_totalprice END AS o_totalprice
  FROM first_load f LEFT JOIN second_load s ON f.o_orderkey = s.o_orderkey"""
_INSERTED = """SELECT s.o_orderkey, s.o_custkey, {status} AS o_orderstatus, {price} AS o_totalprice FROM second_load s
  WHERE NOT EXISTS (SELECT 1 FROM first_load f WHERE f.o_orderkey = s.o_orderkey)"""


def _sql(body: str) -> str:
    return f"WITH {_FIRST}, {_SECOND} {body}"


_ALL = {c: c for c in _COLUMNS}


def _merge(**options):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return merge.merge_into(
            first_load(spark, sf_dir),
            second_load(spark, sf_dir),
            ["o_orderkey"],
            now=dates.utc_timestamp(NOW),
            **options,
        )

    return run


def _stats_by_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Participant rows are inserted per match: a match the target knows gets no new rows."""
    lines = V.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    known = lines.where("l_linenumber = 1")
    new = merge.unmatched_source(known, lines, ["l_orderkey"])
    return known.unionByName(merge.inserted_rows(known, new, {c: c for c in lines.columns}, F.lit(None)))


def _first_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = V.table(spark, sf_dir, "orders")
    richest = V.table(spark, sf_dir, "customer").orderBy(F.col("c_acctbal").desc(), "c_custkey").select("c_custkey")
    return merge.update_where(orders, {"o_orderpriority": "0-VIP"}, {"o_custkey": richest}).drop("_updated")


def _update_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = (
        V.table(spark, sf_dir, "lineitem").where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("o_orderkey"))
    )
    orders = V.table(spark, sf_dir, "orders")
    return merge.update_where_in(orders, {"o_orderstatus": "S", "o_orderpriority": "NULL"}, "o_orderkey", shipped).drop(
        "_updated"
    )


def _insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = V.table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")
    seen = V.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return known.unionByName(merge.insert_ignore(known, seen, ["c_custkey"]))


# ---- writes ----


def scratch_warehouse(spark: SparkSession, name: str, buckets: int = 8, kind: type[Warehouse] = Warehouse) -> Warehouse:
    return kind(spark, scratch_path(spark, name), f"mm_{uuid.uuid4().hex[:12]}_", buckets)


_ORDER_TYPES = {"o_orderkey": "BIGINT", "o_custkey": "BIGINT", "o_orderstatus": "STRING", "o_totalprice": "DOUBLE"}


def _append_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads, which share orders, and two literal rows appended to a table with a default and no key."""
    warehouse = scratch_warehouse(spark, "append")
    warehouse.create_table("fact_datas.orders", _ORDER_TYPES, defaults={"o_orderstatus": "'N'"})
    warehouse.insert(first_load(spark, sf_dir), "fact_datas.orders")
    warehouse.insert(second_load(spark, sf_dir).drop("o_orderstatus"), "fact_datas.orders")
    warehouse.insert_lines(
        "fact_datas.orders",
        [{"o_orderkey": -1, "o_custkey": 7}, {"o_orderkey": -2, "o_totalprice": 9.5}],
    )
    return warehouse.read("fact_datas.orders")


def _replace_table(kind: type[Warehouse] = Warehouse):
    """Other rows and columns in a table's place."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        warehouse = scratch_warehouse(spark, "replace", kind=kind)
        warehouse.insert(V.table(spark, sf_dir, "customer"), "raw_datas.rows", "fail")
        warehouse.insert(V.table(spark, sf_dir, "supplier"), "raw_datas.rows", "replace", "job", NOW)
        return warehouse.read("raw_datas.rows")

    return run


def _merged_table(bucket_key: str | None, kind: type[Warehouse] = Warehouse):
    """The same upsert on a stored table, by partition or whole."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        warehouse = scratch_warehouse(spark, "merge", kind=kind)
        warehouse.create_table("fact_datas.orders", _ORDER_TYPES, ["o_orderkey"], bucket_key=bucket_key)
        warehouse.insert(first_load(spark, sf_dir), "fact_datas.orders")
        warehouse.insert(second_load(spark, sf_dir), "raw_datas.orders", "replace")
        types = dict(_ORDER_TYPES, tech_date_creation="TIMESTAMP_NTZ", tech_date_modification="TIMESTAMP_NTZ")
        warehouse.create_table("mart_datas.orders", types, ["o_orderkey"], bucket_key=bucket_key)
        warehouse.insert(warehouse.read("fact_datas.orders"), "mart_datas.orders")
        warehouse.merge(
            warehouse.read("raw_datas.orders"),
            "mart_datas.orders",
            ["o_orderkey"],
            match_columns=["o_orderstatus", "o_totalprice"],
            non_match_columns=_ALL,
            has_matched=True,
            has_not_matched=True,
            now=NOW,
        )
        return warehouse.read("mart_datas.orders").select(*_COLUMNS)

    return run


def _updated_table(kind: type[Warehouse] = Warehouse):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        warehouse = scratch_warehouse(spark, "update", kind=kind)
        warehouse.create_table("fact_datas.orders", _ORDER_TYPES, ["o_orderkey"], bucket_key="o_orderkey")
        warehouse.insert(first_load(spark, sf_dir), "fact_datas.orders")
        warehouse.update("fact_datas.orders", {"o_totalprice": 0.0}, {"o_orderstatus": "P", "o_custkey": 7})
        late = V.table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").selectExpr("l_orderkey AS o_orderkey")
        warehouse.update_in("fact_datas.orders", {"o_orderstatus": "R"}, "o_orderkey", late)
        return warehouse.read("fact_datas.orders")

    return run


def _stream_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order files drained as a stream into a merged table; the second run finds nothing new."""
    warehouse = scratch_warehouse(spark, "drain")
    warehouse.create_table("fact_datas.orders", _ORDER_TYPES, ["o_orderkey"], bucket_key="o_orderkey")
    warehouse.insert(first_load(spark, sf_dir), "fact_datas.orders")
    schema = V.table(spark, sf_dir, "orders").schema

    def apply(batch: DataFrame, batch_id: int) -> None:
        later = batch.where("o_orderstatus IN ('P', 'O')").selectExpr(
            "o_orderkey", "o_custkey", "'F' AS o_orderstatus", "o_totalprice + 1000 AS o_totalprice"
        )
        warehouse.insert(later, "raw_datas.orders", "replace")
        warehouse.merge(
            warehouse.read("raw_datas.orders"),
            "fact_datas.orders",
            ["o_orderkey"],
            match_columns=["o_orderstatus", "o_totalprice"],
            has_matched=True,
            now=NOW,
        )

    checkpoint = scratch_path(spark, "drain-checkpoint")
    for _ in range(2):
        stream = drain.landed_stream(spark, sf_dir, schema, "parquet", pattern="orders.parquet")
        drain.drain(stream, apply, checkpoint).awaitTermination()
    return warehouse.read("fact_datas.orders")


QUERIES: dict[str, Query] = {
    "merge_update_only": Query(
        _merge(match_columns=["o_orderstatus", "o_totalprice"], has_matched=True), _sql(_UPDATED)
    ),
    "merge_insert_only": Query(
        _merge(non_match_columns={"o_orderkey": "o_orderkey", "o_custkey": "o_custkey"}, has_not_matched=True),
        _sql(f"SELECT * FROM first_load UNION ALL {_INSERTED.format(status='NULL', price='NULL')}"),
    ),
    "merge_upsert": Query(
        _merge(
            match_columns=["o_orderstatus", "o_totalprice"],
            non_match_columns=_ALL,
            has_matched=True,
            has_not_matched=True,
        ),
        _sql(f"{_UPDATED} UNION ALL {_INSERTED.format(status='s.o_orderstatus', price='s.o_totalprice')}"),
    ),
    "merge_rows_per_match": Query(
        _stats_by_match,
        "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_linenumber = 1 OR NOT EXISTS"
        " (SELECT 1 FROM lineitem k WHERE k.l_orderkey = lineitem.l_orderkey AND k.l_linenumber = 1)",
    ),
    "update_where": Query(
        lambda spark, sf_dir: merge.update_where(
            V.table(spark, sf_dir, "orders"),
            {"o_totalprice": 0.0, "o_orderpriority": "NULL"},
            {"o_orderstatus": "P", "o_orderpriority": "5-LOW"},
        ).drop("_updated"),
        "SELECT o_orderkey, o_custkey, o_orderstatus,"
        " CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 0.0 ELSE o_totalprice END AS o_totalprice,"
        " o_orderdate, CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END"
        " AS o_orderpriority FROM orders",
    ),
    "update_where_in": Query(
        _update_in,
        "SELECT o_orderkey, o_custkey, CASE WHEN hit THEN 'S' ELSE o_orderstatus END AS o_orderstatus, o_totalprice,"
        " o_orderdate, CASE WHEN hit THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM"
        " (SELECT *, o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F') AS hit FROM orders)",
    ),
    "update_where_scalar": Query(
        _first_customer,
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, CASE WHEN o_custkey ="
        " (SELECT c_custkey FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 1) THEN '0-VIP'"
        " ELSE o_orderpriority END AS o_orderpriority FROM orders",
    ),
    "insert_ignore": Query(
        _insert_ignore,
        "SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' UNION SELECT o_custkey FROM orders",
    ),
    "append_rows": Query(
        _append_rows,
        _sql(
            "SELECT * FROM first_load UNION ALL SELECT o_orderkey, o_custkey, 'N', o_totalprice FROM second_load"
            " UNION ALL SELECT -1, 7, 'N', NULL UNION ALL SELECT -2, NULL, 'N', 9.5"
        ),
    ),
    "replace_table": Query(
        _replace_table(),
        "SELECT *, 'job' AS tech_dag_id, '2026-01-02 04:04:05' AS tech_execution_date FROM supplier",
    ),
    "merged_table": Query(
        _merged_table(None),
        _sql(f"{_UPDATED} UNION ALL {_INSERTED.format(status='s.o_orderstatus', price='s.o_totalprice')}"),
    ),
    "merged_partitions": Query(
        _merged_table("o_orderkey"),
        _sql(f"{_UPDATED} UNION ALL {_INSERTED.format(status='s.o_orderstatus', price='s.o_totalprice')}"),
    ),
    "updated_table": Query(
        _updated_table(),
        f"WITH {_FIRST} SELECT o_orderkey, o_custkey,"
        " CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') THEN 'R' ELSE o_orderstatus END"
        " AS o_orderstatus, CASE WHEN o_orderstatus = 'P' AND o_custkey = 7 THEN 0.0 ELSE o_totalprice END AS o_totalprice"
        " FROM first_load",
    ),
    "stream_drain": Query(
        _stream_drain,
        "SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus,"
        " CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1000 ELSE o_totalprice END AS o_totalprice"
        " FROM orders WHERE o_orderstatus IN ('F', 'P')",
    ),
}

#: The same changes on tables that change by one statement.
for _name, _make in {
    "replace_table": _replace_table(VersionedWarehouse),
    "merged_table": _merged_table(None, VersionedWarehouse),
    "merged_partitions": _merged_table("o_orderkey", VersionedWarehouse),
    "updated_table": _updated_table(VersionedWarehouse),
}.items():
    QUERIES[f"versioned_{_name}"] = Query(_make, QUERIES[_name].sql)
