"""Extracts, joins, table steps, scalar functions and guards over the star-schema tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmill.functions import dates
from matchmill.functions import scalars as S
from matchmill.operators import guards, joins, nested, transforms
from matchmill.operators.extract import Between, Join, extract
from matchmill.plans import star_views as V
from matchmill.plans.queries import common as C
from matchmill.plans.queries.common import Query
from matchmill.session import cut_lineage, scratch_path
from matchmill.sources import landing

JOB_ID = "nightly_orders"
JOB_TIME = dt.datetime(2026, 7, 1, 23, 30)  # UTC; the next day in Paris
TODAY = dt.date(1997, 8, 15)
YEARS = [1995, 1997]


def on(make, *names: str):
    """A query function that calls ``make`` with the named tables."""
    return lambda spark, sf_dir: make(*[V.table(spark, sf_dir, n) for n in names])


# ---- extracts ----

EXTRACTS: dict[str, Query] = {
    "extract_where_order_limit": Query(
        on(
            lambda orders: extract(
                orders,
                ["o_orderkey", "o_custkey", "o_totalprice"],
                where={"o_orderstatus": "F", "o_orderpriority": "2-HIGH"},
                order=["o_totalprice DESC", "o_orderkey ASC"],
                limit=100,
            ),
            "orders",
        ),
        "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'"
        " ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey LIMIT 100",
    ),
    "extract_is_null": Query(
        lambda spark, sf_dir: extract(V.players(spark, sf_dir), where={"date_processed": "is null"}),
        C.with_views("SELECT * FROM fx_player WHERE date_processed IS NULL", C.FX_PLAYER),
    ),
    "extract_is_not_null": Query(
        lambda spark, sf_dir: extract(V.players(spark, sf_dir), where={"date_processed": "is not null"}),
        C.with_views("SELECT * FROM fx_player WHERE date_processed IS NOT NULL", C.FX_PLAYER),
    ),
    "extract_is_false": Query(
        lambda spark, sf_dir: extract(
            V.matches(spark, sf_dir),
            ["match_id"],
            where={"is_processed": "is false"},
            order=["tech_date_creation ASC", "match_id"],
            limit=100,
        ),
        C.with_views(
            "SELECT match_id FROM fx_match WHERE is_processed IS FALSE"
            " ORDER BY tech_date_creation ASC NULLS LAST, match_id LIMIT 100",
            C.FX_MATCH,
        ),
    ),
    "queue_oldest_first": Query(
        lambda spark, sf_dir: extract(
            V.players(spark, sf_dir), ["puuid", "date_processed"], order=["date_processed ASC", "puuid"], limit=10
        ),
        C.with_views(
            "SELECT puuid, date_processed FROM fx_player ORDER BY date_processed ASC NULLS LAST, puuid LIMIT 10",
            C.FX_PLAYER,
        ),
    ),
    "queue_nulls_first": Query(
        lambda spark, sf_dir: extract(
            V.players(spark, sf_dir), ["puuid", "date_processed"], order=["date_processed DESC", "puuid"], limit=10
        ),
        C.with_views(
            "SELECT puuid, date_processed FROM fx_player ORDER BY date_processed DESC NULLS FIRST, puuid LIMIT 10",
            C.FX_PLAYER,
        ),
    ),
    "extract_no_limit": Query(
        on(lambda nation: extract(nation, ["n_nationkey", "n_name"], order="n_name", limit=0), "nation"),
        "SELECT n_nationkey, n_name FROM nation",
    ),
    "extract_equals_null": Query(
        on(
            lambda orders: extract(orders, ["o_orderkey"], where={"o_orderstatus": None}).agg(
                F.count("o_orderkey").alias("n_found")
            ),
            "orders",
        ),
        "SELECT count(o_orderkey) AS n_found FROM orders WHERE o_orderstatus = NULL",
    ),
    "filter_strict_range": Query(
        lambda spark, sf_dir: V.matches(spark, sf_dir).where("game_duration > 120").select("match_id", "game_duration"),
        C.with_views("SELECT match_id, game_duration FROM fx_match WHERE game_duration > 120", C.FX_MATCH),
    ),
    "filter_in_list": Query(
        on(lambda orders: orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")), "orders"),
        "SELECT * FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
    ),
    "filter_valid_text": Query(
        on(
            lambda part: part.where(S.valid_text(F.split_part("p_name", F.lit(" "), F.lit(2)))).select("p_partkey"),
            "part",
        ),
        "SELECT p_partkey FROM part WHERE p_name IS NOT NULL AND split_part(p_name, ' ', 2) <> ''",
    ),
    "filter_date_years": Query(
        on(
            lambda orders: orders.where(
                F.year("o_orderdate").isin(YEARS) & (F.to_date("o_orderdate") <= F.lit(TODAY))
            ).select("o_orderkey", "o_orderdate"),
            "orders",
        ),
        "SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) IN (1995, 1997)"
        f" AND CAST(o_orderdate AS DATE) <= DATE '{TODAY}'",
    ),
}

def _bound_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values are bound as arguments, never pasted into the text."""
    V.table(spark, sf_dir, "orders").createOrReplaceTempView("mm_orders")
    text = (
        "SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total"
        " FROM mm_orders WHERE o_orderstatus = :status GROUP BY o_orderpriority"
    )
    return spark.sql(text, args={"status": "F"})


# ---- joins ----


def _join(kind: str, select: list[str], on_clause, left: str, right: str, alias: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        right_table = V.table(spark, sf_dir, right)
        return extract(
            V.table(spark, sf_dir, left), select, joins=[Join(right_table, on_clause, alias, kind)]
        )

    return run


def _pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.table(spark, sf_dir, "orders").where("o_orderstatus = 'P'")


def _full(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = V.table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'")
    return extract(
        _pending(spark, sf_dir),
        ["t_main.o_orderkey", "t_main.o_totalprice", "c.c_custkey", "c.c_name"],
        joins=[Join(customers, [("o_custkey", "c_custkey")], "c", "FULL")],
    )


def _multiway(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(
        V.stats(spark, sf_dir),
        ["t_main.id", "puuid.game_name", "match.game_duration", "t_main.kills"],
        joins=[
            Join(V.players(spark, sf_dir), "t_main.puuid = puuid.puuid", "puuid"),
            Join(V.matches(spark, sf_dir), "t_main.match_id = match.match_id", "match"),
        ],
    )


def _star_and_extras(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(
        V.table(spark, sf_dir, "supplier"),
        ["t_main.*", "n.n_name", "r.r_name"],
        joins=[
            Join(V.table(spark, sf_dir, "nation"), "t_main.s_nationkey = n.n_nationkey", "n"),
            Join(V.table(spark, sf_dir, "region"), "n.n_regionkey = r.r_regionkey", "r"),
        ],
    )


def _between(kind: str):
    """Customers and the suppliers whose balance is theirs or a little less; no width, or one of many, for each supplier."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ranges = V.table(spark, sf_dir, "supplier").withColumn("top", F.expr("s_acctbal + s_nationkey * s_nationkey / 4.0D"))
        join = Join(ranges, Between("c_acctbal", "s_acctbal", "top"), "s", kind)
        return extract(V.table(spark, sf_dir, "customer"), ["t_main.c_custkey", "s.s_suppkey"], joins=[join])

    return run


JOINS: dict[str, Query] = {
    "join_inner": Query(
        _join(
            "INNER", ["t_main.o_orderkey", "c.c_name", "c.c_mktsegment"], [("o_custkey", "c_custkey")], "orders", "customer", "c"
        ),
        "SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey",
    ),
    "join_left": Query(
        lambda spark, sf_dir: extract(
            V.table(spark, sf_dir, "customer"),
            ["t_main.c_custkey", "o.o_orderkey"],
            joins=[Join(_pending(spark, sf_dir), "t_main.c_custkey = o.o_custkey", "o", "LEFT")],
        ),
        "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') o"
        " ON c_custkey = o_custkey",
    ),
    "join_right": Query(
        lambda spark, sf_dir: extract(
            _pending(spark, sf_dir),
            ["t_main.o_orderkey", "c.c_custkey"],
            joins=[Join(V.table(spark, sf_dir, "customer"), "t_main.o_custkey = c.c_custkey", "c", "RIGHT")],
        ),
        "SELECT o_orderkey, c_custkey FROM (SELECT * FROM orders WHERE o_orderstatus = 'P') o RIGHT JOIN customer"
        " ON o_custkey = c_custkey",
    ),
    "join_full": Query(
        _full,
        "SELECT o_orderkey, o_totalprice, c_custkey, c_name FROM"
        " (SELECT * FROM orders WHERE o_orderstatus = 'P') o"
        " FULL JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') c ON o_custkey = c_custkey",
    ),
    "join_full_text": Query(
        lambda spark, sf_dir: extract(
            _pending(spark, sf_dir),
            ["t_main.o_orderkey", "t_main.o_totalprice", "c.c_custkey", "c.c_name"],
            joins=[Join(V.table(spark, sf_dir, "customer"), "c.c_custkey = t_main.o_custkey", "c", "FULL")],
        ),
        "SELECT o_orderkey, o_totalprice, c_custkey, c_name FROM (SELECT * FROM orders WHERE o_orderstatus = 'P') o"
        " FULL JOIN customer c ON o_custkey = c_custkey",
    ),
    **{
        f"join_between{'' if kind == 'INNER' else '_left'}": Query(
            _between(kind),
            f"SELECT c_custkey, s_suppkey FROM customer {kind} JOIN supplier"
            " ON c_acctbal BETWEEN s_acctbal AND s_acctbal + s_nationkey * s_nationkey / 4.0",
        )
        for kind in ("INNER", "LEFT")
    },
    "join_theta": Query(
        _join(
            "INNER",
            ["t_main.l_orderkey", "t_main.l_linenumber", "t_main.l_shipdate", "o.o_orderdate"],
            "t_main.l_orderkey = o.o_orderkey AND t_main.l_shipdate < o.o_orderdate + INTERVAL 30 DAYS"
            " AND t_main.l_extendedprice * 4 > o.o_totalprice",
            "lineitem",
            "orders",
            "o",
        ),
        "SELECT l_orderkey, l_linenumber, l_shipdate, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
        " AND l_shipdate < o_orderdate + INTERVAL '30' DAY AND l_extendedprice * 4 > o_totalprice",
    ),
    "join_multiway": Query(
        _multiway,
        C.with_views(
            "SELECT s.id, p.game_name, m.game_duration, s.kills FROM fx_stats s JOIN fx_player p ON s.puuid = p.puuid"
            " JOIN fx_match m ON s.match_id = m.match_id",
            *C.STATS_VIEWS,
        ),
    ),
    "join_star_and_extras": Query(
        _star_and_extras,
        "SELECT s.*, n_name, r_name FROM supplier s JOIN nation ON s_nationkey = n_nationkey"
        " JOIN region ON n_regionkey = r_regionkey",
    ),
    "join_semi": Query(
        on(
            lambda customer, orders: joins.semi_join(
                customer, orders.where("o_totalprice > 400000").withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"]
            ),
            "customer",
            "orders",
        ),
        "SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)",
    ),
    "join_anti": Query(
        on(
            lambda orders, lineitem: joins.anti_join(
                orders, lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"]
            ),
            "orders",
            "lineitem",
        ),
        "SELECT * FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
    ),
    "join_lookup": Query(
        on(
            lambda customer, nation, supplier: joins.lookup(
                customer.select("c_custkey", F.col("c_nationkey").alias("nationkey")),
                nation.select(F.col("n_nationkey").alias("nationkey"), "n_name"),
                cut_lineage(
                    supplier.groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("n_suppliers")),
                    "dimension",
                ),
                on=["nationkey"],
            ),
            "customer",
            "nation",
            "supplier",
        ),
        "SELECT c_custkey, c_nationkey AS nationkey, n_name, n_suppliers FROM customer"
        " LEFT JOIN nation ON c_nationkey = n_nationkey"
        " LEFT JOIN (SELECT s_nationkey, count(*) AS n_suppliers FROM supplier GROUP BY 1) ON c_nationkey = s_nationkey",
    ),
    "bound_arguments": Query(
        _bound_sql,
        "SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders"
        " WHERE o_orderstatus = 'F' GROUP BY 1",
    ),
}

# ---- table steps ----

_KEY_ORDER = ["l_partkey", "l_suppkey", "l_extendedprice"]
_STAT_ROW = (
    "id, match_id, puuid, champion_id, champion_name, kills, deaths, assists, total_heal, gold_earned,"
    " l_partkey, l_suppkey, l_extendedprice"
)


def _dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transforms.dedupe_first(V.raw_stats(spark, sf_dir), ["id"], _KEY_ORDER)
    return rows.selectExpr(*_STAT_ROW.split(", "))


def _before_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = V.table(spark, sf_dir, "lineitem")
    kept = transforms.dedupe_first(lines, ["l_orderkey", "l_linenumber"], _KEY_ORDER)
    return guards.before_after(lines, kept)


def _file_round_trip(file_format: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        orders = V.table(spark, sf_dir, "orders")
        path = scratch_path(spark, f"orders-{file_format}")
        if file_format == "json":
            orders.write.json(path)
            return landing.read_json(spark, path, orders.schema)
        orders.write.parquet(path)
        return landing.read_parquet(spark, path, orders.schema)

    return run


def _sundays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders placed on each Sunday of the chosen years, Sundays without orders included."""
    days = dates.sundays(spark, YEARS, TODAY)
    placed = V.table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n_orders")
    )
    return days.join(placed, "day", "left").select("day", F.coalesce("n_orders", F.lit(0)).alias("n_orders"))


STEPS: dict[str, Query] = {
    "keep_columns": Query(
        on(lambda orders: transforms.keep_columns(orders, ["o_custkey", "o_orderkey"]), "orders"),
        "SELECT o_custkey, o_orderkey FROM orders",
    ),
    "rename_columns": Query(
        on(
            lambda supplier: transforms.rename_columns(
                supplier, {"s_suppkey": "puuid", "s_name": "game_name", "absent": "ignored"}
            ),
            "supplier",
        ),
        "SELECT s_suppkey AS puuid, s_name AS game_name, s_nationkey, s_acctbal FROM supplier",
    ),
    "tech_info": Query(
        on(lambda supplier: transforms.tech_info(supplier, JOB_ID, JOB_TIME), "supplier"),
        f"SELECT *, '{JOB_ID}' AS tech_dag_id, strftime(TIMESTAMP '2026-07-02 01:30:00', '%Y-%m-%d %H:%M:%S')"
        " AS tech_execution_date FROM supplier",
    ),
    "tech_photo": Query(
        on(lambda supplier: transforms.tech_photo(supplier, dt.datetime(2027, 1, 1, 9, 0)), "supplier"),
        "SELECT *, strftime(DATE '2027-01-01', '%Y-%m-%d') AS tech_date_photo,"
        " CAST(isoyear(DATE '2027-01-01') AS INTEGER) AS tech_annee_photo,"
        " CAST(week(DATE '2027-01-01') AS INTEGER) AS tech_semaine_photo FROM supplier",
    ),
    "dedupe_first": Query(
        _dedupe,
        C.with_views(f"SELECT {_STAT_ROW} FROM fx_stats", C.FX_RAW_STATS, C.FX_STATS),
    ),
    "dedupe_subset": Query(
        on(lambda lineitem: transforms.dedupe_keys(lineitem, ["l_orderkey"]), "lineitem"),
        "SELECT DISTINCT l_orderkey FROM lineitem",
    ),
    "row_counts": Query(
        _before_after,
        "SELECT count(*) AS rows_before, count(DISTINCT (l_orderkey, l_linenumber)) AS rows_after,"
        " count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS rows_removed FROM lineitem",
    ),
    "key_duplicates": Query(
        on(lambda lineitem: guards.duplicate_keys(lineitem, ["l_orderkey", "l_linenumber"]), "lineitem"),
        "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    ),
    "union_sources": Query(
        on(
            lambda customer, supplier: transforms.union_sources(
                [
                    customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment")),
                    None,
                    supplier.select(F.col("s_acctbal").alias("acctbal"), F.col("s_name").alias("name")),
                ]
            ),
            "customer",
            "supplier",
        ),
        "SELECT c_name AS name, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer"
        " UNION ALL BY NAME SELECT s_acctbal AS acctbal, s_name AS name FROM supplier",
    ),
    "read_json": Query(_file_round_trip("json"), "SELECT * FROM orders"),
    "read_parquet": Query(_file_round_trip("parquet"), "SELECT * FROM orders"),
    "sundays": Query(
        _sundays,
        "SELECT CAST(d AS DATE) AS day, count(o_orderkey) AS n_orders"
        f" FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '{TODAY}', INTERVAL '1' DAY) g(d)"
        " LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(d AS DATE)"
        " WHERE dayofweek(d) = 0 AND year(d) IN (1995, 1997) GROUP BY 1",
    ),
    "distinct_values": Query(
        on(lambda orders: orders.select("o_orderpriority").distinct(), "orders"),
        "SELECT DISTINCT o_orderpriority FROM orders",
    ),
}

# ---- scalar functions ----


def _texts(part: DataFrame) -> DataFrame:
    words = F.split("p_name", " ")
    absent = F.when(F.col("p_size") % 3 == 0, words)
    return part.select(
        "p_partkey",
        S.row_id(F.col("p_brand"), F.col("p_type")).alias("brand_id"),
        F.concat(F.lit("row_"), F.col("p_partkey").cast("string")).alias("label"),
        S.joined_text(words).alias("words"),
        S.joined_text(absent).alias("words_or_empty"),
        S.default_to(F.when(F.col("p_size") > 25, F.col("p_type")), "").alias("type_or_empty"),
        nested.latest_version(words).alias("first_word"),
        F.get(words, F.lit(5)).alias("sixth_word"),
        F.size(words).cast("bigint").alias("n_words"),
        F.when(F.col("p_size") > 25, "large").otherwise("small").alias("size_class"),
        F.when(F.col("p_size") > 25, F.col("p_type")).isNull().alias("type_missing"),
    )


def _times(events: DataFrame) -> DataFrame:
    ms = S.to_epoch_ms(F.col("ts"))
    return events.select(
        "event_id",
        ms.alias("epoch_ms"),
        S.from_epoch_ms(ms).alias("back"),
        F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(dates.JOB_ZONE), F.col("ts")), "yyyy-MM-dd HH:mm:ss").alias(
            "paris"
        ),
        F.date_format("ts", "yyyy-MM-dd").alias("day_text"),
        F.to_date(F.to_timestamp_ntz(F.date_format("ts", "yyyy-MM-dd"), F.lit("yyyy-MM-dd"))).alias("day"),
        dates.iso_year(F.col("ts")).alias("iso_year"),
        dates.iso_week(F.col("ts")).alias("iso_week"),
    )


def _ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    kills, deaths, assists = F.col("kills"), F.col("deaths"), F.col("assists")
    exact = (kills + assists) / S.at_least(deaths, 1)
    return V.stats(spark, sf_dir).select(
        "id",
        F.round(exact, 6).alias("ratio"),
        S.stored_as_int(exact).alias("stored"),
        (F.abs(S.kda(kills, deaths, assists) - exact) <= 0.005 + 1e-9).alias("two_decimals"),
    )


SCALARS: dict[str, Query] = {
    "scalar_text": Query(
        on(_texts, "part"),
        """SELECT p_partkey, md5(concat(p_brand, '_', p_type)) AS brand_id, concat('row_', CAST(p_partkey AS VARCHAR)) AS label,
           array_to_string(string_split(p_name, ' '), ',') AS words,
           CASE WHEN p_size % 3 = 0 THEN array_to_string(string_split(p_name, ' '), ',') ELSE '' END AS words_or_empty,
           CASE WHEN p_size > 25 THEN p_type ELSE '' END AS type_or_empty,
           string_split(p_name, ' ')[1] AS first_word, string_split(p_name, ' ')[6] AS sixth_word,
           CAST(len(string_split(p_name, ' ')) AS BIGINT) AS n_words,
           CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END AS size_class,
           p_size <= 25 OR p_type IS NULL AS type_missing
           FROM part""",
    ),
    "scalar_time": Query(
        on(_times, "events"),
        """SELECT event_id, epoch_us(ts) // 1000 AS epoch_ms, date_trunc('millisecond', ts) AS back,
           strftime(CAST(CASE WHEN ts >= TIMESTAMP '2024-03-31 01:00:00' AND ts < TIMESTAMP '2024-10-27 01:00:00'
                THEN ts + INTERVAL '2' HOUR ELSE ts + INTERVAL '1' HOUR END AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS paris,
           strftime(ts, '%Y-%m-%d') AS day_text, CAST(ts AS DATE) AS day,
           CAST(isoyear(ts) AS INTEGER) AS iso_year, CAST(week(ts) AS INTEGER) AS iso_week
           FROM events""",
    ),
    "scalar_ratio": Query(
        _ratios,
        C.with_views(
            "SELECT id, round((kills + assists) / greatest(deaths, 1), 6) AS ratio,"
            " CAST(round_even((kills + assists) / greatest(deaths, 1), 0) AS INTEGER) AS stored,"
            " true AS two_decimals FROM fx_stats",
            C.FX_RAW_STATS,
            C.FX_STATS,
        ),
    ),
}

QUERIES: dict[str, Query] = {**EXTRACTS, **JOINS, **STEPS, **SCALARS}
