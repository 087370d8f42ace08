"""Engine workloads over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmill.operators.ranking import numbered_in_groups
from matchmill.plans import star_views as V
from matchmill.plans import workloads as W
from matchmill.functions.keyed import keyed_normal, keyed_uniform, keyed_whole
from matchmill.plans.queries.common import Query, rounded, rounded_sql

MATH_COLUMNS = 20


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.table(spark, sf_dir, "lineitem")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.table(spark, sf_dir, "orders")


def _math_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.math_columns(_orders(spark, sf_dir).select(F.col("o_orderkey").alias("id")), "id", MATH_COLUMNS)


def _defined(df: DataFrame) -> DataFrame:
    """NaN, which the SQL does not know, as NULL."""
    return df.select([F.nanvl(f.name, F.lit(None).cast("double")).alias(f.name) if f.dataType.simpleString() == "double" else f.name for f in df.schema])


def _math(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_defined(_math_rows(spark, sf_dir)))


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _defined(_math_rows(spark, sf_dir))
    return rounded(W.wide_aggregate(rows, [c for c in rows.columns if c != "id"]), 4)


def _math_sql() -> dict[str, str]:
    """Every math column over ``id`` as SQL; five of a kind."""
    formulas = {
        "trig": "sin(id / 1000.0) * cos(id / 1000.0) * tan(id / 10000.0)",
        "exp": "exp(id / 1000000.0) + ln(id + 1)",
        "power": "pow(id, 0.5) + sqrt(id + 1)",
        "complex": "CASE WHEN sin(id / 1000.0) >= 0 THEN sqrt(abs(sin(id / 1000.0))) + ln(cos(id / 1000.0) + 2) END",
    }
    return {f"{kind}_{5 * i + step}": formula for i, (kind, formula) in enumerate(formulas.items()) for step in range(5)}


def _wide_sql() -> str:
    kinds = {"sum": "sum", "avg": "avg", "max": "max", "min": "min", "stddev": "stddev_samp"}
    shown = ", ".join(f"{rounded_sql(f'{f}({e})', 4)} AS {kind}_{name}" for name, e in _math_sql().items() for kind, f in kinds.items())
    return f"SELECT {shown} FROM (SELECT o_orderkey AS id FROM orders)"


def _numbered(rank: str | None, keep: str):
    """Line items in a hundred buckets by order key; numbers need a full order, ranks show the ties."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = _lineitem(spark, sf_dir).select(
            (F.col("l_orderkey") % W.WINDOW_BUCKETS).alias("bucket"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
        )
        order = ["l_orderkey"] if rank else ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
        numbered = numbered_in_groups(rows, ["bucket"], order, "row_number", rank)
        return numbered.select("bucket", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", keep)

    return run


_BUCKETED = (
    "SELECT l_orderkey % 100 AS bucket, l_orderkey, l_linenumber, l_partkey, l_suppkey,"
    " {f}() OVER (PARTITION BY l_orderkey % 100 ORDER BY {o}) AS {f} FROM lineitem"
)


def _random(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = W.memory_columns(_orders(spark, sf_dir).select(F.col("o_orderkey").alias("id")), "id")
    return rows.select("id", "text_col", F.col("hash_col").isNotNull().alias("hashed"), F.round("data4", 6).alias("root"),
                       ((F.col("data1") >= 0) & (F.col("data1") < 1) & (F.col("data2") < 1000)).alias("in_range"))


def _memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The memory workload over all orders: a cached table counted, aggregated and joined with its sample."""
    done = W.memory_workload(_orders(spark, sf_dir).select(F.col("o_orderkey").alias("id")), "id")
    return spark.range(1).select(*[F.lit(n).cast("bigint").alias(name) for name, n in done.items()])


def _keyed_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random columns of every order, the same however the orders are partitioned."""
    return rounded(V.table(spark, sf_dir, "orders").repartition(13, "o_custkey").select(
        "o_orderkey",
        keyed_uniform(42, "o_orderkey").alias("data1"),
        (keyed_uniform(43, "o_orderkey") * 1000).alias("data2"),
        keyed_normal(42, "o_orderkey").alias("normal"),
        keyed_whole(42, 1, 6, "o_orderkey").alias("whole"),
    ))


def _keyed_sql() -> str:
    """The same by arithmetic: XXH64 of one whole number, from what the hash of seed and stream leaves."""
    # The primes of XXH64.
    p1, p2, p3 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
    p4, p5 = 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
    whole = 1 << 64

    def turn(v: int, by: int) -> int:
        return (v << by | v >> 64 - by) % whole

    def xxh64(value: int, seed: int) -> int:
        h = turn((seed + p5 + 8) % whole ^ turn(value * p2 % whole, 31) * p1 % whole, 27) * p1 + p4
        h %= whole
        h = (h ^ h >> 33) * p2 % whole
        h = (h ^ h >> 29) * p3 % whole
        return h ^ h >> 32

    def wide(v: str) -> str:
        return f"CAST({v} AS UHUGEINT)"

    def narrow(v: str) -> str:
        return f"CAST(({v}) % {wide(str(whole))} AS UBIGINT)"

    def turned(v: str, by: int) -> str:
        return narrow(f"{wide(v)} * {1 << by} + {wide(v)} // {1 << 64 - by}")

    starts = {n: (xxh64(stream, xxh64(seed, 42)) + p5 + 8) % whole for n, seed, stream in (("a", 42, 0), ("b", 43, 0), ("c", 42, 1_000_001), ("d", 42, 1_000_002))}
    times = lambda v, prime: narrow(f"{wide(v)} * {wide(str(prime))}")
    listed = ", ".join(f"('{n}', CAST({s} AS UBIGINT))" for n, s in starts.items())
    return f"""WITH starts(name, start) AS (VALUES {listed}),
    s1 AS (SELECT o_orderkey, name, start, {times("o_orderkey", p2)} AS k FROM orders, starts),
    s2 AS (SELECT o_orderkey, name, start, {turned("k", 31)} AS k FROM s1),
    s3 AS (SELECT o_orderkey, name, xor(start, {times("k", p1)}) AS h FROM s2),
    s4 AS (SELECT o_orderkey, name, {turned("h", 27)} AS h FROM s3),
    s5 AS (SELECT o_orderkey, name, {narrow(f"{wide('h')} * {wide(str(p1))} + {wide(str(p4))}")} AS h FROM s4),
    s6 AS (SELECT o_orderkey, name, xor(h, h >> 33) AS h FROM s5),
    s7 AS (SELECT o_orderkey, name, {times("h", p2)} AS h FROM s6),
    s8 AS (SELECT o_orderkey, name, xor(h, h >> 29) AS h FROM s7),
    s9 AS (SELECT o_orderkey, name, {times("h", p3)} AS h FROM s8),
    u AS (SELECT o_orderkey, name, CAST(xor(h, h >> 32) >> 11 AS DOUBLE) / {float(1 << 53)!r} AS u FROM s9),
    one AS (SELECT o_orderkey, max(u) FILTER (WHERE name = 'a') AS a, max(u) FILTER (WHERE name = 'b') AS b,
            max(u) FILTER (WHERE name = 'c') AS c, max(u) FILTER (WHERE name = 'd') AS d FROM u GROUP BY o_orderkey)
    SELECT o_orderkey, {rounded_sql("a")} AS data1, {rounded_sql("b * 1000")} AS data2,
      {rounded_sql("sqrt(-2 * ln(1 - c)) * cos(2 * pi() * d)")} AS normal, CAST(1 + floor(a * 6) AS BIGINT) AS whole FROM one"""


QUERIES: dict[str, Query] = {
    "memory_workload": Query(
        _memory,
        """SELECT count(*) AS "count", count(*) AS aggregated,
           count(*) FILTER (WHERE o_orderkey IN (SELECT DISTINCT o_orderkey FROM orders ORDER BY 1 LIMIT 1000)) AS joined FROM orders""",
    ),
    "global_agg": Query(
        lambda spark, sf_dir: rounded(
            W.global_aggregate(_lineitem(spark, sf_dir), "l_quantity", "l_discount", "l_extendedprice", "l_tax")
        ),
        f"SELECT sum(l_quantity) AS sum_l_quantity, {rounded_sql('avg(l_discount)')} AS avg_l_discount,"
        " max(l_extendedprice) AS max_l_extendedprice, min(l_tax) AS min_l_tax, count(*) AS total_count FROM lineitem",
    ),
    "wide_agg_stddev": Query(_wide, _wide_sql()),
    "math_columns": Query(
        _math,
        f"SELECT id, {', '.join(f'{rounded_sql(e)} AS {name}' for name, e in _math_sql().items())} FROM (SELECT o_orderkey AS id FROM orders)",
    ),
    "bucket_row_number": Query(
        _numbered(None, "row_number"),
        _BUCKETED.format(f="row_number", o="l_orderkey, l_linenumber, l_partkey, l_suppkey"),
    ),
    "bucket_rank": Query(_numbered("rank", "rank"), _BUCKETED.format(f="rank", o="l_orderkey")),
    "self_join_sample": Query(
        lambda spark, sf_dir: W.self_join_sample(_orders(spark, sf_dir).select("o_orderkey", "o_totalprice"), "o_orderkey"),
        "SELECT o_orderkey, o_totalprice, join_id FROM orders JOIN"
        " (SELECT DISTINCT o_orderkey AS join_id FROM orders ORDER BY 1 LIMIT 1000) ON o_orderkey = join_id",
    ),
    "keyed_random": Query(_keyed_random, _keyed_sql()),
    "hash_and_rand": Query(
        _random,
        "SELECT o_orderkey AS id, concat('row_', CAST(o_orderkey AS VARCHAR)) AS text_col, true AS hashed,"
        " round(sqrt(o_orderkey), 6) AS root, true AS in_range FROM orders",
    ),
}
