"""Match, player and statistics frames derived from the star-schema tables.

An order is a match, a supplier a player, a line item a participant, and the part key
modulo the number of champions the champion played. These give every operator whole,
growing tables to run on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmill import schemas
from matchmill.functions.scalars import to_epoch_ms
from matchmill.operators.transforms import dedupe_first

CHAMPIONS = 170
FIRST_ORDER = ["l_partkey", "l_suppkey", "l_extendedprice"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('EUW1_', o_orderkey) AS match_id",
        "o_orderdate AS game_creation",
        "60 + (o_orderkey * 37) % 2400 AS game_duration",
        "CASE WHEN o_orderkey % 5 = 0 THEN 'ARAM' ELSE 'CLASSIC' END AS game_mode",
        "o_orderstatus = 'P' AS game_in_progress",
        "o_orderstatus = 'F' AS is_processed",
        "o_orderdate AS tech_date_creation",
    )


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The players to process: suppliers not in debt; every fifth supplier was never processed."""
    return (
        table(spark, sf_dir, "supplier")
        .where("s_acctbal >= 0")
        .selectExpr(
            "concat('P', s_suppkey) AS puuid",
            "s_name AS game_name",
            "concat('TAG', s_nationkey) AS tag_line",
            "CASE WHEN s_suppkey % 5 = 0 THEN NULL "
            "ELSE TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(int(s_suppkey % 3650)) END AS date_processed",
        )
    )


#: What the statistics are made of: narrower than they are, so it is what is shuffled.
LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def _stat_columns(df: DataFrame, *kept: str) -> DataFrame:
    return df.selectExpr(
        *kept,
        "md5(concat('EUW1_', l_orderkey, '_', l_linenumber)) AS id",
        "concat('EUW1_', l_orderkey) AS match_id",
        "concat('P', l_suppkey) AS puuid",
        f"l_partkey % {CHAMPIONS} AS champion_id",
        f"concat('champ_', l_partkey % {CHAMPIONS}) AS champion_name",
        "CAST(l_quantity AS BIGINT) % 21 AS kills",
        "(l_linenumber * 3 + l_partkey) % 13 AS deaths",
        "(l_partkey + l_suppkey) % 25 AS assists",
        "IF(l_partkey % 7 = 0, 1, 0) AS double_kills",
        "IF(l_partkey % 23 = 0, 1, 0) AS triple_kills",
        "IF(l_partkey % 59 = 0, 1, 0) AS quadra_kills",
        "IF(l_partkey % 97 = 0, 1, 0) AS penta_kills",
        "1500 + l_partkey % 5000 + (l_suppkey * 13) % 3000 + l_linenumber * 50 AS total_damage_dealt_to_champions",
        "1000 + l_partkey % 5000 AS physical_damage_dealt_to_champions",
        "500 + (l_suppkey * 13) % 3000 AS magic_damage_dealt_to_champions",
        "CAST(l_linenumber AS BIGINT) * 50 AS true_damage_dealt_to_champions",
        "2300 + l_orderkey % 9000 + l_partkey % 700 + l_linenumber * 10 AS total_damage_taken",
        "2000 + l_orderkey % 9000 AS physical_damage_taken",
        "300 + l_partkey % 700 AS magic_damage_taken",
        "CAST(l_linenumber AS BIGINT) * 10 AS true_damage_taken",
        "(l_suppkey * 31) % 4000 AS total_heal",
        "l_orderkey % 60 AS total_minions_killed",
        "5000 + l_partkey % 9000 AS gold_earned",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        "l_linenumber",
    )


def raw_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Participant rows as landed: ids repeat."""
    return _stat_columns(table(spark, sf_dir, "lineitem")).drop("l_linenumber")


def unique_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per (order, line number): the numbers behind the id, so no text is hashed or sorted."""
    return dedupe_first(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], FIRST_ORDER)


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per id, the first in part, supplier, price order."""
    return stats_of_lines(unique_lines(spark, sf_dir))


def stats_of_lines(lines: DataFrame) -> DataFrame:
    """The statistics of lines, row by row."""
    return _stat_columns(lines).drop("l_partkey", "l_suppkey", "l_extendedprice", "l_linenumber")


def match_payloads(spark: SparkSession, sf_dir: str, only: str = "true") -> DataFrame:
    """One JSON match document per order and ten line numbers, its participants in line order; ``only`` chooses matches.

    (order, line number) is unique here, so a document never holds more than ten
    participants whatever an order's share of the lines.
    """
    lines = unique_lines(spark, sf_dir).selectExpr("concat('EUW1_', l_orderkey) AS match", "(l_linenumber - 1) div 10 AS part", *LINE)
    # A document's lines are brought together while they are narrow.
    lines = _stat_columns(lines.repartition("match", "part"), "match", "part")
    fields = {c: p for c, p in schemas.STAT_FIELDS.items() if c in lines.columns}
    one = F.struct(F.col("l_linenumber").alias("slot"), *[F.col(c).alias(p) for c, p in fields.items()])
    documents = lines.groupBy(F.col("match").alias("match_id"), "part").agg(F.sort_array(F.collect_list(one)).alias("people"))
    people = F.transform("people", lambda p: p.dropFields("slot"))
    created = to_epoch_ms(F.col("game_creation"))
    joined = documents.join(matches(spark, sf_dir).where(only), "match_id")
    document = F.struct(
        F.struct(
            F.col("match_id").alias("matchId"), F.transform("people", lambda p: p["puuid"]).alias("participants")
        ).alias("metadata"),
        F.struct(
            created.alias("gameCreation"),
            F.col("game_duration").alias("gameDuration"),
            F.col("game_mode").alias("gameMode"),
            F.lit("14.1").alias("gameVersion"),
            F.when(~F.col("game_in_progress"), created + F.col("game_duration") * 1000).alias("gameEndTimestamp"),
            people.alias("participants"),
        ).alias("info"),
    )
    return joined.select(F.to_json(document).alias("payload"))
