"""Landed JSON built from the star-schema tables, then read back by the payload operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmill import schemas
from matchmill.operators import nested
from matchmill.operators.ranking import numbered_in_groups
from matchmill.plans import star_views as V
from matchmill.plans.queries import common as C
from matchmill.plans.queries.common import Query, rounded
from matchmill.session import scratch_path
from matchmill.sources import landing


def parsed_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.readable(nested.parse_matches(V.match_payloads(spark, sf_dir)))


def through_json(df: DataFrame, ddl: str) -> DataFrame:
    """Every row to a JSON text and back through the declared schema, as a landed file would be."""
    text = df.select(F.to_json(F.struct("*")).alias("payload"))
    return text.select(F.from_json("payload", schemas.struct_of(ddl)).alias("doc")).select("doc.*")


# ---- matches ----

# What the test statistics know of a participant; the other payload fields are absent there and come out as NULL.
_KNOWN = """champion_id kills deaths assists double_kills triple_kills quadra_kills penta_kills total_damage_dealt_to_champions
  physical_damage_dealt_to_champions magic_damage_dealt_to_champions true_damage_dealt_to_champions total_damage_taken
  physical_damage_taken magic_damage_taken true_damage_taken total_heal total_minions_killed gold_earned""".split()
_STAT_OUT = [c for c in schemas.STAT_FIELDS if c != "puuid"]
_STAT_SQL = ", ".join(
    c if c == "champion_name" else f"CAST({c if c in _KNOWN else 'NULL'} AS INTEGER) AS {c}" for c in _STAT_OUT
)
_KDA_SQL = "round_even((kills + assists) / greatest(deaths, 1), 2)"


def _participants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.participants(parsed_matches(spark, sf_dir))


_SLOTS = ",\n".join(
    f"max(CASE WHEN slot = {i} THEN puuid END) AS puuid_{i}" for i in range(1, schemas.PLAYERS_PER_MATCH + 1)
)


# ---- id pages ----


def id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys per priority and status in pages of a hundred, as the id lists land.

    A handful of players share all orders here, so positions come from the distributed
    numbering and no player's list is gathered whole.
    """
    # Queue numbers standing for the order states.
    queue = F.when(F.col("o_orderstatus") == "F", 450).when(F.col("o_orderstatus") == "O", 420).otherwise(400)
    ids = V.table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("puuid"), queue.alias("queue"), "o_orderkey")
    numbered = numbered_in_groups(ids, ["puuid", "queue"], ["o_orderkey"], "n")
    page = F.expr(f"(n - 1) div {nested.PAGE_SIZE}")
    lists = numbered.groupBy("puuid", "queue", page.alias("page")).agg(
        F.sort_array(F.collect_list(F.struct("n", F.concat(F.lit("EUW1_"), "o_orderkey").alias("id")))).alias("ids")
    )
    return lists.select(
        "puuid",
        "queue",
        (F.col("page") * nested.PAGE_SIZE).alias("start"),
        F.transform("ids", lambda x: x["id"]).alias("match_ids"),
    )


def _id_list_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.match_ids(through_json(id_pages(spark, sf_dir), schemas.ID_PAGE), cap=nested.IDS_PER_PLAYER)


# ---- players ----


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An account for every customer but those of one segment."""
    rows = V.table(spark, sf_dir, "customer").where("c_mktsegment <> 'MACHINERY'")
    return rows.selectExpr(
        "concat('P', c_custkey) AS puuid", "c_name AS gameName", "concat('TAG', c_nationkey) AS tagLine"
    )


def league_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's entries: a flex queue for all, the solo queue for those with money."""
    flex = "named_struct('queueType', 'RANKED_FLEX_SR', 'tier', 'IRON', 'rank', 'IV')"
    solo = (
        f"named_struct('queueType', '{nested.RANKED_QUEUE}', 'tier', c_mktsegment, "
        "'rank', IF(c_acctbal > 5000, 'I', 'II'))"
    )
    return V.table(spark, sf_dir, "customer").selectExpr(
        "concat('P', c_custkey) AS puuid", f"IF(c_acctbal > 0, array({flex}, {solo}), array({flex})) AS entries"
    )


def _player_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    players = V.table(spark, sf_dir, "customer").selectExpr("concat('P', c_custkey) AS puuid")
    return nested.player_info(
        players,
        through_json(accounts(spark, sf_dir), schemas.ACCOUNT),
        through_json(league_entries(spark, sf_dir), schemas.LEAGUE_ENTRIES),
    )


_LEAGUE_SQL = """CASE WHEN c_acctbal > 0 THEN 'RANKED_SOLO_5x5' END AS queue_type,
  CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS tier,
  CASE WHEN c_acctbal > 5000 THEN 'I' WHEN c_acctbal > 0 THEN 'II' END AS "rank" """


# ---- reference maps ----


def champion_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per part with two entries: a full one, and a bare one that lacks most keys."""
    full = F.to_json(
        F.struct(
            F.col("p_name").alias("name"),
            F.concat(F.lit("C"), "p_partkey").alias("id"),
            F.col("p_partkey").cast("string").alias("key"),
            F.col("p_type").alias("title"),
            F.col("p_brand").alias("blurb"),
            F.split("p_name", " ").alias("tags"),
        )
    )
    bare = F.to_json(F.struct(F.concat(F.lit("B"), "p_partkey").alias("id")))
    text = F.concat(
        F.lit('{"data": {"C'), "p_partkey", F.lit('": '), full, F.lit(', "B'), "p_partkey", F.lit('": '), bare, F.lit("}}")
    )
    documents = V.table(spark, sf_dir, "part").select(text.alias("payload"))
    return documents.select(F.from_json("payload", schemas.struct_of(schemas.CHAMPIONS)).alias("d")).select("d.*")


def item_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per part; small parts have no gold and no image."""
    item = F.when(
        F.col("p_size") > 10,
        F.struct(
            F.col("p_name").alias("name"),
            F.col("p_type").alias("description"),
            F.lit("plain").alias("plaintext"),
            F.struct(F.col("p_size").cast("bigint").alias("total")).alias("gold"),
            F.struct(F.concat("p_partkey", F.lit(".png")).alias("full"), F.lit("s.png").alias("sprite")).alias("image"),
        ),
    )
    text = F.coalesce(F.to_json(item), F.to_json(F.struct(F.col("p_name").alias("name"))))
    body = F.concat(F.lit('{"data": {"'), "p_partkey", F.lit('": '), text, F.lit("}}"))
    documents = V.table(spark, sf_dir, "part").select(body.alias("payload"))
    return documents.select(F.from_json("payload", schemas.struct_of(schemas.ITEMS)).alias("d")).select("d.*")


# ---- generic bodies ----

_EVENT_BODY = "id bigint, event struct<type: string, value: double, props: struct<k: bigint>>, tags array<string>"


def _normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as nested bodies written to JSON files, read back and flattened."""
    props = F.from_json("props", "k bigint")
    bodies = V.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.struct(F.col("event_type").alias("type"), "value", props.alias("props")).alias("event"),
        F.array("event_type", F.lit("seen")).alias("tags"),
    )
    path = scratch_path(spark, "events")
    bodies.write.json(path)
    flat = nested.normalise(landing.read_json(spark, path, _EVENT_BODY))
    return flat.withColumn("tags", F.array_join("tags", ","))


def _unknown_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose keys depend on the order's status, flattened without a schema."""
    document = """concat('{"id":', o_orderkey, ',"order":{"status":"', o_orderstatus, '"',
        IF(o_orderstatus = 'F', concat(',"the priority":"', o_orderpriority, '"'), ''), '}',
        IF(o_orderstatus = 'P', concat(',"customer":', o_custkey), ''),
        CASE o_orderstatus WHEN 'F' THEN ',"mixed":1' WHEN 'O' THEN ',"mixed":"t"' ELSE '' END,
        ',"tags":["', o_orderstatus, '","x"],"more":{"a":{"b":', o_orderkey % 9, '}}}') AS payload"""
    flat = nested.flatten_json(V.table(spark, sf_dir, "orders").selectExpr(document))
    return flat.withColumn("tags", F.array_join("tags", ","))


QUERIES: dict[str, Query] = {
    "match_header": Query(
        lambda spark, sf_dir: nested.match_header(parsed_matches(spark, sf_dir)),
        C.with_views(
            f"""SELECT m.match_id, p.* EXCLUDE (match_id), m.game_creation, m.game_duration, m.game_mode,
            '14.1' AS game_version, m.game_in_progress, true AS is_processed
            FROM fx_match m JOIN (SELECT match_id, {_SLOTS} FROM
              (SELECT match_id, puuid, row_number() OVER (PARTITION BY match_id ORDER BY l_linenumber) AS slot FROM fx_stats)
              GROUP BY match_id) p ON m.match_id = p.match_id""",
            C.FX_MATCH,
            C.FX_RAW_STATS,
            C.FX_STATS,
        ),
    ),
    "participants": Query(
        _participants,
        C.with_views(
            f"SELECT md5(concat(match_id, '_', puuid)) AS id, match_id, puuid, {_STAT_SQL}, {_KDA_SQL} AS kda, "
            + ", ".join(f"CAST(NULL AS INTEGER) AS {c}" for c in schemas.ITEM_FIELDS)
            + " FROM fx_stats",
            C.FX_RAW_STATS,
            C.FX_STATS,
        ),
    ),
    "participant_ratio": Query(
        lambda spark, sf_dir: nested.participants(parsed_matches(spark, sf_dir))
        .groupBy("champion_id")
        .agg(F.count(F.lit(1)).alias("n"), F.max("kda").alias("best_kda")),
        C.with_views(
            "SELECT CAST(champion_id AS INTEGER) AS champion_id, count(*) AS n,"
            " max(round_even((kills + assists) / greatest(deaths, 1), 2)) AS best_kda FROM fx_stats GROUP BY 1",
            C.FX_RAW_STATS,
            C.FX_STATS,
        ),
    ),
    "participant_ids": Query(
        lambda spark, sf_dir: nested.participant_ids(parsed_matches(spark, sf_dir)),
        C.with_views("SELECT puuid FROM fx_stats", C.FX_RAW_STATS, C.FX_STATS),
    ),
    "id_list_cap": Query(
        _id_list_cap,
        f"""SELECT puuid, n - 1 AS position, match_id FROM
        (SELECT o_orderpriority AS puuid, concat('EUW1_', CAST(o_orderkey AS VARCHAR)) AS match_id,
                row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS n
         FROM orders WHERE o_orderstatus = 'F') WHERE n <= {nested.IDS_PER_PLAYER}""",
    ),
    "first_league_entry": Query(
        lambda spark, sf_dir: nested.first_league_entry(
            through_json(league_entries(spark, sf_dir), schemas.LEAGUE_ENTRIES)
        ),
        f"SELECT concat('P', CAST(c_custkey AS VARCHAR)) AS puuid, {_LEAGUE_SQL} FROM customer",
    ),
    "player_info": Query(
        _player_info,
        f"""SELECT concat('P', CAST(c_custkey AS VARCHAR)) AS puuid,
        CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_name END AS game_name,
        CASE WHEN c_mktsegment <> 'MACHINERY' THEN concat('TAG', CAST(c_nationkey AS VARCHAR)) END AS tag_line,
        {_LEAGUE_SQL} FROM customer""",
    ),
    "keyed_map_champions": Query(
        lambda spark, sf_dir: nested.champions(champion_documents(spark, sf_dir)),
        """SELECT p_name AS name, concat('C', CAST(p_partkey AS VARCHAR)) AS id, CAST(p_partkey AS VARCHAR) AS key,
           p_type AS title, p_brand AS description, replace(p_name, ' ', ',') AS tags FROM part
           UNION ALL SELECT '', concat('B', CAST(p_partkey AS VARCHAR)), '', '', '', '' FROM part""",
    ),
    "keyed_map_items": Query(
        lambda spark, sf_dir: nested.items(item_documents(spark, sf_dir)),
        """SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name,
           CASE WHEN p_size > 10 THEN p_type ELSE '' END AS description,
           CASE WHEN p_size > 10 THEN 'plain' ELSE '' END AS plaintext,
           CAST(CASE WHEN p_size > 10 THEN p_size ELSE 0 END AS BIGINT) AS cost,
           CASE WHEN p_size > 10 THEN concat(CAST(p_partkey AS VARCHAR), '.png') ELSE '' END AS image_full,
           CASE WHEN p_size > 10 THEN 's.png' ELSE '' END AS image_sprite FROM part""",
    ),
    "json_normalise": Query(
        lambda spark, sf_dir: rounded(_normalised(spark, sf_dir)),
        f"""SELECT event_id AS id, event_type AS "event.type", {C.rounded_sql("value")} AS "event.value",
           CAST(json_extract(props, '$.k') AS BIGINT) AS "event.props.k", concat(event_type, ',seen') AS tags FROM events""",
    ),
    "json_unknown_shape": Query(
        _unknown_shape,
        """SELECT o_orderkey AS id, o_orderstatus AS "order.status",
           CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS "order.the priority",
           CASE WHEN o_orderstatus = 'P' THEN o_custkey END AS customer,
           CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '"t"' END AS mixed, concat(o_orderstatus, ',x') AS tags,
           o_orderkey % 9 AS "more.a.b" FROM orders""",
    ),
}
