"""The end-to-end jobs on a scratch warehouse filled from the star-schema tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmill import schemas
from matchmill.functions import dates
from matchmill.plans import dashboards as D
from matchmill.plans import incremental
from matchmill.plans import jobs as J
from matchmill.plans import kpi as K
from matchmill.plans import star_views as V
from matchmill.plans.queries import common as C
from matchmill.plans.queries import payloads as P
from matchmill.plans.queries.common import Query, rounded
from matchmill.plans.queries.kpis import CHOSEN, panel_sql
from matchmill.plans.queries.merges import scratch_warehouse
from matchmill.session import cut_lineage, freed_shuffles, scratch_path
from matchmill.sources import landing
from matchmill.sources.versions import VersionedWarehouse
from matchmill.sources.warehouse import Warehouse

TIME = dt.datetime(2026, 1, 2, 3, 4, 5)
STAMP = "2026-01-02 04:04:05"


def new_run(spark: SparkSession, name: str, kind: type[Warehouse] = Warehouse) -> J.Run:
    """A run in a warehouse of its own, of which nobody reads earlier versions."""
    return J.Run(scratch_warehouse(spark, name, kind=kind), name, TIME, tidy=True)


def _stat_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that the statistics are made of, and their match."""
    return V.unique_lines(spark, sf_dir).select(F.expr("concat('EUW1_', l_orderkey)").alias("match_id"), *V.LINE)


def _stat_table(lines: DataFrame) -> DataFrame:
    """The statistics with every column of the fact table, those without a counterpart being NULL."""
    rows = V.stats_of_lines(lines)
    ratio = (F.col("kills") + F.col("assists")) / F.greatest("deaths", F.lit(1))
    rows = rows.withColumn("kda", F.rint(ratio))
    return rows.select(*[c for c in schemas.STAT_COLUMNS if c in rows.columns])


def fact_run(spark: SparkSession, sf_dir: str, name: str) -> J.Run:
    """A warehouse whose fact tables hold the statistics, matches and players."""
    run = new_run(spark, name)
    run.warehouse.create_fixed()
    run.warehouse.insert(_stat_lines(spark, sf_dir), schemas.FACT_STATS.name, derive=_stat_table)
    matches = V.matches(spark, sf_dir).drop("tech_date_creation")
    run.warehouse.insert(matches, schemas.FACT_MATCH.name)
    run.warehouse.insert(V.players(spark, sf_dir), schemas.FACT_PLAYERS_TO_PROCESS.name)
    return run


def _reference(kind: str):
    def make(spark: SparkSession, sf_dir: str) -> DataFrame:
        run = new_run(spark, f"reference_{kind}")
        if kind == "champions":
            J.reference_champions(run, P.champion_documents(spark, sf_dir))
        else:
            J.reference_items(run, P.item_documents(spark, sf_dir))
        return run.warehouse.read(f"{schemas.REF}.ref_{kind}")

    return make


def _reference_sql(kind: str) -> str:
    body = P.QUERIES[f"keyed_map_{kind}"].sql
    return f"SELECT *, 'reference_{kind}' AS tech_dag_id, '{STAMP}' AS tech_execution_date FROM ({body}) r"


def _enrich_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers, of which those of one segment already have a name."""
    run = new_run(spark, "enrich_players")
    run.warehouse.create_fixed(schemas.FACT_PLAYERS)
    known = V.table(spark, sf_dir, "customer").selectExpr(
        "concat('P', c_custkey) AS puuid", "IF(c_mktsegment = 'BUILDING', 'kept', NULL) AS game_name"
    )
    run.warehouse.insert(known, schemas.FACT_PLAYERS.name)
    entries = P.through_json(P.league_entries(spark, sf_dir), schemas.LEAGUE_ENTRIES)
    accounts = P.through_json(P.accounts(spark, sf_dir), schemas.ACCOUNT)
    J.enrich_players(run, accounts, entries, limit=None)
    return run.warehouse.read(schemas.FACT_PLAYERS.name).select(
        "puuid", "game_name", "tag_line", "queue_type", "tier", "rank"
    )


def _enrich_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match ids of the players named by order priority; matches of urgent orders are known already."""
    run = new_run(spark, "enrich_matches")
    run.warehouse.create_fixed(schemas.FACT_MATCH, schemas.FACT_PLAYERS_TO_PROCESS)
    orders = V.table(spark, sf_dir, "orders")
    players = orders.select(F.col("o_orderpriority").alias("puuid")).distinct()
    run.warehouse.insert(players, schemas.FACT_PLAYERS_TO_PROCESS.name)
    known = orders.where("o_orderpriority = '1-URGENT'").selectExpr(
        "concat('EUW1_', o_orderkey) AS match_id", "true AS is_processed"
    )
    run.warehouse.insert(known, schemas.FACT_MATCH.name)
    J.enrich_matches(run, P.through_json(P.id_pages(spark, sf_dir), schemas.ID_PAGE))
    done = run.warehouse.read(schemas.FACT_PLAYERS_TO_PROCESS.name).agg(
        F.count("date_processed").alias("n_done")
    )
    matches = run.warehouse.read(schemas.FACT_MATCH.name).select("match_id", "is_processed")
    return matches.withColumn("players_done", done.scalar())


def _landed_matches(spark: SparkSession, sf_dir: str, only: str = "true") -> DataFrame:
    """Match documents as landed lines, with one that cannot be read and one with too many players for each order status.

    ``only`` is a condition on the matches.
    """
    path = scratch_path(spark, "landing")
    orders = V.table(spark, sf_dir, "orders")
    broken = orders.select(F.concat(F.lit("broken "), "o_orderstatus").alias("payload")).distinct()
    crowd = F.lit('{"metadata": {"matchId": "crowd", "participants": ["' + '", "'.join(f"p{i}" for i in range(12)) + '"]}}')
    good = V.match_payloads(spark, sf_dir, only)
    with freed_shuffles(spark):
        good.union(broken).union(broken.limit(1).select(crowd)).write.text(path, compression="gzip")
    return landing.read_payload_lines(spark, path)


def _stats_run(spark: SparkSession, sf_dir: str) -> J.Run:
    """Every match waiting to be processed, and its document landed among unusable ones."""
    run = new_run(spark, "enrich_stats")
    run.warehouse.create_fixed()
    ids = V.matches(spark, sf_dir).select("match_id")
    run.warehouse.insert(ids, schemas.FACT_MATCH.name)
    J.enrich_stats(run, _landed_matches(spark, sf_dir))
    return run


def _enrich_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _stats_run(spark, sf_dir)
    return run.warehouse.read(schemas.FACT_STATS.name).select("id", "match_id", "puuid", "kda", *P._STAT_OUT)


def _enrich_stats_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _stats_run(spark, sf_dir)
    slots = [f"puuid_{i}" for i in range(1, schemas.PLAYERS_PER_MATCH + 1)]
    return run.warehouse.read(schemas.FACT_MATCH.name).select(
        "match_id", *slots, "game_duration", "game_in_progress", "is_processed", "tech_date_modification"
    ).withColumn("tech_date_modification", F.col("tech_date_modification") == dates.utc_timestamp(TIME))


def _enrich_stats_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _stats_run(spark, sf_dir)
    return run.warehouse.read(schemas.FACT_PLAYERS.name).select("puuid", "game_name")


def _rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejected table after two runs over the same landing folder: each document once."""
    run = _stats_run(spark, sf_dir)
    again = J.Run(run.warehouse, run.job_id, TIME + dt.timedelta(days=1))
    run.warehouse.insert_lines(schemas.FACT_MATCH.name, [{"match_id": "crowd"}])
    J.drain(lambda: J.enrich_stats(again, _landed_matches(spark, sf_dir, only="false")))
    crowded = F.get_json_object("payload", "$.metadata.matchId")
    return run.warehouse.read(J.QUARANTINE).select(F.coalesce(crowded, F.col("payload")).alias("document"), "tech_execution_date")


def _drain_past_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches over matches of which a third have no document, the oldest among them, until nothing is left to pick.

    A batch is a third of the list, so the number of batches does not grow with it.
    """
    run = new_run(spark, "drain")
    run.warehouse.create_fixed()
    matches = V.matches(spark, sf_dir).select("match_id", (F.col("game_duration") % 3).cast("string").alias("third"))
    landed = _landed_matches(spark, sf_dir, "game_duration % 3 <> 0")
    created = F.expr("TIMESTAMP_NTZ '2026-01-01 00:00:00' + make_dt_interval(int(third))")
    run.warehouse.insert(matches.select("match_id", created.alias("tech_date_creation")), schemas.FACT_MATCH.name)
    size = max(1, -(-matches.count() // 3))
    parsed = J.parse_payloads(landed)  # for all batches: each looks its own matches up
    batches = J.drain(lambda: J.enrich_stats(run, landed, limit=size, parsed=parsed))
    done = run.warehouse.read(schemas.FACT_MATCH.name).select("match_id", "is_processed")
    return done.withColumn("batches", F.lit(batches).cast("bigint"))


def _kpi_job(name: str):
    def make(spark: SparkSession, sf_dir: str) -> DataFrame:
        run = fact_run(spark, sf_dir, f"kpi_{name}")
        job = {"player": J.kpi_per_player, "champion": J.kpi_per_champion, "player_champion": J.kpi_per_player_champion}
        job[name](run)
        job[name](run)  # a second run updates every row and inserts none
        mart = run.warehouse.read(f"{schemas.MART}.kpi_stats_per_{name}")
        return rounded(mart.drop("tech_date_creation", "tech_date_modification"))

    return make


def _kpi_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both player marts from one pass, joined: the games of each player and the champions they played."""
    run = fact_run(spark, sf_dir, "kpi_players")
    J.kpi_players(run)
    champions = run.warehouse.read(schemas.MART_PLAYER_CHAMPION.name).groupBy("game_name").agg(F.count("*").alias("champions"))
    return run.warehouse.read(schemas.MART_PLAYER.name).select("game_name", "total_games").join(champions, "game_name")


def _incremental(name: str):
    """The mart after three loads: most matches, then the rest, named by the load, then other lengths of some of them.

    The first two loads are told apart by the match's number; every 50th match that counts is first told to have lasted 900 seconds.
    """

    def make(spark: SparkSession, sf_dir: str) -> DataFrame:
        run = new_run(spark, f"incremental_{name}", VersionedWarehouse)
        run.warehouse.create_fixed()
        run.warehouse.insert(V.players(spark, sf_dir), schemas.FACT_PLAYERS_TO_PROCESS.name)
        number = F.substring("match_id", 6, 20).cast("bigint")
        # A match too short to count is told right: a group that nobody is in any more would keep its row.
        later, wrong = number % 7 == 3, (number % 50 == 1) & (F.col("game_duration") > K.MIN_DURATION)
        matches, lines = V.matches(spark, sf_dir).drop("tech_date_creation"), _stat_lines(spark, sf_dir)
        for part in (~later, later):
            told = F.when(wrong, F.lit(900)).otherwise(F.col("game_duration")).cast("bigint")
            loaded = matches.where(part)
            run.warehouse.insert(lines.where(part), schemas.FACT_STATS.name, derive=_stat_table)
            run.warehouse.insert(loaded.withColumn("game_duration", told), schemas.FACT_MATCH.name)
            incremental.refresh(run, loaded.select("match_id"))
        right = cut_lineage(matches.where(wrong).select("match_id", "game_duration"), "right")
        run.warehouse.merge(right, schemas.FACT_MATCH.name, ["match_id"], ["game_duration"], has_matched=True, now=run.time)
        incremental.refresh(run)
        mart = run.warehouse.read(f"{schemas.MART}.kpi_stats_per_{name}")
        return rounded(mart.drop("tech_date_creation", "tech_date_modification"))

    return make


def _stored_panel(name: str) -> Query:
    """A panel as a dashboard reads it: the job fills the mart, and the panel reads the stored table."""

    def make(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = D.PANELS[name]
        run = fact_run(spark, sf_dir, f"panel_{name}")
        {"player": J.kpi_players, "champion": J.kpi_per_champion, "player_champion": J.kpi_players}[spec.mart](run)
        mart = run.warehouse.read(f"{schemas.MART}.kpi_stats_per_{spec.mart}")
        return rounded(D.panel(mart, spec, CHOSEN.get(spec.key)))

    return Query(make, panel_sql(name))


_ORDER = "champion_id, champion_name, kills, deaths, assists, double_kills, triple_kills, quadra_kills, penta_kills"

QUERIES: dict[str, Query] = {
    "job_reference_champions": Query(_reference("champions"), _reference_sql("champions")),
    "job_reference_items": Query(_reference("items"), _reference_sql("items")),
    "job_enrich_players": Query(
        _enrich_players,
        f"""SELECT concat('P', CAST(c_custkey AS VARCHAR)) AS puuid,
        CASE WHEN c_mktsegment = 'BUILDING' THEN 'kept' WHEN c_mktsegment <> 'MACHINERY' THEN c_name END AS game_name,
        CASE WHEN c_mktsegment NOT IN ('MACHINERY', 'BUILDING') THEN concat('TAG', CAST(c_nationkey AS VARCHAR)) END AS tag_line,
        CASE WHEN c_mktsegment <> 'BUILDING' THEN queue_type END AS queue_type,
        CASE WHEN c_mktsegment <> 'BUILDING' THEN tier END AS tier,
        CASE WHEN c_mktsegment <> 'BUILDING' THEN "rank" END AS "rank"
        FROM (SELECT *, {P._LEAGUE_SQL} FROM customer)""",
    ),
    "job_enrich_matches": Query(
        _enrich_matches,
        """SELECT concat('EUW1_', CAST(o_orderkey AS VARCHAR)) AS match_id, o_orderpriority = '1-URGENT' AS is_processed,
               (SELECT count(DISTINCT o_orderpriority) FROM orders) AS players_done FROM orders
        WHERE o_orderpriority = '1-URGENT' OR o_orderstatus = 'F'""",
    ),
    "job_enrich_stats": Query(
        _enrich_stats,
        C.with_views(
            f"""SELECT * EXCLUDE (n) FROM (SELECT md5(concat(match_id, '_', puuid)) AS id, match_id, puuid, {P._STAT_SQL},
            CAST(round_even({P._KDA_SQL}, 0) AS INTEGER) AS kda,
            row_number() OVER (PARTITION BY match_id, puuid ORDER BY {_ORDER}, total_damage_dealt_to_champions,
              physical_damage_dealt_to_champions, magic_damage_dealt_to_champions, true_damage_dealt_to_champions,
              total_damage_taken, gold_earned) AS n FROM fx_stats) WHERE n = 1""",
            C.FX_RAW_STATS,
            C.FX_STATS,
        ),
    ),
    "job_enrich_stats_matches": Query(
        _enrich_stats_matches,
        C.with_views(
            f"""SELECT m.match_id, p.* EXCLUDE (match_id), CASE WHEN p.match_id IS NOT NULL THEN m.game_duration END AS game_duration,
            p.match_id IS NOT NULL AND m.game_in_progress AS game_in_progress, p.match_id IS NOT NULL AS is_processed,
            p.match_id IS NOT NULL AS tech_date_modification
            FROM fx_match m LEFT JOIN (SELECT match_id, {P._SLOTS} FROM
              (SELECT match_id, puuid, row_number() OVER (PARTITION BY match_id ORDER BY l_linenumber) AS slot FROM fx_stats)
              GROUP BY match_id) p ON m.match_id = p.match_id""",
            C.FX_MATCH,
            C.FX_RAW_STATS,
            C.FX_STATS,
        ),
    ),
    "job_enrich_stats_players": Query(
        _enrich_stats_players,
        "SELECT DISTINCT concat('P', CAST(l_suppkey AS VARCHAR)) AS puuid, CAST(NULL AS VARCHAR) AS game_name FROM lineitem",
    ),
    "job_rejected": Query(
        _rejected,
        f"""SELECT DISTINCT 'broken ' || o_orderstatus AS document, '{STAMP}' AS tech_execution_date FROM orders
        UNION ALL SELECT 'crowd', '{STAMP}' FROM (SELECT 1 FROM orders LIMIT 1)""",
    ),
    "job_drain_past_rejected": Query(
        _drain_past_rejected,
        C.with_views(
            """SELECT m.match_id, m.game_duration % 3 <> 0 AND l.match_id IS NOT NULL AS is_processed, CAST(3 AS BIGINT) AS batches
            FROM fx_match m LEFT JOIN (SELECT DISTINCT match_id FROM fx_stats) l ON m.match_id = l.match_id""",
            C.FX_MATCH,
            C.FX_RAW_STATS,
            C.FX_STATS,
        ),
    ),
    "job_kpi_players": Query(
        _kpi_players,
        f"""SELECT game_name, total_games, champions FROM ({C.mart_sql("player")}) p
        JOIN (SELECT game_name, count(*) AS champions FROM ({C.mart_sql("player_champion")}) GROUP BY game_name) c USING (game_name)""",
    ),
    "job_kpi_per_player": Query(_kpi_job("player"), C.mart_sql("player")),
    "job_kpi_per_player_champion": Query(_kpi_job("player_champion"), C.mart_sql("player_champion")),
    "job_incremental_champion": Query(_incremental("champion"), C.mart_sql("champion")),
    "job_incremental_player_champion": Query(_incremental("player_champion"), C.mart_sql("player_champion")),
    "job_kpi_per_champion": Query(_kpi_job("champion"), C.mart_sql("champion")),
    **{f"stored_{name}": _stored_panel(name) for name in ("d01", "d11", "d15", "d23")},
}
