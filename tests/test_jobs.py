"""The jobs end to end on a small warehouse, and the same as a stream."""

import datetime as dt
import json

import pytest
from matchmill import schemas
from matchmill.operators import guards
from matchmill.plans import jobs as J
from matchmill.sources import landing
from matchmill.streaming import drain
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tests.conftest import NOW, rows
from tests.test_payloads import match_document

MATCH, STATS, PLAYERS = schemas.FACT_MATCH.name, schemas.FACT_STATS.name, schemas.FACT_PLAYERS.name
LATER = dt.datetime(2026, 1, 3)


@pytest.fixture
def run(warehouse):
    warehouse.create_fixed()
    return J.Run(warehouse, "job", NOW)


def landed(spark, **documents):
    return spark.createDataFrame(list(documents.items()), "match_id string, payload string")


def test_enrich_stats(spark, run):
    run.warehouse.insert_lines(MATCH, [{"match_id": m} for m in ("M1", "M2", "M3")])
    documents = landed(
        spark, M1=match_document("M1", ["p1", "p2"]), M2=match_document("M2", ["p2", "p3"]), M3="broken", M9=match_document("M9")
    )
    done = J.enrich_stats(run, documents)
    assert done["stats"]["rows_affected"] == 4 and done["players"]["rows_affected"] == 3
    assert done["matches"] == {
        "target_table": "fact_datas.fact_match",
        "operations_performed": ["UPDATE"],
        "rows_affected": 2,
    }
    matches = run.warehouse.read(MATCH)
    assert rows(matches.select("match_id", "is_processed")) == [("M1", True), ("M2", True), ("M3", False)]
    assert rows(run.warehouse.read(J.QUARANTINE).select("payload", "tech_dag_id")) == [("broken", "job")]
    stats = run.warehouse.read(STATS)
    assert stats.where("item0 IS NOT NULL").count() == 0  # items stay in the raw table
    assert run.warehouse.read("raw_datas.raw_stats").where("item0 = 3").count() == 4
    assert rows(stats.select("kda").distinct()) == [(0,)]
    # a rerun finds only the broken one again, which is kept once
    with pytest.raises(guards.SkipJob):
        J.enrich_stats(run, documents)
    assert run.warehouse.read(J.QUARANTINE).count() == 1
    assert run.warehouse.read(STATS).count() == 4


def test_drains_come_to_their_end(spark, run):
    """Batches of one: a broken and an absent document first, and neither keeps the good ones from their turn."""
    lines = [{"match_id": m, "tech_date_creation": dt.datetime(2026, 1, i + 1)} for i, m in enumerate(("bad", "absent", "M1", "M2"))]
    run.warehouse.insert_lines(MATCH, lines)
    documents = landed(spark, bad="broken", M1=match_document("M1"), M2=match_document("M2", ["p3"]))
    assert J.drain(lambda: J.enrich_stats(run, documents, limit=1)) == 4
    done = run.warehouse.read(MATCH).where("is_processed").select("match_id")
    assert rows(done) == [("M1",), ("M2",)] and run.warehouse.read(J.QUARANTINE).count() == 1
    later = J.Run(run.warehouse, "job", LATER)
    assert rows(J.matches_to_fetch(run.warehouse, None, LATER)) == [("absent",), ("bad",)]
    repaired = landed(spark, bad=match_document("bad"))
    assert J.drain(lambda: J.enrich_stats(later, repaired, limit=1)) == 2
    assert run.warehouse.read(MATCH).where("is_processed").count() == 3


def test_players_without_ids_or_accounts_make_way(spark, run):
    todo = schemas.FACT_PLAYERS_TO_PROCESS.name
    run.warehouse.insert_lines(todo, [{"puuid": p, "date_processed": dt.datetime(2025, 1, i + 1)} for i, p in enumerate("abc")])
    pages = spark.createDataFrame([("c", 450, 0, ["M1"])], schemas.ID_PAGE)
    assert J.drain(lambda: J.enrich_matches(run, pages, limit=1)) == 3
    assert rows(run.warehouse.read(MATCH).select("match_id")) == [("M1",)]
    run.warehouse.insert_lines(PLAYERS, [{"puuid": p} for p in "abc"])
    accounts = spark.createDataFrame([("c", "Cid", "EUW")], schemas.ACCOUNT)
    entries = spark.createDataFrame([], schemas.LEAGUE_ENTRIES)
    assert J.drain(lambda: J.enrich_players(run, accounts, entries, limit=1)) == 3
    assert rows(run.warehouse.read(PLAYERS).select("puuid", "game_name", "date_processed")) == [("a", None, NOW), ("b", None, NOW), ("c", "Cid", NOW)]


def test_a_job_without_a_batch_size_takes_everything(spark, run):
    run.warehouse.insert_lines(MATCH, [{"match_id": f"M{i}"} for i in range(130)])
    documents = spark.createDataFrame([(match_document(f"M{i}", [f"p{i}"]),) for i in range(130)], "payload string")
    J.enrich_stats(run, documents)
    assert run.warehouse.read(MATCH).where("is_processed").count() == 130


def test_both_player_marts_scan_the_facts_once(spark, run, monkeypatch):
    run.warehouse.insert_lines(schemas.FACT_PLAYERS_TO_PROCESS.name, [{"puuid": "p1", "game_name": "Ann"}])
    run.warehouse.insert_lines(MATCH, [{"match_id": "M1"}])
    J.enrich_stats(run, landed(spark, M1=match_document("M1", ["p1", "p2"])))
    read, real = [], run.warehouse.read
    monkeypatch.setattr(type(run.warehouse), "read", lambda self, table: read.append(table) or real(table))
    done = J.kpi_players(run)
    assert read.count(STATS) == 1 and {k: v["rows_affected"] for k, v in done.items()} == {"player": 1, "player_champion": 1}


def test_stats_are_inserted_per_match(spark, run):
    run.warehouse.insert_lines(STATS, [{"id": "x", "match_id": "M1"}])
    run.warehouse.insert_lines(MATCH, [{"match_id": "M1"}])
    done = J.enrich_stats(run, landed(spark, M1=match_document("M1")))
    assert done["stats"]["rows_affected"] == 0 and done["matches"]["rows_affected"] == 1
    assert run.warehouse.read(STATS).count() == 1


def test_oldest_matches_first_and_limit(spark, run):
    lines = [{"match_id": f"M{i}", "tech_date_creation": dt.datetime(2026, 1, 9 - i)} for i in range(4)]
    run.warehouse.insert_lines(MATCH, lines)
    assert [r[0] for r in J.matches_to_fetch(run.warehouse, 2).collect()] == ["M3", "M2"]


def test_enrich_matches(spark, run):
    todo = schemas.FACT_PLAYERS_TO_PROCESS.name
    run.warehouse.insert_lines(
        todo, [{"puuid": "new"}, {"puuid": "old", "date_processed": dt.datetime(2025, 1, 1)}]
    )
    run.warehouse.insert_lines(MATCH, [{"match_id": "M1", "game_mode": "ARAM"}])
    pages = spark.createDataFrame(
        [("old", 450, 0, ["M1", "M2", "M2"]), ("old", 420, 0, ["other"]), ("new", 450, 0, ["M7"])], schemas.ID_PAGE
    )
    done = J.enrich_matches(run, pages, limit=1)
    assert done["rows_affected"] == 1
    assert rows(run.warehouse.read(MATCH).select("match_id", "game_mode")) == [("M1", "ARAM"), ("M2", None)]
    assert rows(run.warehouse.read(todo).select("puuid", "date_processed")) == [("new", None), ("old", NOW)]
    with pytest.raises(guards.SkipJob):
        J.enrich_matches(run, pages.where("queue = 0"))


def test_enrich_players(spark, run):
    run.warehouse.insert_lines(PLAYERS, [{"puuid": "a"}, {"puuid": "b"}, {"puuid": "c", "game_name": "kept"}])
    accounts = spark.createDataFrame([("a", "Ann", "EUW")], schemas.ACCOUNT)
    entries = spark.createDataFrame([("a", [("RANKED_SOLO_5x5", "GOLD", "I")])], schemas.LEAGUE_ENTRIES)
    assert J.enrich_players(run, accounts, entries)["rows_affected"] == 2
    columns = ["puuid", "game_name", "tag_line", "queue_type", "tier", "rank"]
    assert rows(run.warehouse.read(PLAYERS).select(columns)) == [
        ("a", "Ann", "EUW", "RANKED_SOLO_5x5", "GOLD", "I"),
        ("b", None, None, None, None, None),
        ("c", "kept", None, None, None, None),
    ]
    run.warehouse.update(PLAYERS, {"tag_line": "x"}, {"puuid": "b"})
    with pytest.raises(guards.SkipJob):
        J.enrich_players(run, accounts, entries)


def test_reference_tables(spark, run, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"data": {"A": {"name": "Ann", "id": "A"}}}))
    done = J.reference_champions(run, landing.read_champions(spark, str(tmp_path / "c.json")))
    assert done["rows_inserted"] == 1
    row = run.warehouse.read("referentiel.ref_champions").first()
    assert (row["name"], row["tags"], row["tech_execution_date"]) == ("Ann", "", "2026-01-02 04:04:05")


def test_kpi_jobs_update_in_place(spark, run):
    warehouse = run.warehouse
    warehouse.insert_lines(schemas.FACT_PLAYERS_TO_PROCESS.name, [{"puuid": "p1", "game_name": "Ann"}])
    warehouse.insert_lines(MATCH, [{"match_id": "M1"}, {"match_id": "M2"}])
    J.enrich_stats(run, landed(spark, M1=match_document("M1", ["p1", "p2"])))
    assert J.kpi_per_player(run)["rows_affected"] == 1
    assert J.kpi_per_player_champion(run)["rows_affected"] == 1
    assert J.kpi_per_champion(run)["rows_affected"] == 1
    later = J.Run(warehouse, "job", LATER)
    J.enrich_stats(later, landed(spark, M2=match_document("M2", ["p1", "p3"], championId=8)))
    assert J.kpi_per_champion(later)["operations_performed"] == ["UPDATE", "INSERT"]
    mart = warehouse.read(schemas.MART_CHAMPION.name)
    columns = ["champion_id", "total_games", "tech_date_creation", "tech_date_modification"]
    assert rows(mart.select(columns)) == [(7, 2, NOW, LATER), (8, 2, LATER, LATER)]
    J.kpi_per_player(later)
    assert rows(warehouse.read(schemas.MART_PLAYER.name).select("game_name", "total_games")) == [("Ann", 2)]


def test_payload_stream_applies_each_file_once(spark, run, tmp_path):
    inbox, checkpoint = tmp_path / "inbox", str(tmp_path / "checkpoint")
    inbox.mkdir()
    run.warehouse.insert_lines(MATCH, [{"match_id": "M1"}, {"match_id": "M2"}])
    batches = []

    def apply(batch, batch_id):
        batches.append(batch_id)
        J.apply_match_payloads(run, batch.withColumnRenamed("value", "payload"))

    def turn():
        stream = drain.landed_stream(
            spark, str(inbox), T.StructType([T.StructField("value", T.StringType())]), "text"
        )
        drain.drain(stream, apply, checkpoint).awaitTermination()

    (inbox / "1.json").write_text(match_document("M1", ["p1", "p2"]) + "\nbroken\n")
    turn()
    assert run.warehouse.read(STATS).count() == 2
    (inbox / "2.json").write_text(match_document("M2", ["p2", "p3"]))
    turn()
    turn()  # nothing new
    (inbox / "3.json").write_text("broken again")
    turn()
    assert len(batches) == 3 and run.warehouse.read(J.QUARANTINE).count() == 2
    assert run.warehouse.read(STATS).count() == 4 and run.warehouse.read(PLAYERS).count() == 3
    assert run.warehouse.read(MATCH).where(F.col("is_processed")).count() == 2
    # a batch applied again, as after a crash, changes nothing
    again = spark.createDataFrame([(match_document("M2", ["p2", "p3"]),)], "payload string")
    J.apply_match_payloads(run, again)
    assert run.warehouse.read(STATS).count() == 4


def test_a_long_work_list_is_sorted_over_all_tasks(spark, monkeypatch):
    """The first rows of a list longer than one task should hold, NULLs first, as a plain sort gives them."""
    work = spark.range(200).selectExpr("IF(id % 7 = 0, NULL, id % 5) AS attempted", "concat('M', xxhash64(id)) AS match_id").repartition(5)
    order = [F.asc_nulls_first("attempted"), F.asc("match_id")]
    want = [tuple(r) for r in sorted(work.collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))]
    monkeypatch.setattr(J, "TOP", 10)
    for limit in (11, 57, 199, 200, 300):
        picked = J._first(work, order, limit)
        assert "TakeOrdered" not in picked._jdf.queryExecution().executedPlan().toString()
        assert rows(picked) == sorted(want[:limit], key=repr)
    assert [tuple(r) for r in J._first(work, order, 10).collect()] == want[:10]


def test_batches_over_one_landing_parse_it_once(spark, run, monkeypatch):
    calls = []
    parse = J.nested.parse_matches
    monkeypatch.setattr(J.nested, "parse_matches", lambda *landing: calls.append(1) or parse(*landing))
    run.warehouse.insert_lines(MATCH, [{"match_id": m} for m in ("M1", "M2", "absent")])
    documents = landed(spark, M1=match_document("M1", ["p1", "p2"]), M2=match_document("M2", ["p2", "p3"]), M3="broken")
    parsed = J.parse_payloads(documents)
    assert J.drain(lambda: J.enrich_stats(run, documents, limit=1, parsed=parsed)) == 3
    assert len(calls) == 1
    matches = run.warehouse.read(MATCH)
    assert rows(matches.select("match_id", "is_processed")) == [("M1", True), ("M2", True), ("absent", False)]
    assert run.warehouse.read(STATS).count() == 4 and run.warehouse.read(J.QUARANTINE).count() == 1
    # Whether a document is readable is told by one column: its participants are not read for it.
    text = J.nested.quarantined(parsed).select(F.lit(1))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<_readable:boolean>" in text


def test_a_tidy_mart_job_leaves_one_version(spark, warehouse):
    import pathlib

    warehouse.create_fixed()
    run = J.Run(warehouse, "job", NOW, tidy=True)
    warehouse.insert_lines(schemas.FACT_PLAYERS_TO_PROCESS.name, [{"puuid": "p1", "game_name": "Ann"}])
    warehouse.insert_lines(MATCH, [{"match_id": "M1"}])
    J.enrich_stats(run, landed(spark, M1=match_document("M1", ["p1", "p2"])))
    for _ in range(2):
        J.kpi_per_player_champion(run)
    for table in ("raw_datas/raw_kpi_per_player_champion", "mart_datas/kpi_stats_per_player_champion"):
        assert len(list(pathlib.Path(f"{warehouse.root}/{table}").iterdir())) == 1
    assert rows(warehouse.read(schemas.MART_PLAYER_CHAMPION.name).select("game_name", "total_games")) == [("Ann", 1)]
