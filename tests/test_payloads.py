"""Payload operators on hand-made documents."""

import datetime as dt
import json

import pytest
from matchmill import schemas
from matchmill.operators import nested
from matchmill.sources import landing
from tests.conftest import rows


def match_document(match_id="M1", people=("p1", "p2"), ended=True, **stats):
    person = {"championId": 7, "championName": "seven", "kills": 1, "deaths": 8, "assists": 0, "item0": 3, **stats}
    info = {"gameCreation": 1704067200000, "gameDuration": 900, "gameMode": "ARAM", "gameVersion": "14.1"}
    if ended:
        info["gameEndTimestamp"] = 1704068100000
    info["participants"] = [{**person, "puuid": p} for p in people]
    return json.dumps({"metadata": {"matchId": match_id, "participants": list(people)}, "info": info})


def parsed(spark, *documents):
    return nested.parse_matches(spark.createDataFrame([(d,) for d in documents], "payload string"))


def test_header(spark):
    row = nested.match_header(parsed(spark, match_document(ended=False))).first()
    assert (row["match_id"], row["puuid_1"], row["puuid_2"], row["puuid_10"]) == ("M1", "p1", "p2", None)
    assert row["game_creation"] == dt.datetime(2024, 1, 1) and row["game_duration"] == 900
    assert row["game_in_progress"] and row["is_processed"]
    assert not nested.match_header(parsed(spark, match_document())).first()["game_in_progress"]


def test_participants(spark):
    out = nested.participants(parsed(spark, match_document()))
    assert out.columns == [*schemas.STAT_COLUMNS, *schemas.ITEM_FIELDS] and len(out.columns) == 38
    first = out.where("puuid = 'p1'").first()
    assert (first["kda"], first["item0"], first["item6"], first["champion_name"]) == (0.12, 3, None, "seven")
    assert "item0" not in nested.participants(parsed(spark, match_document()), items=False).columns


def test_three_outputs_and_named_output(spark):
    tables = nested.match_tables(parsed(spark, match_document(), "not json", '{"info": {}}'))
    assert {k: t.count() for k, t in tables.items()} == {
        "match_data": 1,
        "stats_participants": 2,
        "puuid_participants": 2,
    }
    with pytest.raises(KeyError):
        nested.named_output(tables, "absent")
    with pytest.raises(TypeError):
        nested.named_output([], "absent")


def test_quarantine(spark):
    bad = nested.quarantined(parsed(spark, match_document(), "not json", '{"info": {}}'))
    assert sorted(r[0] for r in bad.collect())[0] == "not json" and bad.count() == 2


def test_a_match_with_too_many_players_is_rejected_whole(spark):
    crowd = [f"p{i}" for i in range(12)]
    both = parsed(spark, match_document("M1", crowd), match_document("M2", crowd[:10]))
    assert nested.match_header(nested.readable(both)).select("match_id", "puuid_10").collect() == [("M2", "p9")]
    assert "M1" in nested.quarantined(both).first()[0] and nested.quarantined(both).count() == 1


def test_id_cap(spark):
    pages = [("p", 450, s, [f"m{i}" for i in range(s, min(s + 100, 1050))]) for s in range(0, 1050, 100)]
    pages.append(("p", 420, 0, ["other"]))
    landed = spark.createDataFrame(pages, schemas.ID_PAGE)
    assert nested.match_ids(landed).count() == 1050
    out = nested.match_ids(landed, cap=1000)
    assert [r["match_id"] for r in out.orderBy("position").collect()] == [f"m{i}" for i in range(1000)]


def test_league(spark):
    solo = ("RANKED_SOLO_5x5", "GOLD", "I")
    entries = [("a", [("RANKED_FLEX_SR", "IRON", "IV"), solo, ("RANKED_SOLO_5x5", "IRON", "II")]), ("b", []), ("c", None)]
    frame = spark.createDataFrame(entries, schemas.LEAGUE_ENTRIES)
    assert rows(nested.first_league_entry(frame)) == [("a", *solo), ("b", None, None, None), ("c", None, None, None)]
    accounts = spark.createDataFrame([("a", "n", "t")], schemas.ACCOUNT)
    players = spark.createDataFrame([("a",), ("z",)], "puuid string")
    assert rows(nested.player_info(players, accounts, frame)) == [
        ("a", "n", "t", *solo),
        ("z", None, None, None, None, None),
    ]


def test_reference_maps_from_files(spark, tmp_path):
    champions = {"data": {"A": {"name": "Ann", "id": "A", "key": "1", "blurb": "b", "tags": ["x", "y"]}, "B": {}}}
    (tmp_path / "c.json").write_text(json.dumps(champions, indent=2))
    out = nested.champions(landing.read_champions(spark, str(tmp_path / "c.json"), multi_line=True))
    assert rows(out) == [("", "", "", "", "", ""), ("Ann", "A", "1", "", "b", "x,y")]
    items = {"data": {"10": {"name": "Boots", "gold": {"total": 300}, "image": {"full": "f"}}, "11": {}}}
    (tmp_path / "i.json").write_text(json.dumps(items))
    out = nested.items(landing.read_items(spark, str(tmp_path / "i.json")))
    assert rows(out) == [("10", "Boots", "", "", 300, "f", ""), ("11", "", "", "", 0, "", "")]


def test_normalise_and_version(spark):
    df = spark.createDataFrame([(1, ((2, "x"), [3]))], "id int, a struct<b: struct<c: int, d: string>, e: array<int>>")
    flat = nested.normalise(df)
    assert flat.columns == ["id", "a.b.c", "a.b.d", "a.e"] and rows(flat) == [(1, 2, "x", [3])]
    versions = spark.createDataFrame([(["14.2", "14.1"],), ([],)], "v array<string>")
    assert [r[0] for r in versions.select(nested.latest_version(versions.v)).collect()] == ["14.2", None]


def test_documents_are_brought_together_while_narrow(spark):
    """The lines of a document are shuffled as they are read, and not again as statistics."""
    from matchmill.plans import star_views as V

    text = V.match_payloads(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in text
    assert not [x for x in text.splitlines() if "Exchange hashpartitioning(match_id" in x and "part" in x.split("ENSURE")[0]]
