"""KPI arithmetic, groupings and panels."""

import datetime as dt

import pytest
from matchmill import schemas
from matchmill.plans import dashboards as D
from matchmill.plans import kpi as K
from pyspark.sql import functions as F
from tests.conftest import SF_DIR, rows

COLUMNS = [c for c in schemas.STAT_FIELDS if c not in ("puuid", "champion_id", "champion_name")]


def stats(spark, *games):
    """Games as dicts over zero statistics."""
    names = ["game_name", "champion_name", "champion_id", "game_duration", *COLUMNS]
    base = {c: 0 for c in COLUMNS} | {"game_name": "n", "champion_name": "c", "champion_id": 1, "game_duration": 600}
    ddl = ", ".join(f"{n} {'string' if n in ('game_name', 'champion_name') else 'int'}" for n in names)
    return spark.createDataFrame([tuple((base | g)[n] for n in names) for g in games], ddl)


def test_every_metric_of_one_game_by_hand(spark):
    """Ten minutes; the numbers on the right were worked out by hand from the formulas of the data model."""
    game = dict(
        kills=5, deaths=2, assists=3, double_kills=1, triple_kills=2, quadra_kills=3, penta_kills=1,
        total_damage_dealt_to_champions=12000, physical_damage_dealt_to_champions=9000, magic_damage_dealt_to_champions=2400,
        true_damage_dealt_to_champions=600, total_damage_taken=8000, physical_damage_taken=5000, magic_damage_taken=2000,
        true_damage_taken=1000, total_heal=1000, total_minions_killed=50, gold_earned=10000,
    )
    row = K.kpi(stats(spark, game), K.CHAMPION).first().asDict()
    expected = {
        "avg_damage_per_minute": 1200, "avg_physical_damage_per_minute": 900, "avg_magic_damage_per_minute": 240,
        "avg_true_damage_per_minute": 60, "avg_physical_damage_dealt_pct": 75, "avg_magic_damage_dealt_pct": 20,
        "avg_true_damage_dealt_pct": 5, "avg_kills_per_minute": 0.5, "avg_deaths_per_minute": 0.2, "avg_assists_per_minute": 0.3,
        "avg_multi_kill_score": 50, "penta_rate": 100, "avg_damage_taken_per_death": 4000,
        "avg_physical_damage_taken_per_minute": 500, "avg_magic_damage_taken_per_minute": 200, "avg_true_damage_taken_per_minute": 100,
        "avg_physical_damage_taken_pct": 62.5, "avg_magic_damage_taken_pct": 25, "avg_true_damage_taken_pct": 12.5,
        "avg_heal_per_minute": 100, "avg_cs_per_minute": 5, "avg_gold_per_minute": 1000, "avg_gold_per_cs": 200, "avg_kda": 4,
        "total_games": 1, "best_kills": 5, "best_damage": 12000, "best_deaths": 2,
        "tanking_index": 296.5, "damage_index": 950, "support_index": 53,
    }
    assert set(expected) == set(schemas.KPI_METRICS)
    assert {k: row[k] for k in expected} == pytest.approx(expected)
    assert list(row)[2:] == schemas.KPI_METRICS


def test_check_sql_gives_the_same_by_hand():
    """The SQL that queries are checked against, on the same game: its formulas are pinned by the same numbers."""
    import duckdb
    from matchmill.plans.queries.common import kpi_sql

    con = duckdb.connect()
    con.execute("""CREATE TABLE s AS SELECT 600 AS game_duration, 1 AS champion_id, 5 AS kills, 2 AS deaths, 3 AS assists, 1 AS double_kills,
        2 AS triple_kills, 3 AS quadra_kills, 1 AS penta_kills, 12000 AS total_damage_dealt_to_champions, 9000 AS physical_damage_dealt_to_champions,
        2400 AS magic_damage_dealt_to_champions, 600 AS true_damage_dealt_to_champions, 8000 AS total_damage_taken, 5000 AS physical_damage_taken,
        2000 AS magic_damage_taken, 1000 AS true_damage_taken, 1000 AS total_heal, 50 AS total_minions_killed, 10000 AS gold_earned""")
    found = con.execute(f"SELECT * FROM ({kpi_sql(['champion_id'], None)} GROUP BY champion_id)")
    row = dict(zip([d[0] for d in found.description], found.fetchall()[0]))
    some = {"tanking_index": 296.5, "damage_index": 950, "support_index": 53, "avg_kda": 4, "avg_multi_kill_score": 50, "penta_rate": 100, "avg_true_damage_taken_pct": 12.5}
    assert {k: row[k] for k in some} == pytest.approx(some)


def test_zero_divisors(spark):
    row = K.kpi(stats(spark, {"gold_earned": 7}), K.PLAYER).first()
    assert row["avg_gold_per_cs"] == 7 and row["avg_kda"] == 0 and row["avg_physical_damage_dealt_pct"] == 0
    assert row["tanking_index"] == pytest.approx(3.0)  # deaths per minute floored at 0.1


def test_short_and_unknown_durations_are_left_out(spark):
    games = [{"game_duration": d} for d in (None, 120, 121)]
    assert K.kpi(stats(spark, *games), K.PLAYER).first()["total_games"] == 1


def test_same_names_are_one_player(spark):
    assert K.kpi(stats(spark, {"champion_id": 1}, {"champion_id": 2}), K.PLAYER).first()["total_games"] == 2


def test_keys():
    assert K.group_keys(per_player=True) == ["game_name"]
    assert K.group_keys(True, True) == ["game_name", "champion_name", "champion_id"]
    with pytest.raises(ValueError):
        K.group_keys()


def test_groupings_from_states_equal_direct_ones(spark):
    games = [{"kills": i, "deaths": i % 3, "champion_id": i % 4, "game_name": f"n{i % 2}"} for i in range(30)]
    games.append({"kills": None, "game_name": "n0"})
    source = stats(spark, *games)
    keys = K.PLAYER + K.CHAMPION
    folded = K.kpi_from_states(K.kpi_states(source, keys), K.PLAYER)
    direct = K.kpi(source, K.PLAYER)

    def close(df):
        return rows(df.select("game_name", *[F.round(F.col(m).cast("double"), 9) for m in schemas.KPI_METRICS]))

    assert close(folded) == close(direct)


def test_totals_agree_across_groupings(spark):
    from matchmill.plans.queries.kpis import champion_input, mart, player_input

    games = K.eligible(champion_input(spark, SF_DIR)).count()
    assert mart(spark, SF_DIR, "champion").agg(F.sum("total_games")).first()[0] == games
    games = K.eligible(player_input(spark, SF_DIR)).count()
    assert mart(spark, SF_DIR, "player").agg(F.sum("total_games")).first()[0] == games
    both = mart(spark, SF_DIR, "player_champion").groupBy("game_name").agg(
        F.sum("total_games"), F.max("best_kills"), F.min("best_deaths")
    )
    assert rows(both) == rows(mart(spark, SF_DIR, "player").select("game_name", "total_games", "best_kills", "best_deaths"))


def test_top_k_puts_nulls_first_and_breaks_ties(spark):
    t = spark.createDataFrame([("b", 1), ("a", 1), ("n", None), ("c", 0)], "k string, v int")
    assert [r[0] for r in D.top_k(t, "v", 3, ["k"]).collect()] == ["n", "a", "b"]


def test_processed_today(spark):
    day = dt.date(2024, 1, 10)
    t = spark.createDataFrame(
        [("a", "t", dt.datetime(2024, 1, 10)), ("b", "t", dt.datetime(2024, 1, 10, 8)), ("c", "t", None)],
        "game_name string, tag_line string, date_processed timestamp_ntz",
    )

    def flags(**options):
        return [r["processed_today"] for r in D.players_to_process(t, day, **options).orderBy("game_name").collect()]

    assert flags() == [1, 0, 0] and flags(whole_day=True) == [1, 1, 0]


def test_panel_numbers_cover_all_dashboards():
    names = set(D.PANELS) | set(D.SELECTORS) | {f"d{i}" for i in range(31, 39)}
    assert names == {f"d{i:02}" for i in range(1, 39)}


def test_rows_are_shuffled_by_player_and_a_crowd_combines(spark, monkeypatch):
    """The same metrics however the rows are dealt; no buffers of four times their width are shuffled."""
    games = [{"game_name": f"n{i % 7}" if i % 3 else "hot", "champion_id": i % 5, "kills": i} for i in range(60)]
    source, keys = stats(spark, *games), K.PLAYER + K.CHAMPION
    source = source.unionByName(stats(spark, {"game_name": None}))
    pairs = [*{(f"p-{g['game_name']}", g["game_name"]) for g in games}]
    players = spark.createDataFrame(pairs, "puuid string, game_name string")
    landed = source.withColumn("puuid", F.concat(F.lit("p-"), "game_name"))
    assert K.crowded(landed, players) == []
    monkeypatch.setattr(K, "CROWD", 15)
    crowd = K.crowded(landed, players)
    assert len(crowd) == 1
    for grouping in (K.PLAYER, keys):
        want = rows(K.kpi(source, grouping))
        assert rows(K.by_player(source, lambda df, g=grouping: K.kpi(df, g), [])) == want
        assert len(rows(K.by_player(source.dropna(subset=["game_name"]), lambda df, g=grouping: K.kpi(df, g), crowd))) == len(want) - 1
    plan = K.by_player(source, lambda df: K.kpi(df, keys), [])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(game_name" in plan and plan.index("Exchange") > plan.index("partial_avg")
    states = K.kpi_states(source, keys)
    assert rows(K.kpi_of_states(states).select(*K.kpi_from_states(states, keys).columns)) == rows(K.kpi_from_states(states, keys))
