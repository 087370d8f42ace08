"""Incremental marts against full runs: new, altered and repeated matches, players listed later, lost jobs."""

import datetime as dt
import random

import pytest
from matchmill import schemas
from matchmill.plans import incremental, jobs
from matchmill.plans import kpi as K
from matchmill.plans.queries.common import rounded
from matchmill.sources.versions import VersionedWarehouse
from matchmill.sources.warehouse import BUCKET
from pyspark.sql import functions as F
from tests.conftest import NOW

MARTS = [schemas.MART_PLAYER, schemas.MART_PLAYER_CHAMPION, schemas.MART_CHAMPION]


def new_run(spark, tmp_path, name):
    run = jobs.Run(VersionedWarehouse(spark, str(tmp_path / name), f"{name}_{abs(hash(str(tmp_path))) % 10**8}_", buckets=4), name, NOW)
    run.warehouse.create_fixed()
    return run


def statistics(spark, seed, matches):
    """Ten rows for each of ``matches``; the numbers follow from the match's, so that loads can be repeated."""
    rows = []
    for m in matches:
        draw = random.Random(seed * 10_000 + m)
        for p in range(10):
            rows.append((f"{m}_{p}", f"M{m}", f"P{draw.randrange(30)}", draw.randrange(9), *[draw.randrange(1, 900) for _ in range(6)]))
    names = ["id", "match_id", "puuid", "champion_id", "kills", "deaths", "assists", "gold_earned", "total_damage_taken", "total_damage_dealt_to_champions"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {'string' if i < 3 else 'int'}" for i, n in enumerate(names)))
    rest = [c for c in schemas.STAT_COLUMNS if c not in names and c != "champion_name"]
    return df.withColumn("champion_name", F.concat(F.lit("C"), "champion_id")).withColumns({c: F.lit(3) for c in rest})


def load(run, spark, matches, durations=None):
    run.warehouse.insert(statistics(spark, 1, matches), schemas.FACT_STATS.name)
    rows = [(f"M{m}", (durations or {}).get(m, 60 + m * 37 % 2000 if m % 11 else None)) for m in matches]
    run.warehouse.insert(spark.createDataFrame(rows, "match_id string, game_duration bigint"), schemas.FACT_MATCH.name)


def follow(run, spark, players):
    run.warehouse.insert(spark.createDataFrame([(f"P{p}", f"N{p // 2}") for p in players], "puuid string, game_name string"), schemas.FACT_PLAYERS_TO_PROCESS.name)


def marts(run):
    out = []
    for mart in MARTS:
        df = rounded(run.warehouse.read(mart.name).drop("tech_date_creation", "tech_date_modification"), 5)
        out.append(sorted((tuple(r) for r in df.collect()), key=repr))
    return out


def rebuilt(run):
    """The marts as computed from all facts."""
    stats, players, matches = jobs._facts(run)
    out = []
    for keys in (K.PLAYER, [*K.PLAYER, *K.CHAMPION], K.CHAMPION):
        rows = K.champion_stats(stats, matches) if keys == K.CHAMPION else K.player_stats(stats, players, matches)
        df = rounded(K.kpi(rows, keys).select(*schemas.KPI_METRICS, *keys), 5)
        out.append(sorted((tuple(r) for r in df.collect()), key=repr))
    return out


def test_runs_equal_rebuilds(spark, tmp_path):
    run = new_run(spark, tmp_path, "inc")
    load(run, spark, range(1, 60))
    follow(run, spark, range(0, 12))
    assert incremental.refresh(run)["matches"] == len([m for m in range(1, 60) if m % 11])
    assert marts(run) == rebuilt(run)

    # Ten new matches, named by the load and read from their partitions only; a new player; a renamed one.
    load(run, spark, range(100, 110))
    follow(run, spark, [20, 21])
    run.warehouse.update(schemas.FACT_PLAYERS_TO_PROCESS.name, {"game_name": "renamed"}, {"puuid": "P4"})
    ids = spark.createDataFrame([(f"M{m}",) for m in [*range(100, 110), 5, 10_000]], "match_id string")
    assert incremental.fold(run.warehouse, ids) == len([m for m in range(100, 110) if m % 11])
    incremental.refresh(run, ids.limit(0))
    assert marts(run) == rebuilt(run)

    # Nothing has changed.
    before = run.warehouse._listed(incremental.STATES.name)
    assert incremental.refresh(run) == {"matches": 0} and run.warehouse._listed(incremental.STATES.name) == before

    # A folded match turns out longer, another one's length is no longer known, a third was no match yet.
    for match, duration in (("M7", 4000), ("M8", None), ("M11", 900)):
        run.warehouse.update(schemas.FACT_MATCH.name, {"game_duration": F.lit(duration)}, {"match_id": match})
    assert incremental.refresh(run)["matches"] == 3
    assert marts(run) == rebuilt(run)


def test_only_the_partitions_of_the_changed_matches_are_read(spark, tmp_path, monkeypatch):
    run = new_run(spark, tmp_path, "plan")
    load(run, spark, range(1, 80))
    follow(run, spark, range(1, 9))
    incremental.fold(run.warehouse)
    load(run, spark, [200])
    ids = spark.createDataFrame([("M200",)], "match_id string")
    key, n = run.warehouse._buckets_of(schemas.FACT_STATS.name)
    touched = run.warehouse._touched(ids, key, n)
    read = {}
    rows_of = VersionedWarehouse.rows_of

    def seen(self, table, keys):
        df = rows_of(self, table, keys)
        read.setdefault(table, []).extend(f for f in df.inputFiles() if f"{BUCKET}=" in f)
        return df

    whole = []
    plain = VersionedWarehouse.read
    monkeypatch.setattr(VersionedWarehouse, "rows_of", seen)
    monkeypatch.setattr(VersionedWarehouse, "read", lambda self, table: whole.append(table) or plain(self, table))
    assert incremental.fold(run.warehouse, ids) == 1
    assert schemas.FACT_STATS.name not in whole and schemas.FACT_MATCH.name not in whole
    for table in (schemas.FACT_STATS.name, schemas.FACT_MATCH.name):
        assert len(touched) == 1 and read[table] and all(f"{BUCKET}={touched[0]}/" in f for f in read[table])


def test_a_lost_run_is_made_up_for(spark, tmp_path, monkeypatch):
    """Lost before the states are published: nothing is folded. Lost after: the marts are filled by the next run."""
    run = new_run(spark, tmp_path, "lost")
    load(run, spark, range(1, 30))
    follow(run, spark, range(1, 9))
    publish = VersionedWarehouse._publish

    def lose(self, table, *rest):
        if table == incremental.STATES.name and self.exists(table):
            raise RuntimeError("lost")
        return publish(self, table, *rest)

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(VersionedWarehouse, "_publish", lose)
        incremental.refresh(run)
    assert incremental.fold(run.warehouse) > 0
    later = jobs.Run(run.warehouse, run.job_id, NOW + dt.timedelta(days=1))
    assert incremental.refresh(later)["matches"] == 0
    assert marts(run) == rebuilt(run)


def test_striking_off_writes_one_partition_again(spark, tmp_path):
    """The groups to update are noted in one partition, so that the states of the others stay as they are."""
    run = new_run(spark, tmp_path, "noted")
    load(run, spark, range(1, 30))
    follow(run, spark, range(1, 9))
    incremental.fold(run.warehouse)
    noted = incremental.TODO_NAME, incremental.TODO_CHAMPION
    stored = run.warehouse._stored(incremental.STATES.name)
    assert stored.where(F.col("kind").isin(*noted)).select(BUCKET).distinct().count() == 1
    folded = run.warehouse._listed(incremental.STATES.name)[-1]
    incremental._fill(run)
    left = {g.table: g for g in run.warehouse._listed(incremental.STATES.name)}
    assert len(folded.live) == 4 and len(left[folded.table].live) == 3
    assert run.warehouse.read(incremental.STATES.name).where(F.col("kind").isin(*noted)).isEmpty()
    assert marts(run) == rebuilt(run)


def test_rows_are_shuffled_for_new_states_also_of_a_crowded_player(spark, monkeypatch):
    """States are made where a player's rows are; those of a player with most of the rows are combined before."""
    monkeypatch.setattr(K, "CROWD", 5)
    stats = statistics(spark, 2, range(1, 20)).withColumn("puuid", F.when(F.col("kills") > 2, "P0").otherwise(F.col("puuid")))
    stats = stats.withColumn("game_duration", F.lit(600).cast("bigint"))
    crowd = K.crowded(stats)
    assert crowd
    made = incremental._of_players(stats, crowd)
    whole = K.kpi_states(stats, ["puuid", *K.CHAMPION])
    assert sorted(map(tuple, rounded(made, 5).collect())) == sorted(map(tuple, rounded(whole, 5).collect()))
    alone = incremental._of_players(stats, [])._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [puuid" in alone


def test_states_are_shuffled_as_rows_only_and_replaced_versions_go(spark, tmp_path):
    """New states are made by the tasks that write them; a tidy run leaves one version of the mart and no written rows."""
    from matchmill.session import _scratch_dir

    stats = statistics(spark, 2, range(1, 20)).withColumn("game_duration", F.lit(600).cast("bigint"))
    made = incremental._of_players(incremental._placed(stats, 4), [], (BUCKET, "_piece"))
    assert made._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    whole = K.kpi_states(stats, ["puuid", *K.CHAMPION])
    assert sorted(map(tuple, rounded(made, 5).collect())) == sorted(map(tuple, rounded(whole, 5).collect()))

    def written():
        root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_dir(spark))
        found = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(root)
        return {f.getPath().getName() for f in found if f.getPath().getName().startswith(("brought-", "all-rows-"))}

    before = written()  # what the lost run of another test has left
    run = new_run(spark, tmp_path, "tidy")
    run = jobs.Run(run.warehouse, run.job_id, run.time, tidy=True)
    follow(run, spark, range(0, 12))
    for some in (range(1, 20), range(20, 30)):
        load(run, spark, some)
        incremental.refresh(run)
    assert marts(run) == rebuilt(run)
    for table in (incremental.STATES, schemas.MART_PLAYER_CHAMPION):
        schema, name = run.warehouse._split(table.name)
        assert len(run.warehouse._folders(schema, name)) == len(run.warehouse._listed(table.name))
    assert written() <= before
