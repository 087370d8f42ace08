"""JSON of unknown shape, keyed random columns, range joins and joins that compare all pairs."""

import math
import struct

import pytest
import xxhash
from matchmill.functions import keyed
from matchmill.operators import joins, nested
from matchmill.operators.extract import Between, Join, extract
from pyspark.sql import functions as F
from tests.conftest import rows


def flat(spark, texts):
    return nested.flatten_json(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, payload string"))


def test_union_of_all_keys(spark):
    df = flat(spark, ['{"a":{"b":1,"c c":"x"},"l":[1,2]}', '{"a":{"d":{"e":true}},"z.y":2.5}', '{"a":{"it\'s":null}}', "{}", "no json", None])
    assert set(df.columns) == {"n", "a.b", "a.c c", "a.d.e", "a.it's", "l", "z.y"}
    got = {r["n"]: r.asDict() for r in df.collect()}
    assert got[0]["a.b"] == 1 and got[0]["a.c c"] == "x" and got[0]["l"] == [1, 2] and got[0]["a.d.e"] is None
    assert got[1]["a.d.e"] is True and float(got[1]["z.y"]) == 2.5 and got[1]["l"] is None
    assert all(v is None for k, v in got[4].items() if k != "n") and len(got) == 6


def test_values_of_several_types_are_texts(spark):
    df = flat(spark, ['{"v":1,"o":{"x":1}}', '{"v":"t","o":7}', '{"v":{"w":2}}', "[1]", '"text"'])
    assert set(df.columns) == {"n", "v", "o"}
    assert sorted(rows(df.select("v", "o")), key=repr) == sorted([("1", '{"x":1}'), ('"t"', "7"), ('{"w":2}', None), (None, None), (None, None)], key=repr)
    assert flat(spark, ["1", None]).columns == ["n"] and flat(spark, []).columns == ["n"]


def plain_uniform(seed, key, stream=0):
    h = 42
    for value in (seed, stream, key):
        h = xxhash.xxh64_intdigest(struct.pack("<q", value), h)
    return (h >> 11) * 2.0**-53


def test_keyed_random_columns(spark):
    """The values of plain Python, whatever the partitions and the order."""
    keys = [0, 1, -5, 2**62, *range(100, 3100)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    columns = [keyed.keyed_uniform(7, "k"), keyed.keyed_normal(7, "k"), keyed.keyed_whole(7, -2, 3, "k")]
    one = df.repartition(1).select("k", *columns).collect()
    many = df.repartition(13).orderBy(F.desc("k")).select("k", *columns).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))
    for key, uniform, normal, whole in map(tuple, one):
        assert uniform == plain_uniform(7, key) and whole == -2 + math.floor(uniform * 6)
        radius = math.sqrt(-2 * math.log(1 - plain_uniform(7, key, 1_000_001)))
        assert math.isclose(normal, radius * math.cos(2 * math.pi * plain_uniform(7, key, 1_000_002)), abs_tol=1e-12)
    values = [r[1] for r in one]
    assert abs(sum(values) / len(values) - 0.5) < 0.02 and len(set(values)) == len(values)
    normals = [r[2] for r in one]
    assert abs(sum(normals) / len(normals)) < 0.06 and abs(sum(n * n for n in normals) / len(normals) - 1) < 0.1


@pytest.mark.parametrize("kind", ["inner", "left"])
def test_range_join_against_all_pairs(spark, kind):
    """Points, intervals of any length, bounds, none and nulls; repeated rows on both sides."""
    import random

    draw = random.Random(4)
    values = [draw.choice([draw.uniform(-50, 50), float(draw.randrange(-5, 6)), draw.uniform(-1e9, 1e9)]) for _ in range(150)] + [0.0, 0.0, None, 1e300]
    ranges = [(a, a + draw.choice([0, 0, 1, 0.001, 3, 17.5, 1e6, -2])) for a in (float(draw.randrange(-9, 9)) for _ in range(120))]
    ranges += [(None, 1.0), (1.0, None), (-1e12, 1e12), (0.0, 0.0), (0.0, 0.0)]
    left = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    right = spark.createDataFrame([(j, a, b) for j, (a, b) in enumerate(ranges)], "j int, a double, b double")
    found = joins.range_join(left, right, F.col("v"), F.col("a"), F.col("b"), kind)
    assert found.columns == ["i", "v", "j", "a", "b"] and joins.compares_all(found) == 0
    want = [(i, j) for i, v in enumerate(values) for j, (a, b) in enumerate(ranges) if None not in (v, a, b) and a <= v <= b]
    if kind == "left":
        want += [(i, None) for i in range(len(values)) if i not in {i for i, _ in want}]
    assert rows(found.select("i", "j")) == sorted(want, key=repr)
    assert joins.range_join(left, right.limit(0), F.col("v"), F.col("a"), F.col("b"), kind).count() == (len(values) if kind == "left" else 0)


@pytest.mark.parametrize("kind", ["inner", "left"])
def test_a_crowded_bin_is_dealt_over_tasks(spark, monkeypatch, kind):
    """All rows of both sides in one bin: its pairs are dealt over many keys, and each is found once."""
    monkeypatch.setattr(joins, "PIECE", 16)
    left = spark.range(200).select(F.col("id").cast("int").alias("i"), (F.col("id") % 4 + 0.25).alias("v"))
    left = left.unionByName(left.limit(3)).unionByName(spark.createDataFrame([(-1, 99.0)], "i int, v double"))
    right = spark.range(60).select(F.col("id").cast("int").alias("j"), F.lit(0.0).alias("a"), (F.lit(5.0) + F.col("id") % 3).alias("b"))
    found = joins.range_join(left, right, F.col("v"), F.col("a"), F.col("b"), kind)
    assert found.count() == 203 * 60 + (kind == "left")
    assert found.where("j IS NOT NULL").groupBy("i", "j").count().where("count > IF(i < 3, 2, 1)").count() == 0
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "_left_piece" in text and "REPARTITION_BY_NUM" in text


def test_joins_that_compare_all_pairs_are_refused(spark):
    a = spark.range(5).selectExpr("id AS k", "id AS v")
    b = spark.range(5).selectExpr("id AS j", "id AS w", "id + 1 AS x")
    for on in ("t_main.k < r.j", "t_main.k = 1 AND t_main.k < r.j", "t_main.k = t_main.v AND t_main.k < r.j", "r.j = r.w"):
        with pytest.raises(ValueError):
            extract(a, ["t_main.k", "r.j"], joins=[Join(b, on, "r")])
    for on in ("t_main.k = r.j OR t_main.v = 1", "t_main.k = t_main.v", "t_main.k < r.j"):
        with pytest.raises(ValueError):
            extract(a, ["t_main.k", "r.j"], joins=[Join(b, on, "r", "FULL")])
    full = extract(a, ["t_main.k", "r.j", "r.w"], joins=[Join(b.where("j > 2"), "r.j = t_main.k and t_main.v == r.w", "r", "FULL")])
    assert rows(full) == rows(a.join(b.where("j > 2"), (a.k == b.j) & (a.v == b.w), "full_outer").select("k", "j", "w"))
    kept = extract(a, ["t_main.k", "r.j"], joins=[Join(b, Between("v", "w", "x"), "r")], where={"t_main.k": 3})
    assert rows(kept) == [(3, 2), (3, 3)]
