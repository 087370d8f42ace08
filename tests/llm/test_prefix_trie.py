"""The trie against plain dictionaries, cut into segments, trees, pieces and tasks of any size."""

import hashlib
import random

import pytest
from matchmill.llm import prefix_trie, queries
from matchmill.llm.prefix_trie import Node4, Node16, Node48, Node256, RadixTree, Sizes
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn int, role string, text string"


def plain(paths):
    """The nodes over {conv_id: [(turn's id, code points), ...]}."""
    members, chars = {}, {(): 0}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            prefix = tuple(t for t, _ in turns[:d])
            members.setdefault(prefix, []).append(c)
            chars[prefix] = turns[d - 1][1] if d else 0
    ends = {}
    for c, turns in sorted(paths.items()):
        ends.setdefault(tuple(t for t, _ in turns), []).append(c)
    children, leaves, saved = (dict.fromkeys(members, 0) for _ in range(3))
    for prefix in sorted(members, key=len, reverse=True):
        leaves[prefix] += not children[prefix]
        saved[prefix] += (len(members[prefix]) - 1) * chars[prefix]
        if prefix:
            children[prefix[:-1]] += 1
            leaves[prefix[:-1]] += leaves[prefix]
            saved[prefix[:-1]] += saved[prefix]
    digest = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    return sorted(
        (
            (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], digest(ends.get(p, [])))
            for p, m in members.items()
        ),
        key=repr,
    )


def got(found):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert found.columns == names and all(t == "bigint" for _, t in found.dtypes[:-1])
    return sorted((tuple(r) for r in found.collect()), key=repr)


def conversations(seed):
    """Shared beginnings, prefixes of others, exact copies, long common stretches; texts of few words."""
    draw = random.Random(seed)
    turn = lambda: (draw.choice(["user", "assistant"]), draw.choice(["Hi", "Überall \U0001f600", "", "yes", "no", "why not"]))
    trunk = [turn() for _ in range(23)]
    held = {}
    for c in range(120):
        kind = draw.randrange(5)
        body = [turn() for _ in range(draw.randrange(0, 9))]
        if kind < 2:
            body = trunk[: draw.randrange(0, 24)] + body * (kind == 1)
        elif kind == 2 and held:
            body = list(held[draw.choice(list(held))])
        held[draw.randrange(10_000)] = body
    for c in range(20_000, 20_040):
        held[c] = trunk[:6]
    return held


@pytest.mark.parametrize("seed, sizes", [(1, Sizes()), (2, Sizes(3, 4, 1 << 20, 2)), (3, Sizes(6, 1000, 100, 5)), (4, Sizes(1, 3, 1 << 20, 1)), (5, Sizes(2, 1, 1, 3))])
def test_plain_tries(spark, settings, seed, sizes):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false" if seed % 2 else "true", spark__sql__execution__arrow__maxRecordsPerBatch="13")
    held = conversations(seed)
    ids = {}
    paths = {c: [(ids.setdefault(t, hashlib.sha256(repr(t).encode()).digest()[:16]), len(t[1])) for t in turns] for c, turns in held.items()}
    rows = [(c, pos, bytearray(i), n) for c, turns in paths.items() for pos, (i, n) in enumerate(turns)]
    turns = spark.createDataFrame(rows, "conv_id long, pos long, id binary, chars long").repartition(4)
    members = spark.createDataFrame([(c,) for c in paths], "conv_id long")
    assert got(prefix_trie.prefix_trie(turns, members, sizes)) == plain(paths)


def test_radix_tree_layouts():
    """All strings are found in order; nodes grow through all layouts; compressed paths split anywhere."""
    draw = random.Random(7)
    keys = {bytes(draw.choices(range(256), k=draw.choice([1, 2, 2, 3, 16]))) for _ in range(3000)} | {b"", b"abcdef", b"abc", b"abcdxy", b"ab"}
    order = list(keys)
    draw.shuffle(order)
    tree = RadixTree()
    for number, key in enumerate(order):
        tree.insert(key, number)
    found, kinds = [], set()

    def walk(node, before):
        kinds.add(type(node))
        if node.value >= 0:
            assert order[node.value] == before + node.path
            found.append(before + node.path)
        for byte, child in node.children():
            assert node.get(byte) is child
            walk(child, before + node.path + bytes([byte]))
        assert node.get(next((b for b in range(256) if b not in dict(node.children())), 0)) is None or len(list(node.children())) == 256

    walk(tree.root, b"")
    assert found == sorted(keys) and kinds == {Node4, Node16, Node48, Node256}


def crc(c):
    import zlib

    return zlib.crc32(str(c).encode()) % 6


def plain_query(rows):
    own = {}
    key = lambda r: (r[1] is not None, r[1] or 0, turn_id(r))
    for r in sorted((r for r in rows if r[0] is not None), key=key):
        own.setdefault(r[0], []).append((turn_id(r), len(r[3] or "")))
    return plain({c: own.get(c - c % 100, [])[: crc(c)] + turns[crc(c) :] for c, turns in own.items()})


def turn_id(r):
    role, text = r[2] or "", r[3] or ""
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def test_query(spark, tmp_path):
    """The registered query on copies, ties, nulls, a missing base, a base without turns, extra columns."""
    draw = random.Random(3)
    rows = [(c, t, draw.choice(["user", "assistant", None]), draw.choice(["a", "bb", None, "ç\U0001f600"])) for c in draw.sample(range(700), 200) for t in range(draw.randrange(1, 9))]
    rows += [(c, t, "user", f"turn {t}") for c in range(1000, 1040) for t in range(5)]
    rows += [(200, None, "user", "null first"), (200, None, "user", "null first"), (200, 1, "x", "tie"), (None, 1, "user", "no id"), (7, 3, "user", "long " * 50_000)]
    path = tmp_path / "conversations.parquet"
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "5 AS pos", "6 AS id", "7 AS segment", "8 AS h", "9 AS chars")
    df.repartition(3).write.parquet(str(path))
    assert got(queries.QUERIES["op11_prefix_trie"].run(spark, str(tmp_path))) == plain_query(rows)
    df.where(F.lit(False)).write.parquet(str(tmp_path / "none/conversations.parquet"))
    assert got(queries.QUERIES["op11_prefix_trie"].run(spark, str(tmp_path / "none"))) == []
