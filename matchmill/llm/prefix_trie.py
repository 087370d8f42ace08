"""The trie of all conversations' prefixes, grown as adaptive radix trees over turn ids.

A turn's id is 16 big-endian bytes (SHA-256 of role and text), a conversation the string of its
turns' ids. Rows are sorted over all tasks by that string, and each task grows radix trees over runs
of neighbours: nodes of 4, 16, 48 or 256 children that are exchanged for larger ones as they fill,
with single paths compressed. A node of the trie stands at every turn-aligned byte depth, within a
compressed path too; branches inside an id are none.

Nodes off the first and last path of a tree are complete. The others are partial and added up by
their prefix; what two neighbouring trees share was counted twice, which the common prefix of the
last string of one and the first of the next tells (within a task at once, between tasks from a
row for each task). So no task needs all conversations of a prefix, be it the root's.

Conversations are cut into segments of a bounded number of turns, sorted by the prefix before them,
so that no row holds a whole conversation. What lies below a segment's end comes from a first pass
over the later segments only.
"""

from __future__ import annotations

import hashlib
import struct
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchmill.operators.ranking import numbered_in_groups
from matchmill.session import cut_lineage

#: Bytes of a turn's id.
WIDTH = 16


@dataclass(frozen=True)
class Sizes:
    """What is held at a time, which changes no result: turns of a segment, strings and bytes of a tree, conv_ids of a piece."""

    segment: int = 1024
    keys: int = 20_000
    key_bytes: int = 4 << 20
    ids: int = 1 << 16


DEFAULT = Sizes()


# The radix tree.


class Node:
    """``path``: the compressed bytes after the edge; ``value``: what is stored for the string that ends here."""

    __slots__ = ("path", "value")
    room = 0

    def __init__(self, path: bytes, value: int = -1):
        self.path, self.value = path, value

    def grown(self) -> Node:
        """The same node with more room."""
        larger = LARGER[type(self)](self.path, self.value)
        for byte, child in self.children():
            larger.put(byte, child)
        return larger


class Sorted(Node):
    """Edges in order beside their children."""

    __slots__ = ("edges", "below")

    def __init__(self, path: bytes, value: int = -1):
        super().__init__(path, value)
        self.edges, self.below = bytearray(), []

    def get(self, byte: int) -> Node | None:
        at = self.edges.find(byte)
        return self.below[at] if at >= 0 else None

    def full(self) -> bool:
        return len(self.below) >= self.room

    def put(self, byte: int, child: Node) -> None:
        at = bisect_left(self.edges, byte)
        if at < len(self.edges) and self.edges[at] == byte:
            self.below[at] = child
        else:
            self.edges.insert(at, byte)
            self.below.insert(at, child)

    def children(self) -> Iterator[tuple[int, Node]]:
        return zip(self.edges, self.below, strict=True)


class Node4(Sorted):
    __slots__ = ()
    room = 4


class Node16(Sorted):
    __slots__ = ()
    room = 16


class Node48(Node):
    """A slot for each byte, and the children in the order they came."""

    __slots__ = ("slots", "below")
    room = 48

    def __init__(self, path: bytes, value: int = -1):
        super().__init__(path, value)
        self.slots, self.below = bytearray(b"\xff" * 256), []

    def get(self, byte: int) -> Node | None:
        slot = self.slots[byte]
        return self.below[slot] if slot != 255 else None

    def full(self) -> bool:
        return len(self.below) >= self.room

    def put(self, byte: int, child: Node) -> None:
        slot = self.slots[byte]
        if slot != 255:
            self.below[slot] = child
        else:
            self.slots[byte] = len(self.below)
            self.below.append(child)

    def children(self) -> Iterator[tuple[int, Node]]:
        return ((byte, self.below[slot]) for byte, slot in enumerate(self.slots) if slot != 255)


class Node256(Node):
    """A child or none for each byte."""

    __slots__ = ("below",)
    room = 256

    def __init__(self, path: bytes, value: int = -1):
        super().__init__(path, value)
        self.below: list[Node | None] = [None] * 256

    def get(self, byte: int) -> Node | None:
        return self.below[byte]

    def full(self) -> bool:
        return False

    def put(self, byte: int, child: Node) -> None:
        self.below[byte] = child

    def children(self) -> Iterator[tuple[int, Node]]:
        return ((byte, child) for byte, child in enumerate(self.below) if child is not None)


LARGER = {Node4: Node16, Node16: Node48, Node48: Node256}


class RadixTree:
    """Distinct byte strings, any of which may begin another, each with a number."""

    def __init__(self):
        self.root: Node = Node4(b"")

    def insert(self, key: bytes, value: int) -> None:
        above, edge, node, at = None, 0, self.root, 0
        while True:
            path = node.path
            if not key.startswith(path, at):
                # The string leaves the compressed path: a node is put in where it does.
                rest = key[at : at + len(path)]
                same = next((i for i, (a, b) in enumerate(zip(path, rest, strict=False)) if a != b), len(rest))
                fork = Node4(path[:same])
                node.path = path[same + 1 :]
                fork.put(path[same], node)
                above.put(edge, fork)
                if at + same == len(key):
                    fork.value = value
                else:
                    fork.put(key[at + same], Node4(key[at + same + 1 :], value))
                return
            at += len(path)
            if at == len(key):
                node.value = value
                return
            child = node.get(key[at])
            if child is None:
                if node.full():
                    node = node.grown()
                    if above is None:
                        self.root = node
                    else:
                        above.put(edge, node)
                node.put(key[at], Node4(key[at + 1 :], value))
                return
            above, edge, node, at = node, key[at], child, at + 1


# Trees to nodes of the trie.


@dataclass
class Run:
    """Rows with the same string in one task: the conversations that end with it, or go on after a full segment."""

    key: bytes
    chars: list[int]
    first: int
    following: tuple[int, int] | None
    n: int = 0
    leaves: int = 0
    saved: int = 0
    ids: list[int] = field(default_factory=list)
    pieces: int = 0


@dataclass(frozen=True)
class Group:
    """Strings that follow the same prefix: number of the segment and hash of what is before it."""

    segment: int
    hash1: int
    hash2: int
    turns: int

    def packed(self) -> bytes:
        return struct.pack(">qqq", self.segment, self.hash1, self.hash2)

    def name(self, run_key: bytes, end: int, following: tuple[int, int] | None) -> bytes:
        """What names the node after ``end`` bytes of a string; a segment's end is the next one's start."""
        if end == self.turns * WIDTH:
            return _digest(struct.pack(">qqq", self.segment + 1, *following))
        return _digest(self.packed() + run_key[:end])


def _digest(of: bytes) -> bytes:
    return hashlib.blake2b(of, digest_size=16).digest()


#: Kinds of rows that a task gives: complete nodes, below complete or partial ones; partial nodes;
#: pieces of lists of conv_ids; the task's first and last string.
NODE, UNDER_PARTIAL, PARTIAL, PIECE, EDGE = range(5)

_COLUMNS = {
    "kind": pa.int8(), "name": pa.binary(), "parent": pa.binary(), "conv_id": pa.int64(), "depth": pa.int64(),
    "parent_conv_id": pa.int64(), "chars": pa.int64(), "n_convs": pa.int64(), "n_children": pa.int64(), "n_leaves": pa.int64(),
    "saved": pa.int64(), "ends": pa.string(), "part": pa.int32(), "piece": pa.int64(), "ids": pa.binary(),
    "segment": pa.int64(), "hash1": pa.int64(), "hash2": pa.int64(), "first_key": pa.binary(), "last_key": pa.binary(),
    "last_chars": pa.list_(pa.int64()), "next1": pa.int64(), "next2": pa.int64(),
}
_SPARK = {pa.int8(): "byte", pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary", pa.string(): "string", pa.list_(pa.int64()): "array<long>"}
_SCHEMA = ", ".join(f"{c} {_SPARK[t]}" for c, t in _COLUMNS.items())


class _Rows:
    """Rows of the output, gathered by column."""

    def __init__(self):
        self.held: list[dict] = []

    def add(self, kind: int, **values) -> None:
        self.held.append({"kind": kind, **values})

    def batch(self) -> pa.RecordBatch:
        held, self.held = self.held, []
        return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in held], t) for c, t in _COLUMNS.items()], names=list(_COLUMNS))


def _ends(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


_NO_ENDS = _ends([])


def _emit(out: _Rows, group: Group, runs: list[Run], left_open: bool, right_open: bool) -> None:
    """The nodes of the trie for one tree over ``runs``: neighbours in order, of one group."""
    tree = RadixTree()
    for number, run in enumerate(runs):
        tree.insert(run.key, number)
    first, last = 0 if left_open else -1, len(runs) - 1 if right_open else -1

    # Bottom up: what a radix node holds, and the nodes of the trie without a parent so far.
    nodes: list[list] = []  # end, n, least, children, leaves, saved, own run or None, some run, open, parent
    done: dict[int, tuple] = {}
    stack = [(tree.root, 0, len(tree.root.path), False)]
    while stack:
        node, start, end, seen = stack.pop()
        if not seen:
            stack.append((node, start, end, True))
            stack += [(child, end, end + 1 + len(child.path), False) for _, child in node.children()]
            continue
        n, least, leaves, saved, some, spans, tops = 0, None, 0, 0, None, False, []
        for _, child in node.children():
            c_n, c_least, c_leaves, c_saved, c_some, c_spans, c_tops = done.pop(id(child))
            n, leaves, saved, spans = n + c_n, leaves + c_leaves, saved + c_saved, spans or c_spans
            least, some = c_least if least is None else min(least, c_least), c_some
            tops = tops + c_tops if tops else c_tops
        own = runs[node.value] if node.value >= 0 else None
        if own is not None:
            n, some, spans = n + own.n, own, spans or node.value in (first, last)
            least = own.first if least is None else min(least, own.first)
            leaves += own.leaves if own.following else int(not tops)
            saved += own.saved
        for at in range(end - end % WIDTH, start if node is not tree.root else -1, -WIDTH):
            if at:
                saved += (n - 1) * some.chars[at // WIDTH - 1]
            whole = spans or at in (0, group.turns * WIDTH) or (own is not None and own.pieces > 0)
            for top in tops:
                nodes[top][9] = len(nodes)
            nodes.append([at, n, least, len(tops), leaves, saved, own, some, whole, None])
            tops, own = [len(nodes) - 1], None
        done[id(node)] = (n, least, leaves, saved, some, spans, tops)

    for at, n, least, children, leaves, saved, own, some, partial, parent in nodes:
        row = {"conv_id": least, "depth": group.segment * group.turns + at // WIDTH, "chars": some.chars[at // WIDTH - 1] if at else 0}
        row |= {"n_convs": n, "n_children": children, "n_leaves": leaves, "saved": saved}
        if own is not None and not own.pieces and not own.following:
            row["ends"] = _ends(own.ids)
        above = nodes[parent] if parent is not None else None
        if partial:
            if not at and group.segment:
                # The node is the end of the segment before, where it is counted.
                row |= {"n_convs": 0, "n_leaves": 0, "saved": 0}
            row["name"] = group.name(some.key, at, some.following)
        else:
            row.setdefault("ends", _NO_ENDS)
        if above is not None and above[8]:
            row["parent"] = group.name(some.key, above[0], some.following)
        elif above is not None:
            row["parent_conv_id"] = above[2]
        out.add(PARTIAL if partial else UNDER_PARTIAL if "parent" in row else NODE, **row)


def _shared(out: _Rows, group: Group, last: bytes, chars: list[int], first: bytes, following: tuple[int, int] | None) -> None:
    """Take off what two neighbouring trees count twice: the nodes on the common prefix of ``last`` and ``first``."""
    same = next((i for i, (a, b) in enumerate(zip(last, first, strict=False)) if a != b), min(len(last), len(first))) // WIDTH
    # The end of the last string is a leaf of its tree, but none if the next string goes on from it or ends there too.
    leaf = -1 if same * WIDTH == len(last) and not following else 0
    saved = 0
    for depth in range(same, -1, -1):
        saved += chars[depth - 1] if depth else 0
        counted = bool(depth or not group.segment)
        out.add(
            PARTIAL,
            name=group.name(last, depth * WIDTH, following),
            depth=group.segment * group.turns + depth,
            n_convs=0,
            n_children=-int(depth < same),
            n_leaves=leaf * counted,
            saved=saved * counted,
        )


def _grow(batches: Iterator[pa.RecordBatch], sizes: Sizes) -> Iterator[pa.RecordBatch]:
    """Rows of the output for one sorted partition.

    Held are the strings of one tree, and of a run of equal ones no more ids than a piece has.
    """
    part = TaskContext.get().partitionId()
    out, runs, size = _Rows(), [], 0
    group, before, begun, edge = None, None, False, {}
    run: Run | None = None

    def piece(run: Run) -> None:
        name = group.name(run.key, len(run.key), run.following)
        out.add(PIECE, name=name, part=part, piece=run.pieces, ids=np.array(run.ids, ">i8").tobytes())
        run.ids, run.pieces = [], run.pieces + 1

    def close_run(at_end: bool) -> None:
        # The first and last string of a task may go on next door.
        if run.ids and (run.pieces or at_end or not (begun or runs)):
            piece(run)
        runs.append(run)

    def close_tree(goes_on: bool) -> None:
        nonlocal runs, size, before, begun
        if before is not None:
            _shared(out, group, before.key, before.chars, runs[0].key, before.following)
        _emit(out, group, runs, before is not None or not begun, goes_on)
        before, begun = runs[-1] if goes_on else None, True
        runs, size = [], 0

    for batch in batches:
        for row in batch.to_pylist():
            here = Group(row["segment"], row["hash1"], row["hash2"], sizes.segment)
            if run is None or here != group or row["key"] != run.key:
                if run is not None:
                    close_run(False)
                    if here != group:
                        close_tree(False)
                    elif len(runs) >= sizes.keys or size >= sizes.key_bytes:
                        close_tree(True)
                else:
                    edge = {"segment": here.segment, "hash1": here.hash1, "hash2": here.hash2, "first_key": row["key"]}
                if len(out.held) > 50_000:
                    yield out.batch()
                group = here
                following = (row["next1"], row["next2"]) if row["next1"] is not None else None
                run = Run(row["key"], row["chars"], row["conv_id"], following)
                size += 2 * len(run.key)
            run.n += 1
            run.leaves += row["leaves"] or 0
            run.saved += row["saved"] or 0
            if run.following is None:
                run.ids.append(row["conv_id"])
                if len(run.ids) >= sizes.ids:
                    piece(run)
    if run is not None:
        close_run(True)
        close_tree(True)
        first = {k: edge.pop(k) for k in ("segment", "hash1", "hash2", "first_key")}
        following = run.following or (None, None)
        # A row for either end, as they may lie in different groups.
        out.add(EDGE, part=part, piece=0, **first)
        last = {"segment": group.segment, "hash1": group.hash1, "hash2": group.hash2}
        out.add(EDGE, part=part, piece=1, last_key=run.key, last_chars=run.chars, next1=following[0], next2=following[1], **last)
        yield out.batch()


def _between(batches: Iterator[pa.RecordBatch], sizes: Sizes) -> Iterator[pa.RecordBatch]:
    """What neighbouring tasks count twice, from the last string of one and the first of the next."""
    for batch in batches:
        out = _Rows()
        for row in batch.to_pylist():
            following = (row["next1"], row["next2"]) if row["next1"] is not None else None
            group = Group(row["segment"], row["hash1"], row["hash2"], sizes.segment)
            _shared(out, group, row["last_key"], row["last_chars"], row["first_key"], following)
        if out.held:
            yield out.batch()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each list of conv_ids whose pieces come in order."""
    now, state = None, None
    for batch in batches:
        names, found = [], []
        for name, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            told = ",".join(map(str, np.frombuffer(ids, ">i8").tolist())).encode()
            if name != now:
                if now is not None:
                    names.append(now)
                    found.append(state.hexdigest())
                now, state = name, hashlib.sha256(told)
            else:
                state.update(b"," + told)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(found, pa.string())], names=["name", "listed"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["name", "listed"])


def _trees(rows: DataFrame, sizes: Sizes) -> tuple[DataFrame, DataFrame]:
    """The tasks' rows, and the partial nodes added up with their lists' hashes."""
    order = ["segment", "hash1", "hash2", "key", "conv_id"]
    columns = [*order, "chars", "next1", "next2", "leaves", "saved"]
    placed = rows.select(*columns).repartitionByRange(*order).sortWithinPartitions(*order)
    told = cut_lineage(placed.mapInArrow(partial(_grow, sizes=sizes), _SCHEMA), "trees")

    # Two rows for each task.
    in_order = Window.orderBy("part", "piece")
    ends = told.where(F.col("kind") == EDGE).select("part", "piece", "segment", "hash1", "hash2", "first_key", "last_key", "last_chars", "next1", "next2")
    nexts = [F.lead(c).over(in_order).alias(f"of_{c}") for c in ("segment", "hash1", "hash2", "first_key")]
    met = ends.select("*", *nexts).where("piece = 1 AND of_segment = segment AND of_hash1 = hash1 AND of_hash2 = hash2")
    met = met.drop("first_key").withColumnRenamed("of_first_key", "first_key")

    parts = told.where(F.col("kind") == PARTIAL).union(cut_lineage(met, "between").mapInArrow(partial(_between, sizes=sizes), _SCHEMA))
    added = parts.groupBy("name").agg(
        F.max("parent").alias("parent"),
        # A long list of conv_ids makes a node partial under a complete one, whose name is not needed.
        F.max("parent_conv_id").alias("parent_conv_id"),
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.max("chars").alias("chars"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
        F.max("ends").alias("ends"),
    )
    pieces = told.where(F.col("kind") == PIECE).select("name", "part", "piece", "ids")
    pieces = pieces.repartition("name").sortWithinPartitions("name", "part", "piece")
    listed = pieces.mapInArrow(_hashed, "name binary, listed string")
    added = added.join(listed, "name", "left").withColumn("ends", F.coalesce("listed", "ends", F.lit(_NO_ENDS))).drop("listed")
    return told, cut_lineage(added, "partial")


# Conversations to strings.


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), id, chars: the turns in order.

    Turns are ordered by ``turn``, null first, those with the same number by their ids. A null role or
    text is empty. Rows without a conv_id are left out. A conversation of any length is numbered by
    many tasks.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    told = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.substring(F.unhex(F.sha2(told, 256)), 1, WIDTH).alias("id"),
        F.char_length(text).cast("long").alias("chars"),
    )
    numbered = numbered_in_groups(turns, ["conv_id"], ["turn", "id"], "pos")
    return numbered.select("conv_id", (F.col("pos") - 1).alias("pos"), "id", "chars")


def _segments(turns: DataFrame, members: DataFrame, size: int) -> DataFrame:
    """A row for each segment of each conversation: its string, its turns' code points, hashes of what is before and after.

    The last one has fewer turns than a full segment, maybe none.
    """
    number = F.floor(F.col("pos") / size).cast("long")
    turn = F.struct((F.col("pos") % size).alias("at"), "id", "chars")
    cut = turns.groupBy("conv_id", number.alias("segment")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns"),
        F.bit_xor(F.xxhash64("pos", "id")).alias("x1"),
        F.bit_xor(F.xxhash64(F.lit("second"), "pos", "id")).alias("x2"),
    )
    cut = cut.select(
        "conv_id",
        "segment",
        F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), "")).alias("key"),
        F.col("turns.chars").alias("chars"),
        "x1",
        "x2",
    )
    cut = cut_lineage(cut, "segments")
    lengths = cut.groupBy("conv_id").agg(F.sum(F.size("chars")).alias("n"))
    lengths = cut_lineage(members.select("conv_id").distinct().join(lengths, "conv_id", "left").na.fill({"n": 0}), "lengths")
    empty = lengths.where(F.col("n") % size == 0).select(
        "conv_id", (F.col("n") / size).cast("long").alias("segment"), F.expr("X''").alias("key"),
        F.expr("cast(array() as array<long>)").alias("chars"), F.lit(0).cast("long").alias("x1"), F.lit(0).cast("long").alias("x2"),
    )
    rows = cut.union(empty)
    long = lengths.where(F.col("n") >= size).select("conv_id")
    narrow = rows.select("conv_id", "segment", "x1", "x2").join(long, "conv_id")
    upto = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = narrow.select(
        "conv_id", "segment", *[F.coalesce(F.bit_xor(x).over(upto), F.lit(0)).alias(f"hash{x[1]}") for x in ("x1", "x2")]
    )
    starts = cut_lineage(starts, "starts")
    rows = rows.join(starts, ["conv_id", "segment"], "left").na.fill({"hash1": 0, "hash2": 0})
    full = F.size("chars") == size
    return cut_lineage(
        rows.select(
            "conv_id", "segment", "key", "chars", "hash1", "hash2",
            F.when(full, F.col("hash1").bitwiseXOR(F.col("x1"))).alias("next1"),
            F.when(full, F.col("hash2").bitwiseXOR(F.col("x2"))).alias("next2"),
        ),
        "strings",
    )


def _below(rows: DataFrame, sizes: Sizes) -> DataFrame:
    """conv_id, segment, leaves, saved for full segments: what the nodes after it add that the conversation stands for.

    A node is told of by its smallest member, and whatever holds the node holds that one.
    """
    told, added = _trees(rows.where("segment > 0").withColumn("leaves", F.lit(0)).withColumn("saved", F.lit(0)), sizes)
    columns = ["conv_id", "depth", "chars", "n_convs", "n_children"]
    nodes = told.where(F.col("kind").isin(NODE, UNDER_PARTIAL)).select(columns).union(added.select(columns))
    depth = F.col("depth")
    leaves = nodes.where("n_children = 0").select("conv_id", (F.floor(depth / sizes.segment) - 1).alias("segment"), F.lit(1).alias("leaves"), F.lit(0).alias("saved"))
    saved = nodes.where(F.col("n_convs") > 1).select(
        "conv_id", (F.floor((depth - 1) / sizes.segment) - 1).alias("segment"), F.lit(0).alias("leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")
    )
    full = rows.where("next1 IS NOT NULL").select("conv_id", "segment", F.lit(0).alias("leaves"), F.lit(0).alias("saved"))
    sums = full.union(leaves).union(saved).groupBy("conv_id", "segment").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    onwards = Window.partitionBy("conv_id").orderBy(F.col("segment").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cut_lineage(sums.select("conv_id", "segment", *[F.sum(c).over(onwards).alias(c) for c in ("leaves", "saved")]), "below")


def prefix_trie(turns: DataFrame, members: DataFrame, sizes: Sizes = DEFAULT) -> DataFrame:
    """The nodes of the trie over ``turns`` (conv_id, pos, id, chars) of the conversations ``members`` (conv_id).

    conv_id (the smallest member), depth, parent_conv_id (null for the root), n_convs, n_children,
    n_leaves (childless nodes of the subtree, itself included), saved_tokens (over the subtree, each
    node's members but one times the code points of its last turn), ends_sha256 (of the decimal
    conv_ids that end there, ascending, joined by commas). Positions run from 0 without gaps.
    Members without turns end at the root; no members give no rows.
    """
    rows = _segments(turns, members, sizes.segment)
    if rows.where("segment > 0").limit(1).count():
        rows = rows.join(_below(rows, sizes), ["conv_id", "segment"], "left")
    else:
        rows = rows.withColumn("leaves", F.lit(0)).withColumn("saved", F.lit(0))
    told, added = _trees(rows, sizes)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    above = added.select(F.col("name").alias("parent"), F.col("conv_id").alias("of_parent"))
    nodes = told.where(F.col("kind") == NODE).select(columns)
    under = told.where(F.col("kind") == UNDER_PARTIAL).drop("parent_conv_id").join(above, "parent").withColumnRenamed("of_parent", "parent_conv_id").select(columns)
    parts = added.join(above, "parent", "left").withColumn("parent_conv_id", F.coalesce("of_parent", "parent_conv_id")).select(columns)
    found = nodes.union(under).union(parts)
    return found.withColumnsRenamed({"saved": "saved_tokens", "ends": "ends_sha256"})
