"""SimHash near-duplicates by multi-index hashing.

Documents get a fingerprint of 64 bits or a multiple. Equal fingerprints are one class. Each
segment of a class's fingerprint is a key of a table; a class looks up every key in a small Hamming
ball around its own segments, and what it finds is verified on the complete distance. Two
fingerprints whose distance is less than the sum of (radius + 1) over the segments always meet.

For a similarity of the texts there are many segments, of drawn bits, with a ball of one flip each, and the
distance only sorts what meets: near pairs are links, far ones are none, and those between are decided by their
sets of shingles. A class is shuffled by either half of a segment, not by every key of its ball: one flip leaves
one half as it is, so all that a ball can find is in one task, which looks the flips up there.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchmill.llm.components import components
from matchmill.session import cut_lineage

#: Shingles hashed at a time, which bounds the memory that a very long text takes.
CHUNK = 1 << 18

#: Members of a key that one group holds; further members make further groups of the same key,
#: each of which sees all who look the key up. So no group is cut short, and none is unbounded.
BLOCK = 512

#: Pairs compared at a time.
PAIRS = 1 << 18

#: Keys that a task makes, about: what it holds until its shuffle files are written.
KEY_ROWS = 1 << 20

#: Rows with one half of a segment that a task holds to look flips up among; of more, all are taken to meet.
HELD = 1 << 17

#: Rows that are handed to Spark at a time.
ARROW_ROWS = 1 << 14


@dataclass(frozen=True)
class Index:
    """How fingerprints are looked up: (first bit, bits, radius of the ball) of each segment.

    With a similarity, pairs beyond ``sure_distance`` are decided by the sets of their shingles, and segments are
    ``drawn``: an even number of bits each, with a ball of one flip.
    """

    words: int
    segments: tuple[tuple[int, int, int], ...]
    max_distance: int
    drawn: tuple[tuple[int, ...], ...] = ()
    sure_distance: int | None = None
    similarity: float | None = None

    @property
    def columns(self) -> list[str]:
        return [f"w{i}" for i in range(self.words)]

    @cached_property
    def samples(self) -> tuple[tuple[int, ...], ...]:
        """The drawn segments without one bit each: what meets agrees in one of these, and what agrees in one meets."""
        return tuple(bits[:i] + bits[i + 1 :] for bits in self.drawn for i in range(len(bits)))


#: Distance 2 over two halves: with one flip or none in the first, or none in the second, every
#: such pair meets.
EXACT_64 = Index(words=1, segments=((0, 32, 1), (32, 32, 0)), max_distance=2)



def _drawn(bits: int, size: int, number: int) -> tuple[tuple[int, ...], ...]:
    """So many segments of ``size`` bits: disjoint as far as there are ``bits``, then after another shuffle."""
    draw = random.Random(0)
    found = []
    while len(found) < number:
        order = draw.sample(range(bits), bits)
        found += [tuple(order[i : i + size]) for i in range(0, bits - size + 1, size)]
    return tuple(found[:number])


def similar_index(rows: int = 0) -> Index:
    """For a similarity of 0.8 among so many fingerprints.

    Sets that share 80 % of their shingles have a cosine of 0.89, so 15 % of the bits differ: 155 of
    1024, with a deviation of 11.5. There are as many segments of b bits, each with a ball of one flip, as pairs
    need of which 15 % of the bits differ, if bits are independent, to miss each other in all of them 23 times in
    10,000; more similar ones do less often. Four deviations to either side the distance decides alone. By
    chance a segment brings n documents together n * n * (b + 1) / 2**(b + 1) times; b is as large as keeps this in
    proportion to n.
    """
    size = min(40, max(32, (int(rows).bit_length() + 9) // 2 * 2))
    meets = 0.85**size + size * 0.15 * 0.85 ** (size - 1)
    number = math.ceil(math.log(0.0023) / math.log1p(-meets))
    return Index(words=16, segments=(), max_distance=201, drawn=_drawn(1024, size, number), sure_distance=109, similarity=0.8)


#: The index of up to 2**24 fingerprints; more take a wider one by themselves.
SIMILAR_1024 = similar_index()


def shingle_hashes(words: list[bytes], size: int, start: int, stop: int) -> np.ndarray:
    """XXH64 (seed 42) of the shingles that begin at words start to stop."""
    hashed = xxhash.xxh64_intdigest
    return np.array([hashed(b" ".join(words[i : i + size]), 42) for i in range(start, stop)], np.uint64)


def _mixed(h: np.ndarray, words: int) -> np.ndarray:
    """A row of 64-bit words for each hash: itself first, then remixed by keyed multiplications."""
    keys = np.array([0x9E3779B97F4A7C15 * w & (1 << 64) - 1 for w in range(words)], np.uint64)
    mixed = (h[:, None] ^ keys) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    mixed ^= mixed >> np.uint64(32)
    mixed[:, 0] = h
    return mixed


def simhash(text: str | None, size: int, n_words: int = 1, distinct: bool = False) -> list[int]:
    """The fingerprint of a text as signed 64-bit words.

    A-Z are lower-cased, words are runs of anything but ASCII white space, shingles are ``size``
    words, with repeats unless ``distinct``. A shorter text is one shingle; a null, empty or blank
    one has no bit set. A bit is set if more than half of the shingles' hashes have it.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return [0] * n_words
    n = max(1, len(words) - size + 1)
    chunks = (shingle_hashes(words, size, start, min(n, start + CHUNK)) for start in range(0, n, CHUNK))
    if distinct:
        chunks = [np.unique(np.concatenate(list(chunks)))]
        n = len(chunks[0])
    counts = np.zeros(n_words * 64, np.int64)
    for h in chunks:
        for at in range(0, len(h), 255):  # as many as a byte counts
            bits = np.unpackbits(_mixed(h[at : at + 255], n_words).astype(">u8").view(np.uint8), axis=1)
            counts += bits.sum(axis=0, dtype=np.uint8)
    return np.packbits(counts * 2 > n).view(">i8").tolist()


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The distinct shingles of a text as hashes, none if it has no words."""
    words = (text or "").encode().lower().split()
    return np.unique(shingle_hashes(words, size, 0, max(1, len(words) - size + 1))) if words else np.zeros(0, np.uint64)


def fingerprints(docs: DataFrame, size: int, n_words: int = 1, distinct: bool = False) -> DataFrame:
    """doc_id, version (a hash of the text) and the fingerprint's words w0, w1, ... of every row of ``docs``."""
    columns = [f"w{i}" for i in range(n_words)]
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("version"), "text")
    kept = [T.StructField(f.name, f.dataType) for f in rows.schema[:2]]
    schema = T.StructType([*kept, *[T.StructField(c, T.LongType()) for c in columns]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [simhash(x.as_py(), size, n_words, distinct) for x in batch.column("text")]
            by_word = [pa.array([p[i] for p in prints], pa.int64()) for i in range(n_words)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *by_word], names=schema.names)

    return rows.mapInArrow(run, schema)


def _segment(words: list[np.ndarray], first: int, bits: int) -> np.ndarray:
    """A segment's value; it may span two words."""
    word, at = divmod(first, 64)
    value = words[word].view(np.uint64) << np.uint64(at)
    if at + bits > 64:
        value = value | (words[word + 1].view(np.uint64) >> np.uint64(64 - at))
    return (value >> np.uint64(64 - bits)).astype(np.int64)


def _keys(classes: DataFrame, index: Index) -> DataFrame:
    """Rows (key, code): a class under its own keys (code 2 * node) and under those it looks up (2 * node + 1).

    Of two keys that differ in one bit the one without it looks up the other, which halves the
    lookups: balls are made of added bits only, for radius 1. A class looks its own key up too.
    """
    if any(radius > 1 for _, _, radius in index.segments):
        raise ValueError("balls of radius 0 or 1 only; take more segments instead")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = batch.column("node").to_numpy()
            words = [batch.column(c).to_numpy() for c in index.columns]
            for number, (first, bits, radius) in enumerate(index.segments):
                value = _segment(words, first, bits)
                balls = [(value, 2 * node), (value, 2 * node + 1)]
                for bit in range(bits) if radius else ():
                    unset = (value >> bit) & 1 == 0
                    balls.append((value[unset] | (1 << bit), 2 * node[unset] + 1))
                for keys, codes in balls:
                    yield pa.RecordBatch.from_arrays([pa.array(keys | (number << 40)), pa.array(codes)], names=["key", "code"])

    return classes.select("node", *index.columns).mapInArrow(run, "key long, code long")


def _halves(classes: DataFrame, index: Index) -> DataFrame:
    """Rows (key, node): each drawn segment of a class twice, in table 2 * number as it is and in the next with its halves swapped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = np.stack([batch.column(c).to_numpy() for c in index.columns], axis=1).astype(">i8")
            by_bit = np.ascontiguousarray(np.unpackbits(words.view(np.uint8), axis=1).T)
            for number, bits in enumerate(index.drawn):
                half = len(bits) // 2
                for at, order in enumerate((bits, bits[half:] + bits[:half])):
                    keys = np.full(by_bit.shape[1], 2 * number + at, np.int64)
                    packed = np.packbits(by_bit[list(order)], axis=0)
                    for byte in packed[: len(order) // 8]:
                        keys = keys << 8 | byte
                    if rest := len(order) % 8:
                        keys = keys << rest | packed[-1] >> 8 - rest
                    yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column("node")], names=["key", "node"])

    return classes.select("node", *index.columns).mapInArrow(run, "key long, node long")


def _flips(key: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted distinct keys the pairs (lookup, member), as positions, of which the member has one bit more in the last ``half``."""
    looks, finds = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for bit in range(half):
        unset = np.flatnonzero((key >> bit) & 1 == 0)
        wanted = key[unset] | 1 << bit
        at = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
        there = key[at] == wanted
        looks.append(unset[there])
        finds.append(at[there])
    return np.concatenate(looks), np.concatenate(finds)


def _meeting(key: np.ndarray, node: np.ndarray, bits: int, every: bool = False) -> Iterator[pa.RecordBatch]:
    """Rows (key, code) as of ``_keys`` of these rows sorted by key: of keys under which nodes meet, or of all keys if ``every``.

    Members of a key meet each other in the table of the segment as it is only, so that they meet once.
    """
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    counts = np.diff(np.append(starts, len(key)))
    values = key[starts]
    if every:
        member = np.ones(len(values), bool)
        run = np.repeat(np.arange(len(values)), bits // 2)
        wanted = values[run] | np.tile(1 << np.arange(bits // 2), len(values))
        run, wanted = run[wanted != values[run]], wanted[wanted != values[run]]
    else:
        member = (counts > 1) & (values >> bits & 1 == 0)
        run, found = _flips(values, bits // 2)
        member[found] = True
        wanted = values[found]
    of_member = np.repeat(member, counts)
    n = counts[run]
    rows = np.repeat(starts[run], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    keys = np.concatenate([key[of_member], np.repeat(wanted, n)])
    codes = np.concatenate([2 * node[of_member], 2 * node[rows] + 1])
    for at in range(0, len(keys), ARROW_ROWS):
        part = slice(at, at + ARROW_ROWS)
        yield pa.RecordBatch.from_arrays([pa.array(keys[part]), pa.array(codes[part])], names=["key", "code"])


def _met_by_half(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Of rows of ``_halves`` sorted by key, the rows (key, code) under which classes meet or differ in one bit of the key's last half.

    Rows with the same first half are looked at together, up to ``HELD``. Of a larger group all rows and lookups come:
    more than meet, but no fewer.
    """
    half = bits // 2
    held, overfull = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, node = batch.column("key").to_numpy(), batch.column("node").to_numpy()
        if held is not None:
            key, node = np.concatenate([held[0], key]), np.concatenate([held[1], node])
            held = None
        group = key >> half
        if overfull is not None:
            end = int(np.searchsorted(group, overfull, side="right"))
            if end:
                yield from _meeting(key[:end], node[:end], bits, every=True)
            key, node, group = key[end:], node[end:], group[end:]
            if not len(key):
                continue
            overfull = None
        last = int(np.searchsorted(group, group[-1]))
        if last:
            yield from _meeting(key[:last], node[:last], bits)
        if len(key) - last > HELD:
            overfull = int(group[-1])
            for at in range(last, len(key), ARROW_ROWS):
                yield from _meeting(key[at : at + ARROW_ROWS], node[at : at + ARROW_ROWS], bits, every=True)
        else:
            held = key[last:], node[last:]
    if held is not None:
        yield from _meeting(*held, bits)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key, members first, those of keys under which a class meets another.

    A class alone has two rows under its key, and most lookups find no member. No more rows
    are held, of a group that goes on in the next batch and is undecided.
    """
    held, open_key, stays = None, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, code = batch.column("key").to_numpy(), batch.column("code").to_numpy()
        if held is not None:
            key, code = np.concatenate([held[0], key]), np.concatenate([held[1], code])
        new = np.concatenate([[True], key[1:] != key[:-1]])
        starts = np.flatnonzero(new)
        counts = np.diff(np.append(starts, len(key)))
        member = code[starts] & 1 == 0
        keep = member & (counts > 2)
        if open_key == key[0] and stays is not None:
            keep[0] = stays
        decided = len(starts) == 1 and open_key == key[0] and stays is not None
        open_key = int(key[-1])
        if member[-1] and counts[-1] <= 2 and not decided:
            held, stays = (key[starts[-1] :], code[starts[-1] :]), None
        else:
            held, stays = None, bool(keep[-1])
        rows = np.repeat(keep, counts)
        yield pa.RecordBatch.from_arrays([pa.array(key[rows]), pa.array(code[rows])], names=["key", "code"])


def _links_of_batch(group, lookup, node, words, index, mutual, flip):
    """Pairs found by the lookups of one batch, as rows of the lookup and the member, and their distances.

    Rows are sorted by group, the members of each before its lookups. Of groups that are ``mutual`` members look up
    too; of these and of lookups that are no ``flip`` one of both directions is enough.
    """
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    of_group = np.cumsum(np.concatenate([[True], group[1:] != group[:-1]])) - 1
    members = np.add.reduceat((~lookup).astype(np.int64), starts)
    rows = np.flatnonzero(lookup | mutual)
    counts = members[of_group[rows]]
    rows, counts = rows[counts > 0], counts[counts > 0]
    ends = np.cumsum(counts)
    at = 0
    while at < len(rows):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, side="right")))
        part, n = rows[at:stop], counts[at:stop]
        left = np.repeat(part, n)
        offset = np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
        right = np.repeat(starts[of_group[part]], n) + offset
        other = np.where(mutual[left] & ~flip[left], node[left] < node[right], node[left] != node[right])
        left, right = left[other], right[other]
        far = np.zeros(len(left), np.int64)
        for word in words:
            far += np.bitwise_count((word[left] ^ word[right]).view(np.uint64))
        near = far <= index.max_distance
        yield left[near], right[near], far[near]
        at = stop


def _spanning(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which of the links (lookup, member) connect something that those before do not."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    keep = np.zeros(len(left), bool)
    for i, (a, b) in enumerate(zip(left.tolist(), right.tolist(), strict=True)):
        a, b = root(~a), root(b)
        if a != b:
            parent[a] = b
            keep[i] = True
    return keep


def _forest(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Of the pairs (a, b), nearest first, those that connect what the links (left, right) and pairs before do not."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (above := parent.get(x, x)) != x:
            parent[x] = parent.get(above, above)
            x = above
        return x

    for x, y in zip(left.tolist(), right.tolist(), strict=True):
        parent[root(x)] = root(y)
    keep = []
    order = np.argsort(far, kind="stable")
    for i, x, y in zip(order.tolist(), a[order].tolist(), b[order].tolist(), strict=True):
        x, y = root(x), root(y)
        if x != y:
            parent[x] = y
            keep.append(i)
    return np.array(keep, np.int64)


def _first_meeting(differ: np.ndarray, number: np.ndarray, index: Index) -> np.ndarray:
    """Which pairs, of these differing bits (a row of words each), meet in no segment before the one they met in."""
    first = np.ones(len(number), bool)
    for at, bits in enumerate(index.drawn):
        rows = np.flatnonzero(first & (number > at))
        far = np.zeros(len(rows), np.int64)
        for word in range(index.words):
            mask = sum(1 << 63 - bit % 64 for bit in bits if bit // 64 == word)
            if mask and len(rows):
                far += np.bitwise_count(differ[rows, word] & np.uint64(mask))
        first[rows[far <= 1]] = False
    return first


def _meetings(classes: DataFrame, index: Index) -> DataFrame:
    """Rows (key, lookup, node) of the keys under which nodes of ``classes`` meet, a written table."""
    # Each class makes many keys, so a task has few classes.
    each = 2 * len(index.drawn) + sum(2 + bits * radius for _, bits, radius in index.segments)
    spread = classes.select("node", *index.columns).repartition(max(1, -(-classes.count() * each // KEY_ROWS)))
    # Narrow rows are shuffled first: few keys bring two classes together, and only those need fingerprints.
    if index.drawn:
        bits = len(index.drawn[0])
        by_key = _halves(spread, index).repartition(F.shiftright("key", bits // 2)).sortWithinPartitions("key")
        met = by_key.mapInArrow(partial(_met_by_half, bits=bits), "key long, code long")
    else:
        by_key = _keys(spread, index).repartition("key").sortWithinPartitions("key", F.col("code").bitwiseAND(1))
        met = by_key.mapInArrow(_met, "key long, code long")
    met = cut_lineage(met, "met")
    return met.select("key", (F.col("code").bitwiseAND(1) == 1).alias("lookup"), F.shiftright("code", 1).alias("node"))


def _by_key(met: DataFrame, classes: DataFrame, index: Index) -> DataFrame:
    """``met`` with the columns of ``classes``, sorted by key and block, members before lookups."""
    names = classes.drop("node").columns
    crowded = met.where("NOT lookup").groupBy("key").agg(F.count("*").alias("members")).where(F.col("members") > BLOCK)
    crowded = cut_lineage(crowded.select("key", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks")), "crowded")
    rows = met.join(classes, "node").join(crowded, "key", "left")
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64(F.lit("block"), "node"), blocks).cast("int")
    everywhere = F.sequence(F.lit(0), blocks - 1)
    seen_in = F.when(F.col("lookup") | _mutual(F.col("key"), index), everywhere).otherwise(F.array(own))
    rows = rows.select("key", F.explode(seen_in).alias("block"), (F.col("lookup") | (F.col("block") != own)).alias("lookup"), F.col("lookup").alias("flip"), "node", *names)
    return rows.repartition("key", "block").sortWithinPartitions("key", "block", "lookup")


def _mutual(key, index: Index):
    """Whether members of a key look each other up, for they have no rows that do: in the table of a drawn segment as it is."""
    at = len(index.drawn[0]) if index.drawn else 0
    if isinstance(key, np.ndarray):
        return (key >> at & 1 == 0) & (at > 0)
    return (F.shiftright(key, at).bitwiseAND(1) == 0) & F.lit(at > 0)


def _pairs_by_key(batches: Iterator[pa.RecordBatch], index: Index, more: tuple[str, ...] = ()) -> Iterator[tuple]:
    """Of rows as ``_by_key`` gives them the columns key, node, the words and ``more``, and pairs of their rows with distances."""
    kept, names = None, ("key", "block", "lookup", "flip", "node", *index.columns, *more)
    for batch in batches:
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
        if not batch.num_rows:
            continue
        if kept is not None:
            columns = [np.concatenate(pair) for pair in zip(kept, columns, strict=True)]
        key, block, lookup, flip, node, *rest = columns
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (block[1:] != block[:-1])])
        last = int(np.flatnonzero(new)[-1])
        held = last + np.flatnonzero(~lookup[last:])
        kept = [c[held] for c in columns]
        words = rest[: index.words]
        for left, right, far in _links_of_batch(np.cumsum(new), lookup, node, words, index, _mutual(key, index), flip):
            yield key, node, words, rest[index.words :], left, right, far


def links(classes: DataFrame, index: Index, met: DataFrame | None = None) -> DataFrame:
    """Links (a, b, sure) between nodes of ``classes`` (node and the words of distinct fingerprints).

    The sure ones connect exactly the classes that some chain of pairs, each found through a table
    and within ``sure_distance`` (or ``max_distance``, if there is none), connects. Not all of them
    are returned: in a key with many members a lookup gives only what is needed to connect them, so
    the links grow with the rows. So do the others, pairs in doubt: of those within ``max_distance``
    the nearest come that connect what sure links do not; ``doubtful`` gives the rest.
    """
    rows = _by_key(_meetings(classes, index) if met is None else met, classes.select("node", *index.columns), index)
    limit = index.max_distance if index.sure_distance is None else index.sure_distance

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, node, _, _, left, right, far in _pairs_by_key(batches, index):
            sure = far <= limit
            a, b = left[sure], right[sure]
            if len(a):
                keep = _spanning(a, b) if len(a) > len(np.unique(a)) else slice(None)
                yield _rows(node[a[keep]], node[b[keep]], True)
            c, d = node[left[~sure]], node[right[~sure]]
            if len(c):
                keep = _forest(node[a], node[b], c, d, far[~sure])
                yield _rows(c[keep], d[keep], False)

    return rows.mapInArrow(run, "a long, b long, sure boolean")


def doubtful(met: DataFrame, classes: DataFrame, index: Index) -> DataFrame:
    """All pairs (a, b) in doubt between nodes of ``classes`` with different ``root``, each once: in the first segment they meet in."""
    rows = _by_key(met, classes.select("node", *index.columns, "root"), index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, node, words, (root,), left, right, far in _pairs_by_key(batches, index, ("root",)):
            open_ = (far > index.sure_distance) & (root[left] != root[right])
            left, right = left[open_], right[open_]
            differ = np.stack([(w[left] ^ w[right]).view(np.uint64) for w in words], axis=1)
            first = _first_meeting(differ, key[left] >> len(index.drawn[0]) + 1, index)
            yield _rows(node[left[first]], node[right[first]], False).drop_columns(["sure"])

    return rows.mapInArrow(run, "a long, b long")


def _rows(a: np.ndarray, b: np.ndarray, sure: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.full(len(a), sure))], names=["a", "b", "sure"])


def _similar(pairs: DataFrame, classes: DataFrame, docs: DataFrame, size: int, similarity: float) -> DataFrame:
    """Of ``pairs`` (nodes a and b, other columns kept) those whose texts share enough of their distinct shingles."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    named = classes.select("node", F.col("least.doc_id").alias("__doc"), F.col("least.version").alias("__version")).join(wanted, "node")
    named = cut_lineage(named, "wanted")
    own = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("__own"))
    texts = own.join(named, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__own") == F.col("__version")))
    texts = texts.select("node", "text").dropDuplicates(["node"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(x.as_py(), size).view(np.int64) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])

    sets = cut_lineage(texts.mapInArrow(run, "node long, shingles array<long>"), "shingles")
    for side in "ab":
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("shingles").alias(f"of_{side}")), side)
    common = F.size(F.array_intersect("of_a", "of_b"))
    return pairs.where(common / (F.size("of_a") + F.size("of_b") - common) >= similarity).drop("of_a", "of_b")


def _with_roots(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose roots in ``nodes`` (node, root) differ, with root_a and root_b."""
    for side in "ab":
        pairs = pairs.join(nodes.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}")), side)
    return pairs.where("root_a <> root_b")


def _joined(nodes: DataFrame, similar: DataFrame) -> DataFrame:
    """``nodes`` (node, root) with the roots that the pairs (root_a, root_b) connect made one."""
    upper = components(similar.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
    upper = cut_lineage(upper.select(F.col("node").alias("under"), F.col("root").alias("top")), "tops")
    joined = nodes.join(upper, F.col("root") == F.col("under"), "left")
    return cut_lineage(joined.select("node", F.coalesce("top", "root").alias("root")), "roots")


def _roots(classes: DataFrame, docs: DataFrame, size: int, index: Index) -> DataFrame:
    """node, root: the smallest node that a node is connected with, of nodes with links.

    Pairs in doubt are decided in two rounds. The first takes the nearest that connect what sure links do not, as
    many as there are nodes at most under a key. What they connect needs no further comparing, so the second takes,
    of all the others, those between different roots. It reads only the nodes whose root has a pair of the first
    round that was refused: any other root is connected with all that its nodes are in doubt about.
    """
    if index.similarity is None:
        return cut_lineage(components(links(classes, index)), "roots")
    met = _meetings(classes, index)
    found = cut_lineage(links(classes, index, met), "links")
    sure = components(found.where("sure"))
    nodes = classes.select("node").join(sure, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    nodes = cut_lineage(nodes, "roots")
    pairs = found.where("NOT sure").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = cut_lineage(_with_roots(pairs, nodes), "pairs")
    similar = cut_lineage(_similar(pairs, classes, docs, size, index.similarity), "similar")
    nodes = _joined(nodes, similar)
    refused = _with_roots(pairs.select("a", "b"), nodes)
    refused = refused.select(F.explode(F.array("root_a", "root_b")).alias("root")).distinct()
    again = cut_lineage(nodes.join(cut_lineage(refused, "refused"), "root").select("node", "root"), "again")
    pairs = doubtful(met.join(again.select("node"), "node"), classes.select("node", *index.columns).join(again, "node"), index)
    pairs = cut_lineage(_with_roots(pairs, nodes), "pairs")
    similar = cut_lineage(_similar(pairs, classes, docs, size, index.similarity), "similar")
    return _joined(nodes, similar)


def near_duplicates(docs: DataFrame, size: int = 5, index: Index = SIMILAR_1024) -> DataFrame:
    """doc_id, version, the words of the fingerprint, component_id and stays for every row of ``docs``.

    ``component_id`` is the smallest doc_id among all documents reachable through links, the
    document itself included; rows with a null id belong to components like others but name none
    unless there is no other. ``stays`` marks one document of each component: the one with that id
    and, of several, the smallest ``version``. Repeated rows are repeated in the result. Empty
    documents share one fingerprint. Only doc_id and text are read, so other columns may have any name.
    """
    names = index.columns
    prints = cut_lineage(fingerprints(docs, size, index.words, index.similarity is not None), "prints")
    one = F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id"), F.col("version"))
    classes = prints.groupBy(*names).agg(F.min(one).alias("least"))
    # Numbered once and written, so that the numbers stay.
    classes = cut_lineage(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    if index is SIMILAR_1024:
        index = similar_index(classes.count())
    roots = _roots(classes, docs, size, index)
    rooted = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = cut_lineage(rooted.groupBy("root").agg(F.min("least").alias("first")), "firsts")
    labels = cut_lineage(rooted.join(first, "root").select(*names, "first"), "labels")
    return prints.join(labels, names).select(
        "doc_id", "version", *names, F.col("first.doc_id").alias("component_id"), one.eqNullSafe(F.col("first")).alias("stays")
    )


def one_of_each(docs: DataFrame, size: int = 5, index: Index = SIMILAR_1024) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component, with all columns as they are."""
    staying = near_duplicates(docs, size, index).where("stays").select(F.col("doc_id").alias("__doc"), F.col("version").alias("__version"))
    staying = cut_lineage(staying.distinct(), "staying")
    marked = docs.withColumn("__own", F.xxhash64(F.coalesce("text", F.lit(""))))
    found = marked.join(staying, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__own") == F.col("__version")), "left_semi")
    return found.dropDuplicates(["doc_id", "__own"]).drop("__own")
