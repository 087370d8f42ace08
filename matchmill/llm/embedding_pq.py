"""Near-duplicate embeddings by product quantisation.

Unit vectors go to the nearest of the coarse centroids (inverted lists; lists of lists where there
are many vectors), and what remains of them is coded subspace by subspace. A vector looks into all
lists that can hold a vector within reach, compares itself with the codes by a table of distances
(its own values against the codewords), and what passes is decided by the exact cosine.

With unit vectors a cosine is a distance. A list is left out if the plane between it and the nearest
one is out of reach: how far a step of that length gets towards the plane, in a random direction of
as many dimensions as the data has, but for the few steps beyond three deviations (below nine
dimensions: no step at all). A code is left out only if it is farther than reach and its own known
error, which loses nothing. So the quantisers may be fitted on a sample. README has the measured recall.

Vectors within half the reach of a centroid, the list's core, are all linked with each other. They
are counted, not compared, and who is near enough to the centroid is linked with the whole core. So
a group of near copies with a large part of all rows, at whose middle the fit puts a centroid, costs
no square of its size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchmill.llm.components import components
from matchmill.session import cut_lineage

#: The quantisers are fitted on as many distinct vectors at most (those with the smallest hash),
#: and on no more values than these.
SAMPLE_ROWS, SAMPLE_VALUES = 20_000, 1 << 21

#: Vectors wanted in a list; lists of one level at most. More vectors make more levels.
LIST_SIZE, LISTS = 128, 1024

#: Deviations of a random step that still count as in reach of a list.
DEVIATIONS = 3.0

#: Values of a subspace and codewords for it.
SUBSPACE, CODEWORDS = 2, 16

#: Members of a list that are held at a time; further ones make further blocks, each of which sees
#: all who look into the list.
BLOCK = 2048

#: Values that are held for a step of the arithmetic.
STEP = 1 << 22

#: Distances are known to about 1e-8. Whatever is decided without the exact cosine keeps this margin.
MARGIN = 1e-6

#: A member; a member that looks into its own list; a vector that looks into another; one that is linked with a whole core.
MEMBER, INSIDE, LOOKUP, WHOLE_CORE = 0, 1, 2, 3


@dataclass(frozen=True)
class Quantiser:
    """Centroids of each level, the distances between them, the part of a step that leads towards one, and codewords."""

    levels: list[np.ndarray]
    apart: list[np.ndarray]
    towards: list[float]
    codewords: np.ndarray
    width: int

    def middle(self, cell: int) -> np.ndarray:
        """A cell's centroid: the sum of its levels'."""
        at = np.zeros(self.width)
        for centroids in reversed(self.levels):
            cell, number = divmod(cell, len(centroids))
            at = at + centroids[number]
        return at


def unit_rows(values: list, width: int) -> np.ndarray:
    """Vectors as rows of length one in double precision, shorter ones filled up with zeros."""
    rows = np.zeros((len(values), width))
    for row, value in zip(rows, values, strict=True):
        row[: len(value)] = value
    if len(rows):
        rows /= np.abs(rows).max(axis=1, keepdims=True)
        rows /= np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all centres."""
    found = (x * x).sum(axis=1)[:, None] - 2 * (x @ centres.T) + (centres * centres).sum(axis=1)
    return np.maximum(found, 0, out=found)


def _means(x: np.ndarray, centres: np.ndarray, rounds: int) -> np.ndarray:
    """Lloyd's rounds; a centre without rows stays where it is."""
    for _ in range(rounds):
        nearest = _squares(x, centres).argmin(axis=1)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def _leaders(x: np.ndarray, reach: float, most: int) -> np.ndarray:
    """Rows out of each other's reach, in the rows' order: a tight group gives one, however large it is."""
    chosen, away = [], np.full(len(x), np.inf)
    while len(chosen) < most and (free := np.flatnonzero(away > reach * reach)).size:
        chosen.append(x[free[0]])
        away = np.minimum(away, _squares(x, chosen[-1][None])[:, 0])
    return np.array(chosen)


def _towards(rest: np.ndarray) -> float:
    """The part of a step that leads in one direction, by as many dimensions as ``rest`` spreads over."""
    spread = rest.T @ rest
    square = float((spread * spread).sum())
    return min(1.0, DEVIATIONS * np.sqrt(square) / np.trace(spread)) if square else 1.0


def fit(sample: np.ndarray, n: int, reach: float) -> Quantiser:
    """The quantiser of ``n`` vectors, from the unit rows of ``sample``."""
    rest, levels, towards, cells = sample, [], [], 1
    while True:
        centres = _leaders(rest, reach, int(min(LISTS, max(1, n // (LIST_SIZE * cells)))))
        centres = _means(rest, centres, 5)
        levels.append(centres)
        rest = rest - centres[_squares(rest, centres).argmin(axis=1)]
        towards.append(_towards(rest))
        cells *= len(centres)
        if len(centres) == 1 or cells * LIST_SIZE * 2 > n:
            break
    parts = -(-sample.shape[1] // SUBSPACE)
    rest = np.pad(rest, ((0, 0), (0, parts * SUBSPACE - rest.shape[1]))).reshape(len(rest), parts, SUBSPACE)
    draw = np.random.default_rng(0).permutation(len(rest))[:CODEWORDS]
    words = np.stack([_means(rest[:, p], rest[np.resize(draw, CODEWORDS), p], 6) for p in range(parts)])
    return Quantiser(levels, [np.sqrt(_squares(c, c)) for c in levels], towards, words, sample.shape[1])


def _parts(x: np.ndarray) -> np.ndarray:
    """Rows cut into subspaces."""
    x = np.pad(x, ((0, 0), (0, -x.shape[1] % SUBSPACE)))
    return x.reshape(len(x), -1, SUBSPACE)


def encode(rest: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codes of what remains of vectors, a byte for a subspace, and the distances to what they stand for."""
    parts = _parts(rest)
    codes = np.empty(parts.shape[:2], np.uint8)
    error = np.zeros(len(rest))
    for p in range(parts.shape[1]):
        away = _squares(parts[:, p], words[p])
        codes[:, p] = away.argmin(axis=1)
        error += away.min(axis=1)
    return codes, np.sqrt(error)


def table_distances(rest: np.ndarray, codes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Distances of all rows to all codes, looked up in each row's table of its distances to the codewords."""
    parts = _parts(rest)
    found = np.zeros((len(rest), len(codes)))
    for p in range(parts.shape[1]):
        found += _squares(parts[:, p], words[p])[:, codes[:, p]]
    return np.sqrt(found)


def _probes(x: np.ndarray, quantiser: Quantiser, reach: float) -> tuple[np.ndarray, ...]:
    """Own cell, distance to its centroid and what remains of each row; (row, cell, distance) of every cell in reach."""
    own = np.zeros(len(x), np.int64)
    row, cell, rest = np.arange(len(x)), np.zeros(len(x), np.int64), x
    remains = x
    for centres, apart, towards in zip(quantiser.levels, quantiser.apart, quantiser.towards, strict=True):
        away = _squares(remains, centres)
        best = away.argmin(axis=1)
        own = own * len(centres) + best
        remains = remains - centres[best]
        found = []
        step = max(1, STEP // max(len(centres), x.shape[1]))
        for at in range(0, len(row), step):
            away = _squares(rest[at : at + step], centres)
            best = away.argmin(axis=1)
            ahead = away - away[np.arange(len(away)), best][:, None]
            near, number = np.nonzero(ahead <= 2 * towards * (reach + MARGIN) * apart[best] + MARGIN)
            found.append((row[at + near], cell[at + near] * len(centres) + number, rest[at + near] - centres[number]))
        row, cell, rest = (np.concatenate(part) for part in zip(*found, strict=True))
    return own, np.sqrt((remains * remains).sum(axis=1)), remains, row, cell, np.sqrt((rest * rest).sum(axis=1))


_PLACED = "kind byte, dim int, list long, node long, copies long, vector binary, codes binary, error double"


def _place(classes: DataFrame, shared, reach: float) -> DataFrame:
    """Each class as a member of its list (2 * cell, or 2 * cell + 1 in the cell's core) and in the lists it looks into.

    Two vectors meet in the later one of their two lists. In the core of another cell a vector is
    linked with all, with none, or looks them up; in its own core it is linked with all.
    """

    def rows(kind: int, batch: pa.RecordBatch, taken: np.ndarray, lists: np.ndarray, vector, codes=None, error=None) -> pa.RecordBatch:
        n, at = len(taken), pa.array(taken, pa.int64())
        arrays = [
            pa.array(np.full(n, kind, np.int8)),
            batch.column("dim").take(at),
            pa.array(lists),
            batch.column("node").take(at),
            batch.column("copies").take(at),
            pa.nulls(n, pa.binary()) if vector is None else pa.array([vector[i] for i in taken.tolist()], pa.binary()),
            pa.nulls(n, pa.binary()) if codes is None else pa.array(codes, pa.binary()),
            pa.nulls(n, pa.float64()) if error is None else pa.array(error),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=["kind", "dim", "list", "node", "copies", "vector", "codes", "error"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quantiser = shared.value
        step = max(1, STEP // (4 * quantiser.width))
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                values = batch.column("embedding").to_pylist()
                x = unit_rows(values, quantiser.width)
                vector = [np.array(v, np.float64).tobytes() for v in values]
                own, middle, remains, row, cell, away = _probes(x, quantiser, reach)
                in_core = middle <= reach / 2 - MARGIN
                lists = 2 * own + in_core
                codes, error = encode(remains, quantiser.codewords)
                everyone = np.arange(len(x))
                yield rows(MEMBER, batch, everyone, lists, vector, [c.tobytes() for c in codes], error)
                alone = everyone[~in_core]
                yield rows(INSIDE, batch, alone, lists[alone], vector)
                after = 2 * cell > lists[row]
                yield rows(LOOKUP, batch, row[after], 2 * cell[after], vector)
                core = 2 * cell + 1
                after = core > lists[row]
                sure = after & (away + reach / 2 <= reach - MARGIN)
                maybe = after & ~sure & (away - reach / 2 <= reach + MARGIN)
                yield rows(WHOLE_CORE, batch, row[sure], core[sure], None)
                yield rows(LOOKUP, batch, row[maybe], core[maybe], vector)

    return classes.select("node", "dim", "copies", "embedding").mapInArrow(run, _PLACED)


def _spanning(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which of the links connect what those before do not."""
    above: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := above.get(x, x)) != x:
            above[x] = x = above.get(up, up)
        return x

    keep = np.zeros(len(left), bool)
    for i, (a, b) in enumerate(zip(left.tolist(), right.tolist(), strict=True)):
        a, b = root(a), root(b)
        if a != b:
            above[a], keep[i] = b, True
    return keep


def _compare(batches: Iterator[pa.RecordBatch], quantiser: Quantiser, threshold: float, reach: float) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, n) of a sorted partition: b null, a has n more links; or a link that connects a and b.

    Held are the members of one block of a list, as many as BLOCK or a few more; lookups stream past.
    """
    now, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        # The dimension and the block tell lists apart as well.
        key = np.stack([batch.column(c).to_numpy() for c in ("dim", "list", "block")], axis=1)
        kind, node, copies = (batch.column(c).to_numpy() for c in ("kind", "node", "copies"))
        cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        counted, linked = [], []
        for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
            group = tuple(key[start].tolist())
            if group != now:
                now, held, offset = group, [], quantiser.middle(group[1] // 2)
            looks = start + int(np.searchsorted(kind[start:stop], INSIDE))
            if looks > start:
                part = batch.slice(start, looks - start)
                values = [np.frombuffer(v) for v in part.column("vector").to_pylist()]
                codes = np.frombuffer(b"".join(part.column("codes").to_pylist()), np.uint8).reshape(len(part), -1)
                found = (node[start:looks], copies[start:looks], unit_rows(values, quantiser.width), codes, part.column("error").to_numpy())
                held = [np.concatenate(pair) for pair in zip(held, found, strict=True)] if held else list(found)
            if looks == stop or not held:
                continue
            other, of_other, members, codes, error = held
            step = max(1, STEP // max(len(other), quantiser.width))
            for at in range(looks, stop, step):
                end = min(stop, at + step)
                x = unit_rows([np.frombuffer(v.as_py()) for v in batch.column("vector").slice(at, end - at)], quantiser.width)
                passed = table_distances(x - offset, codes, quantiser.codewords) <= reach + MARGIN + error
                q, m = np.nonzero(passed)
                # In its own list a vector is a member too, and each pair is met from both sides.
                once = (kind[at + q] != INSIDE) | (node[at + q] < other[m])
                q, m = q[once], m[once]
                cosine = np.empty(len(q))
                for part in range(0, len(q), step):
                    cosine[part : part + step] = np.einsum("ij,ij->i", x[q[part : part + step]], members[m[part : part + step]])
                near = cosine >= threshold
                q, m = at + q[near], m[near]
                counted += [(node[q], of_other[m]), (other[m], copies[q])]
                linked.append((node[q], other[m]))
        if any(len(a) for a, _ in linked):
            nodes, of_node = np.unique(np.concatenate([a for a, _ in counted]), return_inverse=True)
            n = np.zeros(len(nodes), np.int64)
            np.add.at(n, of_node, np.concatenate([n for _, n in counted]))
            a, b = (np.concatenate(side) for side in zip(*linked, strict=True))
            keep = _spanning(a, b)
            for left, right, links in ((nodes, pa.nulls(len(nodes), pa.int64()), n), (a[keep], pa.array(b[keep]), np.zeros(int(keep.sum()), np.int64))):
                yield pa.RecordBatch.from_arrays([pa.array(left), right, pa.array(links)], names=["a", "b", "n"])


def link_classes(classes: DataFrame, threshold: float = 0.95) -> tuple[DataFrame, DataFrame]:
    """(node, n) and (a, b) over ``classes`` (node, dim, copies, embedding; valid vectors, distinct).

    ``n`` counts the rows of other classes with a cosine of ``threshold`` or more, each class as
    many as its copies; the links (a, b) connect the classes that any chain of such pairs connects.
    Classes without any have no row. Vectors of different lengths are not compared.
    """
    spark = classes.sparkSession
    reach = float(np.sqrt(2 - 2 * threshold))
    n, width = classes.agg(F.count("*"), F.max("dim")).first()
    if not n:
        return spark.createDataFrame([], "node long, n long"), spark.createDataFrame([], "a long, b long")
    most = int(max(1, min(SAMPLE_ROWS, SAMPLE_VALUES // width)))
    sample = classes.orderBy(F.xxhash64("node"), "node").limit(most).select("embedding").toArrow()
    shared = spark.sparkContext.broadcast(fit(unit_rows(sample.column(0).to_pylist(), width), n, reach))

    placed = cut_lineage(_place(classes, shared, reach), "placed")
    members = placed.where(F.col("kind") == MEMBER).groupBy("dim", "list").agg(
        F.count("*").alias("members"), F.sum("copies").alias("weight"), F.min("node").alias("first")
    )
    members = cut_lineage(members, "lists")
    met = placed.where(F.col("kind") != WHOLE_CORE).join(members.select("dim", "list", "members"), ["dim", "list"])
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64(F.lit("block"), "node"), blocks).cast("int")
    seen_in = F.when(F.col("kind") != MEMBER, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(own))
    met = met.withColumn("block", F.explode(seen_in)).drop("members")
    met = met.repartition("dim", "list", "block").sortWithinPartitions("dim", "list", "block", "kind")
    found = met.mapInArrow(lambda batches: _compare(batches, shared.value, threshold, reach), "a long, b long, n long")
    found = cut_lineage(found, "found")
    shared.destroy()

    core = members.where(F.col("list") % 2 == 1)
    whole = cut_lineage(placed.where(F.col("kind") == WHOLE_CORE).select("dim", "list", "node", "copies").join(core, ["dim", "list"]), "whole")
    gained = cut_lineage(whole.groupBy("dim", "list").agg(F.sum("copies").alias("gained")), "gained")
    inside = placed.where((F.col("kind") == MEMBER) & (F.col("list") % 2 == 1)).select("dim", "list", "node", "copies")
    inside = inside.join(core, ["dim", "list"]).join(gained, ["dim", "list"], "left")
    in_core = F.col("weight") - F.col("copies") + F.coalesce("gained", F.lit(0))
    counts = found.where("b IS NULL").select(F.col("a").alias("node"), "n")
    counts = counts.union(whole.select("node", F.col("weight").alias("n"))).union(inside.select("node", in_core.alias("n")))
    links = found.where("b IS NOT NULL").select("a", "b")
    links = links.union(whole.select(F.col("node").alias("a"), F.col("first").alias("b")))
    links = links.union(inside.select(F.col("node").alias("a"), F.col("first").alias("b")))
    return counts.groupBy("node").agg(F.sum("n").alias("n")), links.where("a <> b")


def near_duplicates(vectors: DataFrame, threshold: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding).

    ``n_links``: other rows with a cosine of ``threshold`` or more; ``component_id``: the smallest
    vec_id reachable by such links, the row's own included; ``kept``: whether that is the row's own.
    Equal vectors are one class and linked without being compared. Null and zero vectors and those
    with null or non-finite components are linked with nothing; neither are vectors of different
    lengths. A repeated vec_id is another row. Rows without an id link like others, but name a
    component only if nobody else does, and are not kept. Only vec_id and embedding are read, so
    other columns may have any name. An empty table gives no rows.
    """
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    valid = F.coalesce(finite & F.exists("embedding", lambda v: v != 0), F.lit(False))
    # 128 bits stand for a vector; zeros of either sign are one value.
    positive = F.transform("embedding", lambda v: v + F.lit(0).cast("float"))
    named = vectors.select("vec_id", F.when(valid, positive).alias("embedding"))
    is_valid = F.col("embedding").isNotNull()
    named = named.select(
        "vec_id",
        "embedding",
        F.when(is_valid, F.xxhash64("embedding")).alias("k1"),
        F.when(is_valid, F.xxhash64(F.lit("second"), "embedding")).alias("k2"),
    )
    least = F.struct(F.col("vec_id").isNull().alias("nameless"), "vec_id")
    classes = named.where("k1 IS NOT NULL").groupBy("k1", "k2").agg(
        F.min(least).alias("least"), F.count("*").alias("copies"), F.any_value("embedding").alias("embedding")
    )
    # Numbered once and written, so that the numbers stay.
    classes = classes.select("*", F.monotonically_increasing_id().alias("node"), F.size("embedding").alias("dim"))
    classes = cut_lineage(classes, "classes")
    counts, links = link_classes(classes, threshold)
    roots = cut_lineage(components(cut_lineage(links, "links")), "roots")
    rooted = classes.select("k1", "k2", "node", "least", "copies").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = cut_lineage(rooted.groupBy("root").agg(F.min("least.nameless").alias("nameless"), F.min("least.vec_id").alias("component_id")), "firsts")
    labels = rooted.join(first.drop("nameless"), "root").join(counts, "node", "left")
    labels = cut_lineage(labels.select("k1", "k2", "component_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "labels")
    labelled = named.select("vec_id", "k1", "k2").join(labels, ["k1", "k2"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return labelled.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
