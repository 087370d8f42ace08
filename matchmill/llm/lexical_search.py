"""Ranked lexical search over a length-stratified index.

Documents with an equal length normaliser ``m`` are a stratum. Within a stratum a posting's weight
depends on its term and tf alone, so postings lie by term and tf, and an impact is computed once
for each tf. What a query can score in a stratum at most (its terms at their largest tf) orders its
visits, which end at the first stratum that cannot reach the query's best ``k`` any more.

A stratum is stored in blocks of a bounded number of documents and postings, so that one with a
large part of all documents spreads over many tasks. Each task ranks all queries over its blocks;
the best of all tasks are merged in two steps.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from matchmill.session import cut_lineage

#: A term is a run of these bytes after A-Z are lower-cased; beyond ASCII every byte belongs to one.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_TO_TERMS = bytes(b if _TERM.fullmatch(bytes([b]).lower()) else 32 for b in range(256)).lower()

#: Bytes of a text that are cut into terms at a time.
SLICE = 1 << 20

#: Terms of all queries that an index is made for at a time. Further queries make further indexes.
TERMS = 200_000

#: Documents and postings of a block, about.
BLOCK_DOCS, BLOCK_POSTINGS = 4096, 1 << 18

#: Bytes of blocks among which a task orders its visits.
HELD = 32 << 20


@dataclass(frozen=True)
class Statistics:
    """N, the documents with a term, and L, all their terms."""

    documents: int
    terms: int


def terms_of(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text in order, a slice of it at a time."""
    whole = (text or "").encode().translate(_TO_TERMS)
    start = 0
    while len(whole) - start > SLICE:
        stop = whole.rfind(b" ", start, start + SLICE)
        if stop < 0:  # a term longer than a slice
            stop = whole.find(b" ", start)
        if stop < 0:
            break
        yield whole[start:stop].split()
        start = stop + 1
    yield whole[start:].split()


def query_terms(queries: DataFrame) -> DataFrame:
    """query_id, term: the distinct terms of each query; texts of one id are one query, a null text has none."""
    cut = F.split(F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER), _SEPARATORS)
    return queries.select("query_id", F.explode(cut).alias("term")).where("term <> ''").distinct()


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def count_terms(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms), terms and tfs (those in ``number``, ascending) of every row with a term.

    Whole texts are counted; rows without a term are left out.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(number)
    schema = T.StructType(
        [
            docs.select("doc_id").schema[0],
            T.StructField("n", T.LongType()),
            T.StructField("terms", T.ArrayType(T.IntegerType())),
            T.StructField("tfs", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in batches:
            rows, counts, terms, tfs, ends = [], [], [], [], [0]
            for row, text in enumerate(batch.column("text")):
                n, tally = 0, Counter()
                for part in terms_of(text.as_py()):
                    n += len(part)
                    tally.update(part)
                if not n:
                    continue
                held = sorted((number[t], tf) for t, tf in tally.items() if t in number)
                rows.append(row)
                counts.append(n)
                terms += [t for t, _ in held]
                tfs += [tf for _, tf in held]
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows, pa.int64())),
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64())),
                ],
                names=schema.names,
            )

    counted = cut_lineage(docs.select("doc_id", "text").mapInArrow(run, schema), "terms")
    shared.destroy()
    return counted


def normaliser(found: Statistics) -> Column:
    """100 - 50 + ((50 * n * N) div L) in whole numbers, of a column ``n``."""
    return F.expr(f"50L + (50L * {found.documents}L * n) div {found.terms}L")


def build_index(counted: DataFrame, found: Statistics) -> DataFrame:
    """m, block and the packed postings: one row for each block of a stratum.

    ``docs`` are the documents in ascending order; a group of postings is a term and a tf, with the
    numbers of its documents within the block from ``starts`` on.
    """
    strata = counted.select(
        "doc_id", "terms", "tfs", normaliser(found).alias("m"), F.monotonically_increasing_id().alias("row")
    )
    sizes = strata.groupBy("m").agg(F.count("*").alias("docs"), F.sum(F.size("terms")).alias("postings"))
    blocks = F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS), F.ceil(F.col("postings") / BLOCK_POSTINGS)).cast("int")
    crowded = cut_lineage(sizes.select("m", blocks.alias("blocks")).where("blocks > 1"), "crowded")
    placed = strata.join(crowded, "m", "left")
    block = F.pmod(F.xxhash64("row"), F.coalesce("blocks", F.lit(1))).cast("int")
    placed = placed.select("m", block.alias("block"), "doc_id", "terms", "tfs")
    placed = placed.repartition("m", "block").sortWithinPartitions("m", "block", "doc_id")
    schema = T.StructType(
        [
            T.StructField("m", T.LongType()),
            T.StructField("block", T.IntegerType()),
            T.StructField("docs", T.ArrayType(counted.schema["doc_id"].dataType)),
            T.StructField("terms", T.BinaryType()),
            T.StructField("tfs", T.BinaryType()),
            T.StructField("starts", T.BinaryType()),
            T.StructField("postings", T.BinaryType()),
        ]
    )

    def packed(key: tuple[int, int], held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        terms, tfs = table.column("terms").combine_chunks(), table.column("tfs").combine_chunks()
        number = np.repeat(np.arange(table.num_rows, dtype=np.int32), np.diff(terms.offsets.to_numpy()))
        term, tf = terms.flatten().to_numpy(), tfs.flatten().to_numpy()
        order = np.lexsort((number, tf, term))
        term, tf, number = term[order], tf[order], number[order]
        starts = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])])) if len(term) else np.zeros(0, np.int64)
        ids = table.column("doc_id").combine_chunks()
        arrays = [
            pa.array([key[0]], pa.int64()),
            pa.array([key[1]], pa.int32()),
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            *[pa.array([x.tobytes()], pa.binary()) for x in (term[starts], tf[starts], starts.astype(np.int32), number)],
        ]
        return pa.RecordBatch.from_arrays(arrays, names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            m, block = batch.column("m").to_numpy(), batch.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero((m[1:] != m[:-1]) | (block[1:] != block[:-1])) + 1).tolist(), batch.num_rows]
            for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
                key = (int(m[start]), int(block[start]))
                if held and key != now:
                    yield packed(now, held)
                    held = []
                now = key
                held.append(batch.slice(start, stop - start))
        if held:
            yield packed(now, held)

    return cut_lineage(placed.mapInArrow(run, schema), "index")


class _Block:
    """A block as it is read: groups of a term are neighbours, an impact stands for each distinct tf."""

    def __init__(self, row: dict, weights: np.ndarray):
        self.docs = row["docs"]
        term, tf, starts, self.postings = (np.frombuffer(row[c], t) for c, t in (("terms", np.int32), ("tfs", np.int64), ("starts", np.int32), ("postings", np.int32)))
        self.ends = np.append(starts, len(self.postings)).astype(np.int64)
        distinct, of_group = np.unique(tf, return_inverse=True)
        impacts = np.array([1_000_000_000 * t // (1000 * t + 20 * row["m"]) for t in distinct.tolist()], np.int64)
        self.impact = impacts[of_group] * weights[term]
        first = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, np.int64)
        self.terms = term[first]
        self.groups = np.append(first, len(term)).astype(np.int64)
        # A larger tf has no smaller impact, so a term's last group has its largest.
        self.most = self.impact[self.groups[1:] - 1]

    def bounds(self, terms: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """What each query can score here at most; its terms begin at ``starts``."""
        if not len(self.terms):
            return np.zeros(len(starts), np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.add.reduceat(np.where(self.terms[at] == terms, self.most[at], 0), starts)

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """The scores of all documents for a query's terms."""
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        total = np.zeros(len(self.docs), np.int64)
        for term in at[self.terms[at] == terms].tolist():
            for group in range(self.groups[term], self.groups[term + 1]):
                # A document is in one group of a term only.
                total[self.postings[self.ends[group] : self.ends[group + 1]]] += self.impact[group]
        return total


def _best(batches: Iterator[pa.RecordBatch], queries: tuple, weights: np.ndarray, k: int, limit: int = HELD) -> Iterator[tuple[int, list]]:
    """(query, its best (score, doc_id), k at most) over all blocks of a task."""
    terms, starts = queries
    stops = np.append(starts[1:], len(terms))
    best: list[list] = [[] for _ in starts]
    floor = np.zeros(len(starts), np.int64)

    def visit(blocks: list[_Block]) -> None:
        bounds = np.stack([b.bounds(terms, starts) for b in blocks], axis=1)
        for query, bound in enumerate(bounds):
            for number in np.argsort(-bound, kind="stable").tolist():
                # An equal score may still come before by its id.
                if not bound[number] or bound[number] < floor[query]:
                    break
                block = blocks[number]
                scores = block.scores(terms[starts[query] : stops[query]])
                found = np.flatnonzero(scores >= max(1, floor[query]))
                if len(found) > k:
                    # Documents of a block are in ascending order, so among equals the first ones stay.
                    found = found[np.lexsort((found, -scores[found]))[:k]]
                if not len(found):
                    continue
                best[query] += [(int(scores[i]), block.docs[i]) for i in found.tolist()]
                best[query] = sorted(best[query], key=_order)[:k]
                if len(best[query]) == k:
                    floor[query] = best[query][-1][0]

    held, size = [], 0
    for batch in batches:
        for row in batch.to_pylist():
            held.append(_Block(row, weights))
            size += len(row["postings"]) * 3 + 40 * len(row["docs"])
            if size > limit:
                visit(held)
                held, size = [], 0
    if held:
        visit(held)
    yield from enumerate(best)


def _order(found: tuple) -> tuple:
    score, doc = found
    return (-score, doc is None, doc if doc is not None else 0)


def search(index: DataFrame, queries: tuple[np.ndarray, np.ndarray], weights: np.ndarray, k: int) -> DataFrame:
    """query (its number), doc_id, score: the ``k`` best documents of each query, those with a score above 0."""
    spark = index.sparkSession
    shared = spark.sparkContext.broadcast((queries, weights))
    doc_id = index.schema["docs"].dataType.elementType
    schema = T.StructType([T.StructField("query", T.IntegerType()), T.StructField("doc_id", doc_id), T.StructField("score", T.LongType())])

    batch_type, limit = to_arrow_type(doc_id), HELD

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = shared.value
        for query, found in _best(batches, queries, weights, k, limit):
            if found:
                arrays = [
                    pa.array([query] * len(found), pa.int32()),
                    pa.array([d for _, d in found], batch_type),
                    pa.array([s for s, _ in found], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    found = index.mapInArrow(run, schema)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # First among some of the tasks, so that no task gets the best of all tasks for a query.
    salted = found.withColumn("salt", F.spark_partition_id() % F.lit(64))
    some = salted.withColumn("place", F.row_number().over(Window.partitionBy("query", "salt").orderBy(*order))).where(F.col("place") <= k)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= k)
    ranked = cut_lineage(ranked.select("query", "rank", "doc_id", "score"), "ranked")
    shared.destroy()
    return ranked


def _slices(wanted: DataFrame) -> Iterator[tuple[list, list[list[str]]]]:
    """Queries and their terms, as many at a time as have TERMS terms together."""
    gathered = wanted.groupBy("query_id").agg(F.array_sort(F.collect_list("term")).alias("terms"))
    ids, terms, total = [], [], 0
    for row in gathered.orderBy("query_id").toLocalIterator():
        ids.append(row.query_id)
        terms.append(row.terms)
        total += len(row.terms)
        if total >= TERMS:
            yield ids, terms
            ids, terms, total = [], [], 0
    if ids:
        yield ids, terms


def rank_documents(docs: DataFrame, queries: DataFrame, k: int = 50) -> DataFrame:
    """query_id, rank, doc_id, score: the ``k`` best of ``docs`` for each of ``queries`` (query_id, text).

    All rows of ``docs`` (doc_id, text) with a term are ranked over their whole texts, repeated rows
    each for itself; null and empty texts have no term. Equal scores come by ascending doc_id, a
    null one last. Rows of ``queries`` with the same id are one query; one without a term, or whose
    terms no document has, gives no row, and neither does an empty table on either side. Other
    columns may have any name.
    """
    spark = docs.sparkSession
    answers = None
    wanted = cut_lineage(query_terms(queries), "wanted")
    for ids, terms in _slices(wanted):
        vocabulary = sorted({t for q in terms for t in q})
        number = {t: i for i, t in enumerate(vocabulary)}
        counted = count_terms(docs, {t.encode(): i for t, i in number.items()})
        documents, total = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not documents:
            break
        found = Statistics(documents, total)
        # One row for each term of these queries.
        df = dict(counted.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator())
        weights = np.zeros(len(vocabulary), np.int64)
        for term, n in df.items():
            weights[term] = int(np.floor(1000 * np.log((2 * documents + 2) / (2 * n + 1))))
        flat = np.array([number[t] for q in terms for t in sorted(q)], np.int32)
        starts = np.cumsum([0, *[len(q) for q in terms[:-1]]]).astype(np.int64)
        ranked = search(build_index(counted, found), (flat, starts), weights, k)
        id_type = wanted.schema["query_id"]
        names = spark.createDataFrame([(i, q) for i, q in enumerate(ids)], T.StructType([T.StructField("query", T.IntegerType()), id_type]))
        part = ranked.join(names, "query").select("query_id", "rank", "doc_id", "score")
        answers = part if answers is None else answers.union(part)
    if answers is None:
        schema = T.StructType([wanted.schema["query_id"], T.StructField("rank", T.IntegerType()), docs.select("doc_id").schema[0], T.StructField("score", T.LongType())])
        return spark.createDataFrame([], schema)
    return answers
