"""Line dedup over the corpus: hashes in range order, streamed, with bitmaps as the result.

Lines are shuffled as 128-bit hashes with their document and position, range-partitioned and sorted
by all of these, so that a line found everywhere spreads over many partitions. Each partition is
streamed: groups that lie within it are decided on the spot, the two that may go on next door are
settled by a second, small step. Text is moved once, to meet its bitmap.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchmill.session import cut_lineage

BLANKS = b" \t\n\x0b\x0c\r"

#: What the stream says of a line: it goes; its group may go on next door; its group is frequent,
#: may have begun next door, and this is its first line here.
DROPPED, OPEN, FIRST = 0, 1, 2


def line_key(line: bytes) -> bytes:
    """A line stripped of ASCII white space at both ends, A-Z lower-cased."""
    return line.strip(BLANKS).lower()


def text_hash(text: Column) -> Column:
    """Tells rows with the same doc_id and different texts apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """h1, h2 (the key's hash), doc_id, version, pos, n_lines for each line with a key that counts."""
    doc_id = docs.select("doc_id").schema[0].dataType
    schema = T.StructType(
        [
            T.StructField("h1", T.LongType()),
            T.StructField("h2", T.LongType()),
            T.StructField("doc_id", doc_id),
            T.StructField("version", T.LongType()),
            T.StructField("pos", T.IntegerType()),
            T.StructField("n_lines", T.IntegerType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, rows, positions, counts = [], [], [], []
            for row, text in enumerate(batch.column("text")):
                lines = (text.as_py() or "").encode().split(b"\n")
                for pos, line in enumerate(lines):
                    key = line_key(line)
                    if len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars):
                        digests.append(hashlib.blake2b(key, digest_size=16).digest())
                        rows.append(row)
                        positions.append(pos)
                        counts.append(len(lines))
            hashes = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            taken = pa.array(rows, pa.int64())
            arrays = [
                pa.array(hashes[:, 0]),
                pa.array(hashes[:, 1]),
                batch.column("doc_id").take(taken),
                batch.column("version").take(taken),
                pa.array(positions, pa.int32()),
                pa.array(counts, pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.select("doc_id", text_hash(F.col("text")).alias("version"), "text").mapInArrow(run, schema)


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal neighbours once: the lines of a repeated row say nothing new, and no range parts them."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.array(batch.column(c).to_pylist(), object) for c in ("h1", "h2", "doc_id", "version", "pos")]
        again = np.ones(batch.num_rows, bool)
        for column in columns:
            again[1:] &= (column[1:] == column[:-1]).astype(bool)
        again[0] = last == tuple(c[0] for c in columns)
        last = tuple(c[-1] for c in columns)
        left = batch.filter(pa.array(~again)) if again.any() else batch
        if left.num_rows:
            yield left


def _stream(batches: Iterator[pa.RecordBatch], min_docs: int, keep_first: bool) -> Iterator[pa.RecordBatch]:
    """Decide the lines of one sorted partition, but for what may go on in its neighbours.

    Held are the lines of one group only, and of that only while it has fewer than ``min_docs``
    documents. The rest of a frequent group passes through.
    """
    held: list[pa.RecordBatch] = []
    hash_now, docs_now, last_doc = None, 0, None
    first_group = True

    def emit(rows: pa.RecordBatch, state: int) -> pa.RecordBatch:
        return rows.append_column("state", pa.array(np.full(rows.num_rows, state, np.int8)))

    def frequent(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The lines held when their group becomes frequent: all go, but the first may stay."""
        first, rest = rows[0].slice(0, 1), [rows[0].slice(1), *rows[1:]]
        if first_group:
            yield emit(first, FIRST)
        elif not keep_first:
            yield emit(first, DROPPED)
        for part in rest:
            if part.num_rows:
                yield emit(part, DROPPED)

    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2 = batch.column("h1").to_numpy(), batch.column("h2").to_numpy()
        version = batch.column("version").to_numpy()
        ids = batch.column("doc_id")
        same_hash = np.concatenate([[(h1[0], h2[0]) == hash_now], (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])])
        same_id = np.array(ids.slice(1).to_pylist(), object) == np.array(ids.slice(0, len(ids) - 1).to_pylist(), object)
        same_doc = np.concatenate([[(ids[0].as_py(), version[0]) == last_doc], same_id.astype(bool) & (version[1:] == version[:-1])])
        new_doc = ~(same_hash & same_doc)
        cuts = np.flatnonzero(~same_hash)
        if not len(cuts) or cuts[0] != 0:
            cuts = np.concatenate([[0], cuts])
        seen = np.cumsum(new_doc)
        dropped_from = np.zeros(batch.num_rows, bool)
        for start, stop in zip(cuts.tolist(), [*cuts[1:].tolist(), batch.num_rows], strict=True):
            if not same_hash[start]:
                if held and first_group:  # the first group ended without becoming frequent: it may have begun next door
                    for part in held:
                        yield emit(part, OPEN)
                if hash_now is not None:
                    first_group = False
                held, docs_now = [], 0
                hash_now = (h1[start], h2[start])
            was = docs_now
            docs_now += int(seen[stop - 1] - (seen[start - 1] if start else 0))
            if was >= min_docs:
                dropped_from[start:stop] = True
            elif docs_now >= min_docs:
                yield from frequent([*held, batch.slice(start, stop - start)])
                held = []
            elif stop == batch.num_rows or first_group:
                held.append(batch.slice(start, stop - start))
            else:
                held = []
        if dropped_from.any():
            yield emit(batch.filter(pa.array(dropped_from)), DROPPED)
        last_doc = (ids[-1].as_py(), version[-1])
    for part in held:  # the last group may go on next door
        yield emit(part, OPEN)
    if hash_now is not None and docs_now >= min_docs and not first_group:
        # The last group is frequent, which its lines next door have to know. Its first line here has been decided.
        yield pa.RecordBatch.from_arrays(
            [pa.array([hash_now[0]], pa.int64()), pa.array([hash_now[1]], pa.int64()), *[pa.nulls(1, batch.schema.field(i).type) for i in range(2, 6)], pa.array([FIRST], pa.int8())],
            names=[*batch.schema.names, "state"],
        )


def dropped_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = True) -> DataFrame:
    """doc_id, version, pos, n_lines of every line that goes.

    Lines whose key is in at least ``min_docs`` documents go, but for the first one by doc_id and
    position if ``keep_first``. Rows with the same doc_id and text are one document.
    """
    lines = _lines(docs, min_chars)
    order = ["h1", "h2", "doc_id", "version", "pos"]
    lines = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = T.StructType([*lines.schema.fields, T.StructField("state", T.ByteType())])
    told = lines.mapInArrow(lambda batches: _stream(_distinct(batches), min_docs, keep_first), schema)
    told = cut_lineage(told, "lines")
    unsettled = told.where(F.col("state") != DROPPED)
    # A few rows for each partition: per group at most two ends with fewer than min_docs documents.
    known = unsettled.groupBy("h1", "h2").agg(
        F.max("state").alias("most"),
        F.count_distinct(F.when(F.col("state") == OPEN, F.struct("doc_id", "version"))).alias("n_docs"),
        F.bool_or(F.col("pos").isNull()).alias("began"),
        F.min(F.when(F.col("pos").isNotNull(), F.struct("doc_id", "version", "pos"))).alias("first"),
    )
    known = cut_lineage(known.where((F.col("most") == FIRST) | (F.col("n_docs") >= min_docs)), "ends")
    line = F.struct("doc_id", "version", "pos")
    settled = unsettled.where(F.col("pos").isNotNull()).join(known, ["h1", "h2"])
    if keep_first:
        # A group that began within a partition and became frequent there has kept its first line already.
        settled = settled.where(F.col("began") | ~line.eqNullSafe(F.col("first")))
    columns = ["doc_id", "version", "pos", "n_lines"]
    return told.where(F.col("state") == DROPPED).select(columns).union(settled.select(columns))


def _bitmap(positions: list[int], n_lines: int) -> bytes:
    keep = np.ones(n_lines, np.uint8)
    keep[positions] = 0
    return zlib.compress(np.packbits(keep).tobytes())


def read_bitmap(bitmap: bytes, n_lines: int) -> np.ndarray:
    """Whether each line stays."""
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).astype(bool)


def keep_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = True) -> DataFrame:
    """doc_id, version, n_lines, n_dropped, keep: a compressed bitmap for each document that loses lines.

    A document without a row keeps all of its lines. Null and empty texts are one empty line, whose
    key is too short to count.
    """
    gone = dropped_lines(docs, min_docs, min_chars, keep_first)
    lists = gone.groupBy("doc_id", "version").agg(F.max("n_lines").alias("n_lines"), F.collect_set("pos").alias("gone"))

    @F.arrow_udf(T.BinaryType())
    def packed(gone_lists: pa.Array, counts: pa.Array) -> pa.Array:
        return pa.array([_bitmap(g.as_py(), n.as_py()) for g, n in zip(gone_lists, counts, strict=True)], pa.binary())

    return lists.select("doc_id", "version", F.col("n_lines"), F.size("gone").alias("n_dropped"), packed("gone", "n_lines").alias("keep"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The rows of ``docs`` with kept_text, n_lines and n_dropped for their columns' like-named ones.

    Texts without a bitmap stay as they are, null texts null.
    """

    @F.arrow_udf(T.StringType())
    def kept(texts: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, keep, n_lines in texts:
            out = []
            for t, k, n in zip(text, keep, n_lines, strict=True):
                lines = t.as_py()
                if k.is_valid:
                    stays = read_bitmap(k.as_py(), n.as_py())
                    lines = "\n".join([line for line, s in zip(lines.split("\n"), stays, strict=True) if s])
                out.append(lines)
            yield pa.array(out, pa.string())

    marks = cut_lineage(bitmaps, "bitmaps").select(
        F.col("doc_id").alias("__doc"),
        F.col("version").alias("__version"),
        F.col("n_lines").alias("__lines"),
        F.col("n_dropped").alias("__dropped"),
        F.col("keep").alias("__keep"),
    )
    joined = docs.withColumn("__own", text_hash(F.col("text")))
    joined = joined.join(marks, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__own") == F.col("__version")), "left")
    n_lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1))
    return joined.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in ("kept_text", "n_lines", "n_dropped")],
        kept("text", "__keep", "__lines").alias("kept_text"),
        n_lines.cast("long").alias("n_lines"),
        F.coalesce("__dropped", F.lit(0)).cast("long").alias("n_dropped"),
    )
