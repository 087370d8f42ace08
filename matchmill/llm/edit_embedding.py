"""Document fingerprints by a randomised embedding of edit distance into Hamming distance.

A walk over a text's characters writes the current character at every step and moves on or stays
by a coin that depends on the step and the character only. All texts share the coins, so walks over
two texts that part at an edit fall into step again soon after it. The fingerprint samples bits of
what is written at steps that all texts share too; bands of these bits find candidates, and the
share of equal bits verifies them.

The walk of a whole text takes about two steps a character. It is done for many texts at a time:
one step is a few numpy operations over all texts that are still being read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a fingerprint, and in a band.
BITS, BAND = 256, 8

#: Characters walked over at a time, a longer text aside.
BATCH_CHARS = 4_000_000

_SEED = 20240229
#: Coins repeat after so many steps.
_PERIOD = 4096
#: Texts that are read to their end are put away after so many steps.
_TIDY = 128


def _tables() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(_SEED))
    coins = rng.integers(0, 2, (_PERIOD, 256), dtype=np.int64)
    coins[:, 0] = 0  # symbol 0 is the end of a text
    return coins, rng.integers(0, 2, (BITS, 256), dtype=np.uint8)


_COINS, _SIGNS = _tables()


def _sampled(steps: int) -> Iterator[tuple[int, np.ndarray]]:
    """(step, slots): at which steps slots sample anew.

    Each slot samples the step of the smallest of random numbers drawn for all steps. The steps at
    which a smaller one turns up are drawn directly: the next after step j is beyond m with
    probability j / m. So texts of nearly the same length share nearly all of their samples.
    """
    rng = np.random.Generator(np.random.PCG64(_SEED + 1))
    at = np.zeros(BITS, np.int64)
    upcoming: dict[int, list[int]] = {0: list(range(BITS))}
    while upcoming:
        step = min(upcoming)
        if step >= steps:
            return
        slots = sorted(upcoming.pop(step))
        yield step, np.array(slots)
        for slot in slots:
            later = int((step + 1) / max(rng.random(), 1e-12))
            at[slot] = max(step + 1, later)
            upcoming.setdefault(int(at[slot]), []).append(slot)


def _symbols(text: str) -> np.ndarray:
    """Characters as numbers from 1 to 255."""
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return (1 + (code ^ (code >> 8) * 31) % 255).astype(np.uint8)


def embed(texts: list[str]) -> np.ndarray:
    """Fingerprints of texts: a row of BITS // 8 bytes each; the empty text's is all zeros."""
    order = np.array(sorted(range(len(texts)), key=lambda i: -len(texts[i])), np.int64)
    symbols = [_symbols(texts[i]) for i in order]
    lengths = np.array([len(s) for s in symbols], np.int64)
    end = np.zeros(1, np.uint8)
    flat = np.concatenate([x for s in symbols for x in (s, end)]) if texts else end
    place = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(np.int64) if texts else np.zeros(0, np.int64)
    written = np.zeros((BITS, len(texts)), np.uint8)
    alive = np.arange(len(texts))
    samples = _sampled(64 * (int(lengths.max(initial=0)) + 1))
    due, slots = next(samples, (-1, None))
    step = 0
    while True:
        if step % _TIDY == 0:
            going = flat[place] != 0
            if not going.all():
                place, alive = place[going], alive[going]
            if not len(alive):
                break
        symbol = flat[place]
        if step == due:
            reading = symbol != 0
            who, what = (alive, symbol) if reading.all() else (alive[reading], symbol[reading])
            written[np.ix_(slots, who)] = what
            due, slots = next(samples, (-1, None))
        place = place + _COINS[step % _PERIOD][symbol]
        step += 1
    bits = _SIGNS[np.arange(BITS)[:, None], written] * (written > 0)
    out = np.empty((len(texts), BITS // 8), np.uint8)
    out[order] = np.packbits(bits.T, axis=1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """From 0 (as unlike as any two texts) to 1 (equal) for rows of fingerprints."""
    far = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
    return np.maximum(0.0, 1.0 - 2.0 * far / BITS)


def edited(text: str, other: str) -> str:
    """The text with its last quarter replaced by as many first characters of the other."""
    n = len(text) // 4
    return text[: len(text) - n] + other[:n]


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text as hexadecimal digits; null counts as empty."""

    @F.arrow_udf(T.StringType())
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = [t or "" for t in batch.to_pylist()]
            yield pa.array([x for part in _parts(texts) for x in _hex(embed(part))], pa.string())

    return run(text)


def _hex(prints: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in prints]


def _parts(texts: list[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > BATCH_CHARS:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t) + 1
    if part:
        yield part


# --- neighbours in the order of ids ---------------------------------------------------------------


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text and the next document's text, by ascending doc_id; the last one's next is the first.

    Nulls come first, rows with one id in the order of their texts' hashes; a null text is empty. A
    single row's next is itself. Rows are range-partitioned and sorted, not gathered: within a task
    a row meets the one after it; the last row of a task meets the first of the next task that has
    any. Both readings share one shuffle, whose number of partitions is fixed here so that they see
    the same tasks.
    """
    order = ["doc_id", "version"]
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("version", F.xxhash64("text"))
    rows = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    id_field, text_field = rows.schema["doc_id"], T.StructField("text", T.StringType())

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows with their next one, but for the last of the task."""
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, texts, n = batch.column("doc_id"), batch.column("text"), batch.num_rows - 1
            if before is not None:
                yield pa.RecordBatch.from_arrays([*before, texts.slice(0, 1)], names=["doc_id", "text", "next"])
            yield pa.RecordBatch.from_arrays([ids.slice(0, n), texts.slice(0, n), texts.slice(1)], names=["doc_id", "text", "next"])
            before = ids.slice(n), texts.slice(n)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The first and the last row of the task."""
        task, first, last = TaskContext.get().partitionId(), None, None
        for batch in batches:
            if batch.num_rows:
                first = first or (batch.column("doc_id").slice(0, 1), batch.column("text").slice(0, 1))
                last = batch.column("doc_id").slice(batch.num_rows - 1), batch.column("text").slice(batch.num_rows - 1)
        for row, is_last in ((first, False), (last, True)):
            if row:
                marks = [pa.array([task], pa.int32()), pa.array([is_last])]
                yield pa.RecordBatch.from_arrays([*row, *marks], names=["doc_id", "text", "task", "is_last"])

    met = rows.mapInArrow(inner, T.StructType([id_field, text_field, T.StructField("next", T.StringType())]))
    marks = [T.StructField("task", T.IntegerType()), T.StructField("is_last", T.BooleanType())]
    edge = rows.mapInArrow(ends, T.StructType([id_field, text_field, *marks]))
    # Two rows a task, whatever the input.
    following = F.when(F.col("is_last"), F.lead("text").over(Window.orderBy("task", "is_last")))
    beginning = F.first_value("text").over(Window.orderBy("task", "is_last").rowsBetween(Window.unboundedPreceding, 0))
    paired = edge.select("doc_id", "text", F.coalesce(following, beginning).alias("next"), "is_last")
    return met.union(paired.where("is_last").select("doc_id", "text", "next"))


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next and bands_edited of every document.

    ``edited`` is the text with its last quarter replaced by the next document's beginning, and
    ``bands_edited`` the number of bands in which both fingerprints are equal.
    """
    rows = with_next(docs)
    schema = T.StructType(
        [
            rows.schema["doc_id"],
            T.StructField("n_chars", T.LongType()),
            T.StructField("edited", T.StringType()),
            T.StructField("fingerprint", T.StringType()),
            T.StructField("edited_fingerprint", T.StringType()),
            T.StructField("near_edited", T.DoubleType()),
            T.StructField("near_next", T.DoubleType()),
            T.StructField("bands_edited", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            texts, following = batch.column("text").to_pylist(), batch.column("next").to_pylist()
            at = 0
            for part in _parts(texts):
                stop = at + len(part)
                changed = [edited(t, n) for t, n in zip(part, following[at:stop], strict=True)]
                # The next text is mostly the next row's, which is embedded once.
                distinct = {t: i for i, t in enumerate(dict.fromkeys([*part, *changed, *following[at:stop]]))}
                prints = embed(list(distinct))
                own, new, other = (prints[[distinct[t] for t in x]] for x in (part, changed, following[at:stop]))
                bands = (own.reshape(len(part), -1, BAND // 8) == new.reshape(len(part), -1, BAND // 8)).all(axis=2).sum(axis=1)
                columns = [
                    ids.slice(at, stop - at),
                    pa.array([len(t) for t in part], pa.int64()),
                    pa.array(changed, pa.string()),
                    pa.array(_hex(own), pa.string()),
                    pa.array(_hex(new), pa.string()),
                    pa.array(likeness(own, new)),
                    pa.array(likeness(own, other)),
                    pa.array(bands.astype(np.int64)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                at = stop

    return rows.mapInArrow(run, schema)


def search(prints: DataFrame, queries: DataFrame, least: float = 0.6) -> DataFrame:
    """(query_id, doc_id, likeness) of all documents that share a band with a query and are at least so like it.

    Both tables have doc_id and fingerprint. Equal fingerprints are compared once on either side: a
    query is the smallest id of its fingerprint, and so is a document found. Bands are the join's
    keys; Spark splits a band that many share. Null fingerprints find nothing.
    """
    digits = BAND // 4

    def bands(df: DataFrame, name: str) -> DataFrame:
        distinct = df.where("fingerprint is not null").groupBy("fingerprint").agg(F.min("doc_id").alias(name))
        at = F.sequence(F.lit(0), F.lit(BITS // BAND - 1))
        with_bands = distinct.select(name, F.col("fingerprint").alias(f"{name}_print"), F.explode(at).alias("band"))
        return with_bands.withColumn("bits", F.substring(f"{name}_print", F.col("band") * digits + 1, F.lit(digits)))

    pairs = bands(queries, "query_id").join(bands(prints, "doc_id"), ["band", "bits"])
    far = sum(
        (
            F.bit_count(
                F.conv(F.substring("query_id_print", 8 * i + 1, 8), 16, 10).cast("long").bitwiseXOR(F.conv(F.substring("doc_id_print", 8 * i + 1, 8), 16, 10).cast("long"))
            )
            for i in range(BITS // 32)
        ),
        F.lit(0),
    )
    like = F.greatest(F.lit(0.0), 1 - 2 * far / BITS)
    return pairs.select("query_id", "doc_id", like.alias("likeness")).where(F.col("likeness") >= least).distinct()
