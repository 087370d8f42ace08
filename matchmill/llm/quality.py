"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of every whole text are taken where its partition is. The trees are fitted on the
statistics of a bounded sample of labelled documents, flattened into arrays of one fixed depth and
sent out; a batch of documents goes down all trees at once, level by level.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Labelled rows that the trees are fitted on: those with the smallest hash of their id.
SAMPLE_ROWS = 20_000

#: Bytes compressed at a time; a longer text's ratio is that of all of its parts together.
CHUNK = 1 << 20

_CLASSES = {
    "upper": [c for c in range(0x41, 0x5B)],
    "lower": [c for c in range(0x61, 0x7B)],
    "digit": [c for c in range(0x30, 0x3A)],
    "blank": [0x20, 0x09, 0x0B, 0x0C, 0x0D],
    "line_end": [0x0A],
    "stop": [ord(c) for c in ".,;:?"],
    "bang": [ord("!")],
    "bracket": [ord(c) for c in "()[]{}<>"],
    "quote": [ord(c) for c in "\"'`"],
    "symbol": [ord(c) for c in "#$%&*+=@^~|\\/_-"],
    "wide": [c for c in range(0x80, 0x100)],
}
_MASKS = np.zeros((256, len(_CLASSES)))
for _i, _members in enumerate(_CLASSES.values()):
    _MASKS[_members, _i] = 1.0

FEATURES = [
    *(f"share_{name}" for name in _CLASSES),
    "log_bytes",
    "log_words",
    "word_length",
    "longest_word",
    "distinct_words",
    "distinct_pairs",
    "top_word",
    "symbol_words",
    "upper_words",
    "lines",
    "distinct_lines",
    "short_lines",
    "compressed",
]


def _words_statistics(data: bytes) -> list[float]:
    words = data.split()
    n = max(1, len(words))
    lines = [x for x in data.split(b"\n") if x]
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    squeezed, packer = 0, zlib.compressobj(1)
    for start in range(0, len(data), CHUNK):
        squeezed += len(packer.compress(data[start : start + CHUNK]))
    squeezed += len(packer.flush())
    return [
        np.log1p(len(data)),
        np.log1p(len(words)),
        sum(map(len, words)) / n,
        np.log1p(max(map(len, words), default=0)),
        len(counts) / n,
        len(set(zip(words, words[1:], strict=False))) / n,
        max(counts.values(), default=0) / n,
        sum(c for w, c in counts.items() if w[-1] in b"#$%&*+=|~^@") / n,
        sum(c for w, c in counts.items() if w.isupper()) / n,
        np.log1p(len(lines)),
        len(set(lines)) / max(1, len(lines)),
        sum(len(x) < 20 for x in lines) / max(1, len(lines)),
        squeezed / (len(data) + 20),
    ]


def statistics(texts: list[str | None]) -> np.ndarray:
    """A row of FEATURES for each text; null counts as empty."""
    out = np.zeros((len(texts), len(FEATURES)))
    for i, text in enumerate(texts):
        data = (text or "").encode()
        counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
        out[i, : len(_CLASSES)] = counts @ _MASKS / max(1, len(data))
        out[i, len(_CLASSES) :] = _words_statistics(data)
    return out


@dataclass
class Forest:
    """Trees of one depth as arrays: inner nodes by level, then leaves. A row goes right if over the threshold."""

    depth: int
    base: float
    feature: np.ndarray  # (trees, 2**depth - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # (trees, 2**depth)

    def probability(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        margin = np.full(len(x), self.base)
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            margin += leaf[node - (2**self.depth - 1)]
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 1.0) -> Forest:
    """Boost trees on the logistic loss; each split is sought over histograms of binned values.

    Without rows the probability is 0.5, with one class only near that class.
    """
    n, width = x.shape
    base = float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5))) if n else 0.0
    inner, leaves = 2**depth - 1, 2**depth
    if n == 0 or y.min() == y.max():
        return Forest(depth, base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(width)], axis=1)
    flat = binned + np.arange(width) * bins
    margin = np.full(n, base)
    all_features, all_thresholds, all_leaves = [], [], []
    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        gradient, hessian = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            size = count * width * bins
            cell = ((node - first)[:, None] * (width * bins) + flat).ravel()
            g = np.bincount(cell, np.repeat(gradient, width), size).reshape(count, width, bins).cumsum(axis=2)
            h = np.bincount(cell, np.repeat(hessian, width), size).reshape(count, width, bins).cumsum(axis=2)
            g_all, h_all = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (g_all - g) ** 2 / (h_all - h + ridge) - g_all**2 / (h_all + ridge)
            gain[(h < 1.0) | (h_all - h < 1.0)] = 0.0
            best = gain.reshape(count, -1).argmax(axis=1)
            for k in range(count):
                f, b = divmod(int(best[k]), bins)
                if gain[k, f, b] > 1e-9 and b < len(edges[f]):
                    feature[first + k], threshold[first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        at = node - inner
        leaf = -rate * np.bincount(at, gradient, leaves) / (np.bincount(at, hessian, leaves) + ridge)
        margin += leaf[at]
        all_features.append(feature)
        all_thresholds.append(threshold)
        all_leaves.append(leaf)
    return Forest(depth, base, np.array(all_features), np.array(all_thresholds), np.array(all_leaves))


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept from training: crc32 of its id as text divides by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, sample_rows: int) -> DataFrame:
    """doc_id, text, label of at most ``sample_rows`` labelled documents, none of them held out.

    Null labels and ids are left out; of several labels of one document the largest counts.
    The sample is sent to the documents: its size is bounded by the parameter, ids and labels only.
    A repeated id counts once, with one of its texts, so the parameter bounds the rows too.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id is not null and label is not null")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label")
    return rows.agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("doc_id", "text", "label")


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, **options) -> Forest:
    """Fit the trees to ``labels.quality``; texts are the only input of a score."""
    rows = training_rows(docs, labels, "quality", sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics(batch.column("text").to_pylist())
            arrays = [batch.column("doc_id"), batch.column("label"), pa.array(list(x), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "label", "x"])

    kind = rows.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("label", T.IntegerType()), T.StructField("x", T.ArrayType(T.DoubleType()))])
    found = sorted(rows.mapInArrow(run, schema).collect(), key=lambda r: (r.doc_id, r.x))
    x = np.array([r.x for r in found], float).reshape(len(found), len(FEATURES))
    return fit(x, np.array([r.label for r in found], float), **options)


def scorer(spark, forest: Forest):
    """A column function: the probability that a text is good; null counts as empty."""
    shared = spark.sparkContext.broadcast(forest)

    @F.arrow_udf(T.DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(shared.value.probability(statistics(batch.to_pylist())), pa.float64())

    return score


def score_documents(docs: DataFrame, forest: Forest, cut: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``, repeated rows too.

    Only doc_id and text are read. A null id is not held out.
    """
    score = scorer(docs.sparkSession, forest)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def keep_good(docs: DataFrame, forest: Forest, cut: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score at least ``cut``, as they are; a null text is scored as an empty one."""
    return docs.where(scorer(docs.sparkSession, forest)("text") >= cut)
