"""Toxicity by a classifier chain of linear models over words.

The categories are scored one after the other; each model sees the words and the probabilities of
the categories before it. In training those probabilities are out of fold: each comes from a model
that has not seen the document, as will be so when new documents are scored.

The vocabulary and the weights are fitted on a bounded sample of labelled documents; scoring reads
every whole text where its partition is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchmill.session import cut_lineage

#: Labelled rows that the chain is fitted on (those with the smallest hash of their id) and words in its vocabulary per category.
SAMPLE_ROWS, VOCABULARY = 20_000, 512

FOLDS = 3

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> set[str]:
    """The distinct words of a whole text, lower-cased; null has none."""
    return set(_WORD.findall((text or "").lower()))


@dataclass
class Linear:
    bias: float
    weights: np.ndarray

    def probability(self, rows: Sparse, dense: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(rows.times(self.weights[: rows.width]) + dense @ self.weights[rows.width :] + self.bias, -40, 40)))


@dataclass
class Sparse:
    """Rows of ones: the word numbers of row i are ``words[ends[i - 1]:ends[i]]``."""

    words: np.ndarray
    counts: np.ndarray
    width: int
    _row: np.ndarray = field(init=False)

    def __post_init__(self):
        self._row = np.repeat(np.arange(len(self.counts)), self.counts)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self._row, weights[self.words], len(self.counts))

    def transposed_times(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.words, values[self._row], self.width)

    def take(self, rows: np.ndarray) -> Sparse:
        kept = np.zeros(len(self.counts), bool)
        kept[rows] = True
        return Sparse(self.words[kept[self._row]], self.counts[kept], self.width)

    def only(self, kept: np.ndarray) -> Sparse:
        """The rows without the words that are not ``kept``."""
        stays = kept[self.words]
        return Sparse(self.words[stays], np.bincount(self._row[stays], minlength=len(self.counts)), self.width)


def fit_linear(rows: Sparse, dense: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 150, rate: float = 0.1) -> Linear:
    """Logistic regression by Adam over all rows; the classes weigh the same.

    With rows of one class only, or none, the probability is near that class or 0.5.
    """
    n, positive = len(y), float(y.sum())
    width = rows.width + dense.shape[1]
    if positive in (0.0, float(n)):
        return Linear(float(np.log((positive + 0.5) / (n - positive + 0.5))), np.zeros(width))
    weight = np.where(y > 0, 0.5 * n / positive, 0.5 * n / (n - positive))
    theta, first, second = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):
        p = Linear(theta[-1], theta[:-1]).probability(rows, dense)
        off = weight * (p - y)
        gradient = np.concatenate([rows.transposed_times(off), dense.T @ off, [off.sum()]])
        gradient[:-1] += ridge * theta[:-1]
        gradient /= n
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Linear(float(theta[-1]), theta[:-1])


@dataclass
class Chain:
    categories: tuple[str, ...]
    vocabulary: dict[str, int]
    models: list[Linear]
    cuts: list[float]

    def rows(self, texts: list[str | None]) -> Sparse:
        known = [[self.vocabulary[w] for w in words_of(t) & self.vocabulary.keys()] for t in texts]
        flat = np.array([w for row in known for w in row], np.int64)
        return Sparse(flat, np.array([len(r) for r in known], np.int64), len(self.vocabulary))

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        rows = self.rows(texts)
        dense = np.zeros((len(texts), 0))
        for model in self.models:
            dense = np.column_stack([dense, model.probability(rows, dense)])
        return dense


def best_cut(p: np.ndarray, y: np.ndarray) -> float:
    """The probability that parts the classes with the best F1; 0.5 if there is but one class."""
    if not 0 < y.sum() < len(y):
        return 0.5
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    at = int(f1.argmax())
    below = p[order[at + 1]] if at + 1 < len(y) else 0.0
    return float((p[order[at]] + below) / 2)


def fit_chain(
    categories: Sequence[str], vocabulary: dict[str, int], rows: Sparse, labels: np.ndarray, fold: np.ndarray, words: np.ndarray | None = None
) -> Chain:
    """Models in the order of ``categories`` (columns of ``labels``); ``fold`` numbers each row's fold.

    ``words`` marks, in a row for each category, the words that its model may weigh (all, if not given).
    """
    dense = np.zeros((len(fold), 0))
    models, cuts, every = [], [], rows
    for at in range(len(categories)):
        y = labels[:, at]
        rows = every if words is None else every.only(words[at])
        models.append(fit_linear(rows, dense, y))
        unseen = np.zeros(len(fold))
        for k in range(FOLDS):
            inside, outside = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            unseen[outside] = fit_linear(rows.take(inside), dense[inside], y[inside]).probability(rows.take(outside), dense[outside])
        cuts.append(best_cut(unseen, y))
        dense = np.column_stack([dense, unseen])
    return Chain(tuple(categories), vocabulary, models, cuts)


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, str], sample_rows: int = SAMPLE_ROWS, vocabulary: int = VOCABULARY) -> Chain:
    """Fit a chain; ``categories`` maps each name, in order, to a SQL expression of the labels' columns that is 0 or 1.

    Rows with a null id or category are left out; of several labels of a document the largest of
    each category counts. The sample's ids and labels, bounded by ``sample_rows``, are sent to the
    documents. A repeated id counts once, with one of its texts. Each category has a vocabulary of its own,
    the ``vocabulary`` words that tell it best; words found in fewer than five sampled documents are in none.
    """
    names = list(categories)
    known = labels.select("doc_id", *[F.expr(e).cast("int").alias(f"c{i}") for i, e in enumerate(categories.values())]).dropna()
    known = known.groupBy("doc_id").agg(*[F.max(f"c{i}").alias(f"c{i}") for i in range(len(names))])
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    # However often an id is repeated, one of its texts is taken: the sample bounds the rows too.
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", *[f"c{i}" for i in range(len(names))])
    rows = cut_lineage(rows.agg(F.min_by("text", F.xxhash64("text")).alias("text")), "labelled")

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def distinct_words(texts: pa.Array) -> pa.Array:
        return pa.array([list(words_of(t.as_py())) for t in texts], pa.list_(pa.string()))

    ones = [f"c{i}" for i in range(len(names))]
    totals = rows.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ones]).first()
    per_word = rows.select(F.explode(distinct_words("text")).alias("word"), *ones).groupBy("word")
    counted = per_word.agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in ones]).where("n >= 5")
    chosen: list[set[str]] = []
    for c in ones:
        with_it, without = F.col(c) + 0.5, F.col("n") - F.col(c) + 0.5
        rest_with, rest_without = totals[c] - F.col(c) + 0.5, totals["n"] - totals[c] - (F.col("n") - F.col(c)) + 0.5
        odds = F.log(with_it) + F.log(rest_without) - F.log(without) - F.log(rest_with)
        certainty = F.abs(odds) / F.sqrt(1 / with_it + 1 / without + 1 / rest_with + 1 / rest_without)
        chosen.append({r.word for r in counted.orderBy(certainty.desc(), "word").limit(vocabulary).select("word").collect()})
    numbers = {w: i for i, w in enumerate(sorted(set().union(*chosen)))}
    own = np.array([[w in of_one for w in numbers] for of_one in chosen], bool).reshape(len(ones), len(numbers))
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def word_numbers(texts: pa.Array) -> pa.Array:
        table = shared.value
        return pa.array([sorted(table[w] for w in words_of(t.as_py()) & table.keys()) for t in texts], pa.list_(pa.int32()))

    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).alias("fold")
    found = sorted(rows.select("doc_id", fold, *ones, word_numbers("text").alias("words")).collect(), key=lambda r: (r.doc_id, r.words))
    sparse = Sparse(
        np.array([w for r in found for w in r.words], np.int64), np.array([len(r.words) for r in found], np.int64), len(numbers)
    )
    y = np.array([[r[c] for c in ones] for r in found], float).reshape(len(found), len(ones))
    return fit_chain(names, numbers, sparse, y, np.array([r.fold for r in found], np.int64), own)


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, and for each category p_<name> and is_<name>, of every row of ``docs``.

    A category holds from the probability on that parts its labels best, out of fold. Null texts
    count as empty. Only doc_id and text are read; repeated rows are repeated.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def probabilities(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(list(shared.value.probabilities(batch.to_pylist())), pa.list_(pa.float64()))

    scored = docs.select("doc_id", probabilities("text").alias("p"))
    return scored.select(
        "doc_id",
        *[F.col("p")[i].alias(f"p_{c}") for i, c in enumerate(chain.categories)],
        *[(F.col("p")[i] >= cut).alias(f"is_{c}") for i, (c, cut) in enumerate(zip(chain.categories, chain.cuts, strict=True))],
    )
