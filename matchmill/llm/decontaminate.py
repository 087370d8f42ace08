"""Benchmark decontamination by a generalised suffix automaton over the words of the test items.

The automaton reads a document's words and knows after each the longest stretch of words that ends
there and occurs in an item. Where that is at least a window, the window's words are hit.

The items come to the driver in shards of a bounded number of words; an automaton is built of each
and sent out, and the documents are read once against it. A larger benchmark means more passes,
never a larger broadcast.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from matchmill.session import cut_lineage

#: Words in one shard's automaton, which has less than twice as many states.
SHARD_WORDS = 100_000

#: Lower-cases A-Z and blanks out ASCII that is no letter or digit; bytes of other characters stay.
_NORMAL = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))
_WORD = re.compile(rb"[^ ]+")


def words_of(text: str | None) -> list[bytes]:
    """Words are runs of ASCII letters, digits and all characters outside ASCII; null has none."""
    return (text or "").encode().translate(_NORMAL).split()


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences, with the items of each window."""

    def __init__(self, window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self._items: list[tuple[object, list[int]]] = []
        self.shortest = window

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _extend(self, last: int, word: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        known = nxt[last].get(word)
        if known is not None and length[known] == length[last] + 1:
            return known
        new = None if known is not None else self._state(length[last] + 1, 0, {})
        at = last
        while at != -1 and word not in nxt[at]:
            nxt[at][word] = new
            at = link[at]
        if at == -1:
            return new
        target = nxt[at][word]
        if length[target] == length[at] + 1:
            link[new] = target
            return new
        copy = self._state(length[at] + 1, link[target], dict(nxt[target]))
        while at != -1 and nxt[at].get(word) == target:
            nxt[at][word] = copy
            at = link[at]
        link[target] = copy
        if new is None:
            return copy
        link[new] = copy
        return new

    def add(self, item, words: list[bytes]) -> None:
        if not words:
            return
        ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
        last = 0
        for word in ids:
            last = self._extend(last, word)
        self._items.append((item, ids))
        self.shortest = min(self.shortest, len(ids))

    def finish(self) -> SuffixAutomaton:
        """Note which windows (length, items) end at each state, by reading every item again."""
        found: dict[int, dict[int, set]] = defaultdict(lambda: defaultdict(set))
        for item, ids in self._items:
            size = min(self.window, len(ids))
            state = matched = 0
            for i, word in enumerate(ids):
                state, matched = self.step(state, matched, word, size)
                if i + 1 >= size:
                    found[state][size].add(item)
        self._items = []
        # A state's shorter windows are those of the states its suffix links lead to.
        self.windows: list[tuple[tuple[int, frozenset], ...]] = [()] * len(self.length)
        for state in sorted(range(len(self.length)), key=self.length.__getitem__):
            own = tuple((size, frozenset(items)) for size, items in found[state].items()) if state in found else ()
            self.windows[state] = own + (self.windows[self.link[state]] if state else ())
        return self

    def step(self, state: int, matched: int, word: int, most: int) -> tuple[int, int]:
        """Read a word: the state of the longest match that ends with it, of ``most`` words or fewer."""
        nxt, link, length = self.next, self.link, self.length
        while state and word not in nxt[state]:
            state = link[state]
            matched = length[state]
        state = nxt[state].get(word, 0)
        matched = matched + 1 if state else 0
        if matched > most:
            matched = most
        while state and length[link[state]] >= matched:
            state = link[state]
        return state, matched

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Hit spans [begin, end) in word positions, merged, and the items of their windows."""
        get = self.vocabulary.get
        ids = np.array([get(w, -1) for w in words], np.int64)
        known = np.concatenate([[False], ids >= 0, [False]])
        edges = np.flatnonzero(known[1:] != known[:-1])
        spans: list[list[int]] = []
        items: set = set()
        for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if end - begin < self.shortest:
                continue
            state = matched = 0
            for i, word in enumerate(ids[begin:end].tolist(), begin):
                state, matched = self.step(state, matched, word, self.window)
                for size, owners in self.windows[state]:
                    if size <= matched:
                        items |= owners
                        first = i + 1 - size
                        while spans and first <= spans[-1][0]:
                            spans.pop()
                        if spans and first <= spans[-1][1]:
                            spans[-1][1] = i + 1
                        else:
                            spans.append([first, i + 1])
        return [(a, b) for a, b in spans], items


def _shards(benchmark: DataFrame, window: int) -> Iterator[SuffixAutomaton]:
    """Automata of the items with words, each of at most SHARD_WORDS (one item's windows may exceed that)."""
    automaton, size = SuffixAutomaton(window), 0
    for row in benchmark.select("item_id", "text").where("text is not null").toLocalIterator():
        words = words_of(row.text)
        # A very long item is cut into parts that share window - 1 words, so that no window is lost.
        for start in range(0, max(1, len(words) - window + 1), SHARD_WORDS):
            part = words[start : start + SHARD_WORDS + window - 1]
            if size and size + len(part) > SHARD_WORDS:
                yield automaton.finish()
                automaton, size = SuffixAutomaton(window), 0
            automaton.add(row.item_id, part)
            size += len(part)
    yield automaton.finish()


def _version(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _scan(docs: DataFrame, automaton: SuffixAutomaton, item_type: T.DataType, every: bool) -> DataFrame:
    """One pass over the documents; only those that are hit unless ``every``."""
    shared = docs.sparkSession.sparkContext.broadcast(automaton)
    span = T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())])
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.select("doc_id").schema[0].dataType),
            T.StructField("version", T.LongType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("spans", T.ArrayType(span)),
            T.StructField("items", T.ArrayType(item_type)),
        ]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, n_words, spans, items = [], [], [], []
            for row, text in enumerate(batch.column("text")):
                words = words_of(text.as_py())
                hit, owners = shared.value.scan(words)
                if every or hit:
                    rows.append(row)
                    n_words.append(len(words))
                    spans.append([{"begin": a, "end": b} for a, b in hit])
                    items.append(sorted(x for x in owners if x is not None))
            taken = pa.array(rows, pa.int64())
            made = [pa.array(x, field.type) for x, field in zip((n_words, spans, items), list(arrow)[2:], strict=True)]
            columns = [batch.column("doc_id").take(taken), batch.column("version").take(taken), *made]
            yield pa.RecordBatch.from_arrays(columns, names=arrow.names)

    return docs.select("doc_id", _version(F.col("text")).alias("version"), "text").mapInArrow(run, schema)


def find_windows(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, version, n_words, spans (begin, end in words) and items of every row of ``docs``.

    A window is ``window`` consecutive words of an item, or a shorter item's all words. Items with
    a null text or no words have none; items with a null id hit words but are not listed. Repeated
    items count once. ``version`` tells rows with one doc_id and different texts apart. Spans of one
    shard do not overlap; those of several may. Only doc_id and text are read.
    """
    item_type = benchmark.select("item_id").schema[0].dataType
    found, more = None, None
    for automaton in _shards(benchmark, window):
        part = _scan(docs, automaton, item_type, every=found is None)
        if found is None:
            found = part
        else:
            more = part if more is None else more.union(part)
    if more is None:
        return found
    more = more.groupBy("doc_id", "version").agg(
        F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    )
    more = cut_lineage(more, "windows").select(*[F.col(c).alias(f"more_{c}") for c in ("doc_id", "version", "spans", "items")])
    both = found.join(more, F.col("doc_id").eqNullSafe(F.col("more_doc_id")) & (F.col("version") == F.col("more_version")), "left")

    def merged(name: str) -> Column:
        other = F.coalesce(f"more_{name}", F.slice(name, 1, 0))
        return F.array_sort(F.array_distinct(F.concat(name, other))).alias(name)

    return both.select("doc_id", "version", "n_words", merged("spans"), merged("items"))


def hit_words(spans: Column) -> Column:
    """How many words sorted spans cover, an overlap counted once."""
    start = F.struct(F.lit(0).alias("covered"), F.lit(0).alias("upto"))
    total = F.aggregate(
        spans,
        start,
        lambda acc, s: F.struct(
            (acc["covered"] + F.greatest(F.lit(0), s["end"] - F.greatest(acc["upto"], s["begin"]))).alias("covered"),
            F.greatest(acc["upto"], s["end"]).alias("upto"),
        ),
    )
    return total["covered"].cast("long")


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    data = text.encode()
    ends = [m.span() for m in _WORD.finditer(data.translate(_NORMAL))]
    parts, at = [], 0
    for begin, end in spans:
        parts.append(data[at : ends[begin][0]])
        at = ends[end - 1][1]
    return b"".join([*parts, data[at:]]).decode()


def remove_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, min_span: int = 10, max_coverage: float = 0.5) -> DataFrame:
    """``docs`` without benchmark passages, all columns kept.

    Hit spans of at least ``min_span`` words, or of all of a shorter item, are cut out of the text.
    A document of whose words more than ``max_coverage`` is hit goes. Others, null and empty texts
    among them, stay as they are.
    """
    schema = docs.schema
    at = docs.columns.index("text")
    item_type = benchmark.select("item_id").schema[0].dataType
    found, shortest = None, window
    for automaton in _shards(benchmark, window):
        shortest = min(shortest, automaton.shortest)
        part = _scan(docs, automaton, item_type, every=False).select("doc_id", "version", F.explode("spans").alias("span")).distinct()
        part = cut_lineage(part, "windows")
        found = part if found is None else found.union(part)
    # Judged and cut once, by the windows of all shards in the text as it was.
    hits = found.groupBy(F.col("doc_id").alias("__hit_doc"), F.col("version").alias("__hit_version")).agg(F.array_sort(F.collect_set("span")).alias("__spans"))
    hits = cut_lineage(hits, "hits")
    same = F.col("doc_id").eqNullSafe(F.col("__hit_doc")) & (_version(F.col("text")) == F.col("__hit_version"))
    marked = docs.join(hits, same, "left").drop("__hit_doc", "__hit_version")
    least = min(min_span, shortest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, stay = [], []
            for value, hit in zip(batch.column(at), batch.column(batch.num_columns - 1), strict=True):
                text = value.as_py()
                spans = _merged((s["begin"], s["end"]) for s in hit.as_py() or ())
                covered = sum(b - a for a, b in spans)
                stay.append(not spans or covered <= max_coverage * len(words_of(text)))
                spans = [(a, b) for a, b in spans if b - a >= least]
                texts.append(cut_spans(text, spans) if spans else text)
            columns = list(batch.columns)[:-1]
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema.remove(len(columns))).filter(pa.array(stay, pa.bool_()))

    return marked.mapInArrow(run, schema)


def _merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans, those that overlap or touch made one."""
    out: list[tuple[int, int]] = []
    for begin, end in spans:
        if out and begin <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((begin, end))
    return out
