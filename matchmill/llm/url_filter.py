"""URL filters: all glob rules at once over each canonical URL, by a bit-parallel automaton.

Each rule is a glob over ``.host/path``. The literals of all globs are packed one after the other
into multiword Shift-And masks; one step per byte moves the states of every rule of every URL of a
batch. In a glob ``*`` is any run without ``/``, ``**`` any run, ``?`` one byte but ``/``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> str:
        return f"*.{self.host}{self.path}**"


@dataclass(frozen=True)
class Glob:
    """A verdict for canonical URLs that match a glob; asked only where no Rule fits."""

    verdict: str
    glob: str

    @property
    def name(self) -> str:
        return self.glob


class Automaton:
    """Shift-And masks of a list of globs, and their simulation over a batch of byte strings.

    A state says that so many literals of a glob have been read. ``move[c]`` has the states that
    can be entered by byte c, ``stay[c]`` those that a wildcard keeps alive over it.
    """

    def __init__(self, globs: list[str]):
        starts, ends, enter, loops = [], [], [], []
        at = 0
        for glob in globs:
            starts.append(at)
            tokens = glob.replace("**", "\0").encode()
            for byte in tokens:
                if byte in b"*\0":
                    loops.append((at, byte == 0))
                else:
                    at += 1
                    enter.append((at, byte))
            ends.append(at)
            at += 1
        self.words = at // 64 + 1
        self.move = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        for state, byte in enter:
            taken = [byte] if byte != ord("?") else [c for c in range(256) if c != ord("/")]
            self.move[taken, state // 64] |= np.uint64(1 << state % 64)
        for state, any_byte in loops:
            taken = [c for c in range(256) if any_byte or c != ord("/")]
            self.stay[taken, state // 64] |= np.uint64(1 << state % 64)
        self.start = np.zeros(self.words, np.uint64)
        for state in starts:
            self.start[state // 64] |= np.uint64(1 << state % 64)
        self.ends = np.array(ends, np.int64)

    def matches(self, data: bytes, offsets: np.ndarray) -> np.ndarray:
        """For each string of the batch and each glob, whether the glob matches all of it."""
        codes = np.frombuffer(data, np.uint8)
        begin, length = offsets[:-1], np.diff(offsets)
        order = np.argsort(-length, kind="stable")
        begin, length = begin[order], length[order]
        states = np.repeat(self.start[None, :], len(begin), axis=0)
        alive = len(begin)
        for step in range(int(length[0]) if len(length) else 0):
            alive = int(np.searchsorted(-length[:alive], -step, side="left"))
            byte = codes[begin[:alive] + step]
            now = states[:alive]
            shifted = now << np.uint64(1)
            shifted[:, 1:] |= now[:, :-1] >> np.uint64(63)
            states[:alive] = (shifted & self.move[byte]) | (now & self.stay[byte])
        found = (states[:, self.ends // 64] >> (self.ends % 64).astype(np.uint64)) & np.uint64(1)
        result = np.empty_like(found, dtype=bool)
        result[order] = found.astype(bool)
        return result


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    has = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    rest = F.when(has, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def judge(pages: DataFrame, rules: list[Rule], globs: list[Glob] = (), default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict and pattern of every page.

    Of the rules that fit the longest wins, of equal ones a blocking one, then the first by name.
    Where no rule fits, ``rule`` is null and the globs are asked by the same order; ``pattern`` is
    the one that won. Where nothing fits, also for null and malformed urls, the verdict is
    ``default``. One row out for each row in; other columns of ``pages`` are not read.
    """
    ranked = sorted(rules, key=lambda r: (-len(r.name), r.verdict != "block", r.name))
    ranked += sorted(globs, key=lambda g: (-len(g.name), g.verdict != "block", g.name))
    automaton = Automaton([r.glob for r in ranked])
    out = T.IntegerType()

    @F.arrow_udf(out)
    def winner(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            urls = [x.as_py().encode() for x in batch]
            offsets = np.concatenate([[0], np.cumsum([len(u) for u in urls], dtype=np.int64)]).astype(np.int64)
            hit = automaton.matches(b"".join(urls), offsets) if ranked else np.zeros((len(urls), 0), bool)
            first = np.where(hit.any(axis=1), hit.argmax(axis=1), -1) if ranked else np.full(len(urls), -1)
            yield pa.array(first.astype(np.int32))

    host, path = host_and_path(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    judged = parts.withColumn("winner", winner(F.concat(F.lit("."), "host", "path")))

    def pick(values: list[str | None], otherwise: str | None) -> Column:
        table = F.array(*[F.lit(v).cast("string") for v in [*values, otherwise]])
        return F.element_at(table, F.when(F.col("winner") < 0, len(values) + 1).otherwise(F.col("winner") + 1))

    n = len(rules)
    return judged.select(
        "page_id",
        "host",
        "path",
        pick([r.name if i < n else None for i, r in enumerate(ranked)], None).alias("rule"),
        pick([r.verdict for r in ranked], default).alias("verdict"),
        pick([r.name if i >= n else None for i, r in enumerate(ranked)], None).alias("pattern"),
    )
