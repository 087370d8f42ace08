"""Byte-level BPE encoding and decoding with the ranks of a local file.

The rank file (about a megabyte, a fixed vocabulary) is read once on the driver and sent to the
Python workers; texts stay where their partition is. A long text is cut before it is encoded, only
at places which no match of the pattern can span, so the ids are those of the uncut text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts longer than this are cut at safe boundaries; a cut-out that is still longer is matched
#: piece by piece, as the library's matcher gives up on very long runs of white space.
LONG_TEXT = 1 << 16

#: No match goes on from a visible ASCII character to a space or line end, nor between an ASCII
#: letter and an ASCII digit. Letters and digits outside ASCII are left to the matcher.
_SAFE_CUT = regex.compile(r"(?<=[!-~])(?=[ \n])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")

_coders: dict[int, Coder] = {}


class Coder:
    """Encoder and decoder of one rank file, built once in each Python worker."""

    def __init__(self, rank_file: bytes, pattern: str):
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, rank_file.splitlines())}
        self._encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._pattern = regex.compile(pattern)
        self._tokens: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self._tokens[rank] = token

    def encode(self, text: str) -> np.ndarray:
        if len(text) <= LONG_TEXT:
            return self._encoding.encode_to_numpy(text).astype(np.int32)
        parts = [np.zeros(0, np.int32)]
        for part in _cut(text):
            if len(part) <= 2 * LONG_TEXT:
                parts.append(self._encoding.encode_to_numpy(part).astype(np.int32))
            else:
                parts += [np.array(self._encoding._encode_single_piece(m[0]), np.int32) for m in self._pattern.finditer(part)]
        return np.concatenate(parts)

    def decode(self, ids) -> bytes | None:
        try:
            return b"".join([self._tokens[i] for i in ids])
        except (IndexError, TypeError):
            return None


def _cut(text: str) -> Iterator[str]:
    """Parts of at least LONG_TEXT characters, the last aside, that join to the text."""
    start = 0
    while len(text) - start > LONG_TEXT:
        cut = _SAFE_CUT.search(text, start + LONG_TEXT)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def _coder(shared) -> Coder:
    rank_file, pattern = shared.value
    key = hash((rank_file, pattern))
    if key not in _coders:
        _coders[key] = Coder(rank_file, pattern)
    return _coders[key]


class Vocabulary:
    """Column functions that encode and decode by one rank file and splitting pattern."""

    def __init__(self, spark: SparkSession, rank_path: str, pattern: str):
        with open(rank_path, "rb") as file:
            self._shared = spark.sparkContext.broadcast((file.read(), pattern))

    def encode(self, text: Column) -> Column:
        """The ids of a text as ``array<int>``; a null text has those of the empty one: none."""
        shared = self._shared

        @F.arrow_udf(T.ArrayType(T.IntegerType()))
        def token_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            coder = _coder(shared)
            for batch in batches:
                # Numbers are held packed: as Python objects a batch's ids take ten times the room.
                ids = [coder.encode(x.as_py() or "") for x in batch]
                ends = np.cumsum([0, *map(len, ids)])
                yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))

        return token_ids(text)

    def decode(self, ids: Column) -> Column:
        """The raw bytes of an array of ids, which need not be valid UTF-8.

        Null ids, and arrays with a null or an id outside the vocabulary, give null.
        """
        shared = self._shared

        @F.arrow_udf(T.BinaryType())
        def raw_bytes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            coder = _coder(shared)
            for batch in batches:
                yield pa.array([None if not x.is_valid else coder.decode(x.as_py()) for x in batch], pa.binary())

        return raw_bytes(ids)


def encode_documents(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, token_ids and the decoded bytes of every document.

    One row out for each row in, also for repeated rows and null ids; null texts count as empty.
    Other columns of ``docs`` are not read, so their names do not matter.
    """
    ids = docs.select("doc_id", vocabulary.encode(F.col("text")).alias("token_ids"))
    return ids.withColumn("decoded", vocabulary.decode(F.col("token_ids")))


def digests(encoded: DataFrame) -> DataFrame:
    """What a comparison needs of ``encode_documents``: lengths and SHA-256 digests."""
    return encoded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
