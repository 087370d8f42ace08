"""Random columns that a row keeps: numbers drawn from its key and a seed, by a hash.

Unlike ``rand(seed)``, which counts rows within a partition, the values do not change when the rows
are partitioned, ordered or computed otherwise, or again after a lost executor.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def keyed_bits(seed: int, keys: Sequence[str | Column], stream: int = 0) -> Column:
    """64 random bits as a long: XXH64 over the seed, the number of the stream and the key columns."""
    return F.xxhash64(F.lit(seed).cast("long"), F.lit(stream).cast("long"), *keys)


def keyed_uniform(seed: int, *keys: str | Column, stream: int = 0) -> Column:
    """A double in [0, 1): the upper 53 of the random bits."""
    return F.shiftrightunsigned(keyed_bits(seed, keys, stream), 11).cast("double") * F.lit(2.0**-53)


def keyed_normal(seed: int, *keys: str | Column, stream: int = 0) -> Column:
    """A standard normal double, by Box and Muller from two streams of their own."""
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - keyed_uniform(seed, *keys, stream=2 * stream + 1_000_001)))
    return radius * F.cos(F.lit(2 * math.pi) * keyed_uniform(seed, *keys, stream=2 * stream + 1_000_002))


def keyed_whole(seed: int, low: int, high: int, *keys: str | Column, stream: int = 0) -> Column:
    """A whole number from ``low`` to ``high``, both included."""
    return (F.lit(low) + F.floor(keyed_uniform(seed, *keys, stream=stream) * F.lit(high - low + 1))).cast("long")
