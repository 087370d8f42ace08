"""The queue drain as a stream: landed files merged into tables, each file once."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from matchmill.operators.guards import SkipJob

log = logging.getLogger(__name__)


def landed_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "json",
    pattern: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """New files under ``path`` as a stream; ``files_per_batch`` bounds one batch."""
    reader = spark.readStream.format(file_format).schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def drain(
    stream: DataFrame,
    apply: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Run ``apply`` on each batch: all that has landed, or continuously every ``every``.

    The checkpoint remembers which files are done. A batch interrupted half-way runs
    again, so ``apply`` must give the same tables when repeated, as a merge does. A batch
    with nothing to do (SkipJob) counts as done.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        try:
            apply(df, batch_id)
        except SkipJob as nothing:
            log.info("batch %s skipped: %s", batch_id, nothing)

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
