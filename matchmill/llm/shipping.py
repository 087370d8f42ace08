"""The package's code on the executors, for sessions that were not submitted with it."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import matchmill
from matchmill.session import scratch_path

_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Make ``matchmill`` importable by Python workers, once for an application.

    The package goes as one archive into the shared folder, from which every worker's path gets it.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = Path(matchmill.__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(top.rglob("*.py")):
            archive.write(file, Path(top.name) / file.relative_to(top))
    path = context._jvm.org.apache.hadoop.fs.Path(f"{scratch_path(spark, 'code')}/matchmill.zip")
    system = path.getFileSystem(context._jsc.hadoopConfiguration())
    out = system.create(path)
    out.write(packed.getvalue())
    out.close()
    context.addPyFile(system.makeQualified(path).toString())
    _shipped.add(context.applicationId)
