"""What Python workers need: the package on every executor, and batches of a bounded size."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Bytes of an Arrow batch; with the default limit, 10,000 texts or 64 MB, a task holds several times that.
BATCH_BYTES = 8 << 20
_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Spark hand this package's source to the executors' Python workers, once per application.

    The session's limit on the bytes of an Arrow batch becomes ``BATCH_BYTES`` then.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    handle, name = tempfile.mkstemp(prefix=f"{package.name}-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(name)
    spark.conf.set(_LIMIT, f"{BATCH_BYTES}b")
    _shipped.add(context.applicationId)
