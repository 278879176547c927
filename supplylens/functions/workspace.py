"""Written intermediates: a table that several consumers read is computed once.

An intermediate goes to the shared folder the session names in
``spark.checkpoint.dir``, so it outlives any executor and cuts the lineage.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_ROOTS: dict[str, str] = {}
_FOLDERS: list[str] = []
#: Of written tables: their columns take some two thirds of what Spark's default leaves.
CODEC = "zstd"
#: Spark's setting by which a query's shuffle files go when it ends, not when the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITES: dict[str, list[str | None]] = {}  # by session: what was set before the writes under way, once for each
_WRITES_LOCK = threading.Lock()


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """For a write: its shuffle files are deleted when it ends, as only the files written are read again.

    Writes may overlap; the session's own setting comes back when the last of them has ended.
    """
    session = spark._jsparkSession.sessionUUID()
    with _WRITES_LOCK:
        under_way = _WRITES.setdefault(session, [])
        under_way.append(under_way[0] if under_way else spark.conf.get(SHUFFLE_CLEANUP, None))
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _WRITES_LOCK:
            before = under_way.pop()
            if not under_way:
                del _WRITES[session]
                if before is None:
                    spark.conf.unset(SHUFFLE_CLEANUP)
                else:
                    spark.conf.set(SHUFFLE_CLEANUP, before)


def shared_folder(spark: SparkSession) -> str:
    """The session's shared folder; only a local session may fall back to its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        _ROOTS[app] = tempfile.mkdtemp(prefix="supplylens-")
    return _ROOTS[app]


def written() -> int:
    """How many intermediate folders this process has named; see ``release_since``."""
    return len(_FOLDERS)


def release_since(spark: SparkSession, mark: int, keep: int = 0) -> None:
    """Delete the intermediates named after ``mark``, but for the last ``keep``; nothing else may use them any more."""
    for path in _FOLDERS[mark : len(_FOLDERS) - keep]:
        _delete(spark, path)


def new_folder(spark: SparkSession, label: str = "files") -> str:
    """A folder of its own among the intermediates, for files that are not one table."""
    path = f"{shared_folder(spark)}/held-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    _FOLDERS.append(path)
    return path


def hold(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once and return a scan of what was written."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    with shuffles_go(spark):
        df.write.parquet(path, compression=CODEC)
    return spark.read.schema(df.schema).parquet(path)


def hold_together(frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Hold several independent frames at once, so that their jobs share the free slots."""
    with ThreadPoolExecutor(len(frames)) as pool:
        held = {label: pool.submit(hold, df, label) for label, df in frames.items()}
        return {label: done.result() for label, done in held.items()}


def release(spark: SparkSession) -> None:
    """Delete every intermediate of this application."""
    _delete(spark, f"{shared_folder(spark)}/held-{spark.sparkContext.applicationId}")


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
