"""The folder that driver and executors share, and the lifetime of what is kept in it.

Frames that ``cut`` returns are files below ``spark.checkpoint.dir``. Spark's cleaner removes them once no frame refers to them any more;
``scratch`` removes them, and the folders of ``fresh_dir``, at its end; what is left goes when the program ends.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession

#: Fixed-size tables of at most so many bytes are sent to every executor.
BROADCAST_BYTES = 8 << 20
#: Most rows and bytes of a batch that goes to Python.
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20
_CLEANS = "spark.cleaner.referenceTracking.cleanCheckpoints"
_EXCHANGES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: What was written, by the blocks that are open; the first list is the program's.
_owned: list[list[tuple[SparkSession, str]]] = [[]]


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Where it is unset, a temporary folder, but only for a local master: on a cluster each
    executor would write to a disk of its own."""
    sc = spark.sparkContext
    asked = spark.conf.get("spark.checkpoint.dir", None)
    if (found := sc.getCheckpointDir()) is None:
        if not asked and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(asked or tempfile.mkdtemp(prefix="matchcast-"))
        found = sc.getCheckpointDir()
    return asked or found


def bounded(df: DataFrame) -> DataFrame:
    """The same frame. Its session sends rows to Python in batches of bounded rows and bytes from now on: limits that are larger, or
    none, are lowered, as they are read when a plan runs and not when it is made."""
    conf = df.sparkSession.conf
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = conf.get(name, None)
        size = int(now) if now and now.lstrip("-").isdigit() else 0
        if not 0 < size <= most:
            conf.set(name, str(most))
    return df


def cut(df: DataFrame) -> DataFrame:
    """Computed once and kept in the shared folder: later reads survive lost executors."""
    spark = df.sparkSession
    shared_dir(spark)
    conf = spark.sparkContext._jsc.sc().conf()
    before = conf.get(_CLEANS, "false")
    conf.set(_CLEANS, "true")  # read while the files are written: those of others keep their setting
    try:
        out = df.checkpoint(eager=True)
    finally:
        conf.set(_CLEANS, before)
    file = out._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if len(_owned) > 1 and file.isDefined():
        _owned[-1].append((spark, file.get()))
    return out


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed at the end of the block or program."""
    path = f"{shared_dir(spark).rstrip('/')}/matchcast-{name}-{uuid.uuid4().hex}"
    _owned[-1].append((spark, path))
    return path


def kept(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``cut``, but as compressed columns in a folder of ``fresh_dir``, which is returned too: a fraction of the bytes of a checkpoint;
    rows of a partition may be read in several, or with others'. Files of its exchanges go once it is written, not when the driver collects
    its garbage."""
    folder, conf = fresh_dir(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(_EXCHANGES, None)
    conf.set(_EXCHANGES, "true")  # read when the write begins
    try:
        df.write.option("compression", "zstd").parquet(folder)
    finally:
        conf.unset(_EXCHANGES) if before is None else conf.set(_EXCHANGES, before)
    return df.sparkSession.read.schema(df.schema).parquet(folder), folder


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder, wherever it is."""
    sc = spark.sparkContext
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(sc._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is written to the shared folder within the block goes at its end, so results have to be read or written before that."""
    _owned.append([])
    try:
        yield
    finally:
        for session, path in _owned.pop():
            remove(session, path)


@atexit.register
def _leave() -> None:
    for level in _owned:
        for session, path in level:
            with suppress(Exception):  # the session may have ended
                remove(session, path)
