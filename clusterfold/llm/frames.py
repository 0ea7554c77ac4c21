"""Shared DataFrame helpers of the corpus operators."""

from __future__ import annotations

from contextlib import contextmanager

import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterfold.session import checkpoint_dir

BATCH_ROWS = 2000
BATCH_BYTES = 16 << 20
KEPT_BYTES, MAPPED_BYTES = 128 << 20, 32 << 20  # freed memory that a worker keeps, and larger arrays that it does not


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small: texts are long, and a Python worker should
    hold a few megabytes of them at a time.  Smaller settings of the caller stay."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key, None)
        number = int("".join(c for c in str(now) if c.isdigit() or c == "-") or 0)
        if now is None or number <= 0 or number > most:
            spark.conf.set(key, str(most))


def give_back() -> None:
    """Return this worker's freed memory to the system."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def keep_memory() -> None:
    """Let this worker reuse freed memory until :func:`give_back`: by default
    it returns arrays of megabytes at once, and every new one is paged in anew."""
    import ctypes

    mallopt = getattr(ctypes.CDLL(None), "mallopt", None)  # glibc only
    if mallopt is not None:
        mallopt(-1, KEPT_BYTES)  # M_TRIM_THRESHOLD
        mallopt(-3, MAPPED_BYTES)  # M_MMAP_THRESHOLD


def lean(run, every_batch: bool = True):
    """A function of Arrow batches whose worker gives freed memory back after
    each batch, or only at its task's end: idle workers and later stages share
    a machine."""

    def trimmed(batches):
        for batch in run(batches):
            yield batch
            del batch
            if every_batch:
                give_back()
        give_back()

    return trimmed


def texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns that an operator reads, under its own names: other
    columns, whatever they are called, never meet the operator's."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))


def saved(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared checkpoint folder: later steps
    read the same rows even after executors are lost."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A setting of the session for the jobs run inside; the caller's returns."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def removed(spark: SparkSession, folder: str) -> None:
    """Delete a folder of intermediate data that this package wrote."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


class Shared:
    """A broadcast object of bounded size.  Its classes travel with it, so
    that executors need not have this package on their path.  A worker keeps
    what was sent as long as it lives: compressed, beside the object."""

    def __init__(self, spark: SparkSession, thing):
        self._sent = spark.sparkContext.broadcast(zstandard.compress(cloudpickle.dumps(thing), 3))
        self._thing = None

    def __getstate__(self):
        return {"_sent": self._sent, "_thing": None}

    @property
    def value(self):
        if self._thing is None:
            self._thing = cloudpickle.loads(zstandard.decompress(self._sent.value))
        return self._thing
