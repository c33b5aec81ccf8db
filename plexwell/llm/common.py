"""Shared staging and text helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zlib
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_DIR: dict[str, str] = {}

#: A-Z to a-z, byte-wise: multi-byte UTF-8 sequences are untouched.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
UPPER_LETTERS = "".join(map(chr, range(65, 91)))
LOWER_LETTERS = UPPER_LETTERS.lower()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or an own one where that is unset and the master is local (tests)."""
    told = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if told:
        return told.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIR:
        _OWN_DIR[app] = "file://" + tempfile.mkdtemp(prefix="plexwell-")
    return _OWN_DIR[app]


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def holding(spark: SparkSession, key: str, value: str):
    """A setting of the session that holds within."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def freeing(spark: SparkSession):
    """Shuffle files of a write within are deleted when it ends: what is written is read, never computed again."""
    return holding(spark, _CLEANUP, "true")


def short_batches(spark: SparkSession, rows: int):
    """Batches of what is written within have ``rows`` rows at most: executor and worker each hold them whole."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    told = int(spark.conf.get(key))
    return holding(spark, key, str(rows if told <= 0 else min(rows, told)))


class Scratch:
    """Tables of one operator run under the shared folder; they cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and read it back (with the schema given, so empty tables work)."""
        with freeing(self.spark):
            df.write.option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Delete one table that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_crc(column: str | Column) -> Column:
    """crc32 of an id written as decimal text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string") if isinstance(column, str) else column, F.lit("")).cast("binary"))


def crc_of(doc_id: int | None) -> int:
    """The same on the Python side."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def text_bytes(docs: DataFrame, *keep: str, column: str = "text") -> DataFrame:
    """Only the wanted columns, with the text as UTF-8 bytes under the name ``body`` (null: empty)."""
    return docs.select(*keep, F.coalesce(F.col(column).cast("binary"), F.lit(b"")).alias("body"))


#: Bytes of text (or of other long values) that a worker turns to Python objects at a time.
BATCH_BYTES = 8 << 20


def cut_batches(batches: Iterable[pa.RecordBatch], column: int, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose values of a text or binary column take ``limit`` bytes at most, or one row."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        a, before = 0, 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(sizes, before + limit, side="right")))
            yield batch.slice(a, b - a)
            a, before = b, int(sizes[b - 1])


def giving_back(run):
    """``run`` over a task's batches; then the worker, which later tasks use again, returns freed memory to the system."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return wrapped


_SHARED: list = []


def share(spark: SparkSession, value):
    """A broadcast that ``unshare`` takes back; ``value`` has a bound that its operator states."""
    _SHARED.append(spark.sparkContext.broadcast(value))
    return _SHARED[-1]


def unshare() -> None:
    """Take the copies of all broadcasts from executors (one that is asked for again is sent again)."""
    while _SHARED:
        _SHARED.pop().unpersist()
