"""Shared helpers of the training-data operators: the shared scratch folder, row keys and text buffers."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step looks at; its temporaries are a small multiple of this.
STEP_BYTES = 1 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor and the driver share: ``spark.checkpoint.dir`` of the session. A local master
    (tests) may leave it unset and then gets a private one; any other master must name it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="demandspark-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def save(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the lineage, and what
    non-deterministic columns (row keys) hold is fixed from here on, also when executors are lost."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a saved frame that nothing will read again."""
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def row_key() -> Column:
    """A key for one row of a scan, so that null or repeated ids stay apart. Save the frame before it is used
    in more than one job."""
    return F.monotonically_increasing_id()


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, with as many underscores as it takes to be none of the columns of ``df`` (whatever their case)."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def numbered(docs: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``docs`` with a key for each row, saved, and the name of the key's column: a scan that is planned anew may cut
    its files otherwise, and number the rows otherwise, so all later steps read this table."""
    name = free_name(docs, "_row")
    return save(docs.withColumn(name, row_key()), label), name


def by_number(rows: DataFrame, name: str) -> DataFrame:
    """What the operators look at of a numbered table: row, doc_id and text."""
    return rows.select(F.col(name).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")


def without(rows: DataFrame, name: str, gone: DataFrame) -> DataFrame:
    """A numbered table less the rows named in ``gone`` (row), without the numbers."""
    return rows.join(gone.select(F.col("row").alias(name)), name, "left_anti").drop(name)


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on and would hold it through later stages, Arrow's in its
    pool and numpy's in the C heap, whose blocks stay below the last one in use."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim is not None:
            trim(0)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow(run, schema)``, whose tasks give their memory back when they end."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(whole, schema)


def by_group(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``run`` for ``applyInArrow`` on groups, giving memory back after each one."""
    def whole(rows: pa.Table) -> pa.Table:
        try:
            return run(rows)
        finally:
            give_back()

    return whole


def by_cogroup(run: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """``run`` for ``applyInArrow`` on cogroups, giving memory back after each one."""
    def whole(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return run(left, right)
        finally:
            give_back()

    return whole


def filtered(docs: DataFrame, keep, limit: int = STEP_BYTES) -> DataFrame:
    """The rows of ``docs`` that ``keep`` (from a slice of a record batch to booleans) lets through, all columns as they
    are: what is decided by a row's text alone needs no key, no join and no shuffle. ``limit``: as in ``pieces``."""
    def run(batches):
        for part in (p for b in batches for p in pieces(b, limit=limit)):
            kept = part.filter(pa.array(keep(part), pa.bool_()))
            if len(kept):
                yield kept

    return map_batches(docs, run, docs.schema)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column in one array, and the offset where each row begins (one more at the
    end). Null is empty."""
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_large_binary(column.type) else b"")
    if not (pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0]: at[-1]], at - at[0]


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = STEP_BYTES):
    """Slices of ``batch`` with at most ``limit`` bytes of text, or one row if that alone is longer."""
    if not len(batch):
        return
    _, at = text_buffer(batch.column(column))
    start = 0
    while start < len(batch):
        stop = max(start + 1, int(np.searchsorted(at, at[start] + limit, "right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop
