"""Shared helpers: reading tables, shared scratch tables, Arrow row mapping."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows and bytes of text handed to one call of a row function; they bound a Python worker's memory.
SLICE_ROWS, SLICE_BYTES = 256, 4 << 20
#: Bytes of the batches that Spark hands to Python workers: its own 64 MB are held whole on both sides, beside copies while they grow.
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Shuffle files of a finished write go at once, not when the JVM happens to collect their owner.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    ``spark.checkpoint.dir`` when the cluster names one; otherwise a temporary
    folder, which is only allowed in local mode where there is one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="cuewright-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, so a lost executor never recomputes what came before, and
    frees the shuffle files behind ``df``.  ``drop`` deletes what is used up; the
    rest goes when the session ends.
    """
    path = f"{scratch_dir(spark)}/cuewright/{uuid.uuid4().hex}/{name}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    fs, target = _located(spark, path)
    fs.deleteOnExit(target.getParent())
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def _located(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def drop(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in frames:
        fs, target = _located(df.sparkSession, df._staged_at)
        fs.delete(target.getParent(), True)


_REMEMBERED: dict[str, object] = {}


def remembered(key: str, build: Callable[[], object]) -> object:
    """What ``build`` makes, kept in this Python worker from task to task of steps that name ``key``."""
    if key not in _REMEMBERED:
        _REMEMBERED[key] = build()
    return _REMEMBERED[key]


def forget(but: str | None = None) -> None:
    """Free what earlier steps left in this Python worker: workers outlive stages, and what stages keep would add up."""
    if old := [k for k in _REMEMBERED if k != but]:
        for key in old:
            del _REMEMBERED[key]
        give_back()


def give_back() -> None:
    """Return freed memory to the system: an allocator keeps it for its own worker, but executor and workers share one limit."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU C library's
    if trim:
        trim(0)


def map_rows(
    df: DataFrame, make: Callable[[], Callable[[dict], dict]], schema: str, slice_rows: int = SLICE_ROWS, keep: Sequence[str] = (),
    remember: str | None = None,
) -> DataFrame:
    """Apply a function from column lists to column lists, Arrow batch by Arrow batch.

    ``make`` runs once in each task and returns the function, so that tables and
    caches are built on the executor and live as long as the task; only what is
    ``remembered`` by the key ``remember`` lives on.  A session that sets no bytes of a
    batch itself gets batches of SLICE_BYTES, or of one longer row.  Columns to ``keep`` come first,
    as they are; the function then gives a value for each row.
    """
    arrow = _arrow_schema(schema)
    if keep:
        arrow = pa.schema([*_arrow_schema(df.select(*keep).schema), *arrow])
        schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema), schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget(remember)
        f = make()
        try:
            for batch in batches:
                for at, n in _slices(batch, slice_rows):
                    part = batch.slice(at, n)
                    columns = dict(zip(part.schema.names, part.columns, strict=True))
                    out = {n: columns[n] for n in keep} | f(_Lists(columns))
                    yield pa.RecordBatch.from_arrays(
                        [(v if v.type == t.type else v.cast(t.type)) if isinstance(v, pa.Array) else pa.array(v, type=t.type) for v, t in
                         ((out[t.name], t) for t in arrow)], schema=arrow)
        finally:
            batch = part = columns = out = f = None
            give_back()

    if df.sparkSession.conf.get(_BATCH_BYTES, None) is None:
        df.sparkSession.conf.set(_BATCH_BYTES, str(SLICE_BYTES))
    return df.mapInArrow(run, schema)


def _slices(batch: pa.RecordBatch, rows: int) -> Iterator[tuple[int, int]]:
    """(start, length) of slices of at most ``rows`` rows and, but for single rows, SLICE_BYTES of text."""
    size = np.zeros(batch.num_rows, np.int64)
    for c in batch.columns:
        if pa.types.is_string(c.type) or pa.types.is_binary(c.type) or pa.types.is_large_string(c.type) or pa.types.is_large_binary(c.type):
            size += pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False)
    total, at = np.concatenate(([0], np.cumsum(size))), 0
    while at < batch.num_rows:
        end = int(np.searchsorted(total, total[at] + SLICE_BYTES, side="right")) - 1
        end = min(max(end, at + 1), at + rows, batch.num_rows)
        yield at, end - at
        at = end


class _Lists(dict):
    """Columns as lists, made when they are asked for."""

    def __getitem__(self, name: str) -> list:
        v = super().__getitem__(name)
        if isinstance(v, pa.Array):
            v = self[name] = v.to_pylist()
        return v


def _arrow_schema(schema: str | StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def documents(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Only key and text, so that extra or clashing columns never matter; null text becomes empty."""
    return df.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
