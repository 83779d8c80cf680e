"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import checkpointed, scratch_path, ship_package

__all__ = ["checkpointed", "scratch_path", "table", "id_hash", "with_columns_of", "map_batches",
           "releasing", "small_batches", "smallest_by_hash", "stored", "words_of"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_hash(doc_id: Column | str) -> Column:
    """crc32 of the id written as text, as a long; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary") if isinstance(doc_id, str)
                   else doc_id.cast("string").cast("binary"))


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8 bytes; none for NULL."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def small_batches(batches: Iterator[pa.RecordBatch], column: int, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``most`` bytes in a text column (or one row)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: computed once, safe against lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              done: Callable[[], None] | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` that gives memory back when a task ends, as Spark keeps its Python workers for later tasks."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            if done:
                done()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # in the C library of Linux
            if trim:
                trim(0)

    return wrapped


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                ddl: str, done: Callable[[], None] | None = None) -> DataFrame:
    """``mapInArrow`` with this package on the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(releasing(run, done), ddl)


def with_columns_of(df: DataFrame, make: Callable[[list], list], ddl: str, source: str = "text",
                    keep: tuple[str, ...] | None = None) -> DataFrame:
    """Append columns computed from one column, batch by batch; no row moves to another task.

    ``make`` gets the values of ``source`` as a Python list and returns one list per field of ``ddl``.
    ``keep`` names the columns that stay (default all). A kept column whose name equals a new one,
    whatever the case, is replaced by it.
    """
    new = StructType.fromDDL(ddl)
    names = {f.name.lower() for f in new.fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in names]
    held = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{source}`").alias("_text_in"))
    schema = StructType(held.schema.fields[:-1] + new.fields)
    types = [f.type for f in to_arrow_schema(new)]

    is_text = dict(df.dtypes)[source] == "string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, len(kept)) if is_text else batches:
            made = make(batch.column(len(kept)).to_pylist())
            arrays = [pa.array(v, t) for v, t in zip(made, types)]
            yield pa.RecordBatch.from_arrays(batch.columns[:len(kept)] + arrays,
                                             names=kept + [f.name for f in new.fields])

    ship_package(df.sparkSession)
    return held.mapInArrow(releasing(run), schema)


def smallest_by_hash(df: DataFrame, key: str, limit: int) -> DataFrame:
    """At most ``limit`` rows, those with the smallest hash of the key: a bounded, repeatable sample."""
    return df.orderBy(F.xxhash64(F.lit("sample"), F.col(key).cast("string")), key).limit(limit)
