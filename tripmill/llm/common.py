"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

#: Most bytes of text that one output batch of a Python step gathers.
BATCH_BYTES = 8 << 20


#: What a Python worker keeps between tasks: one model with its stores.
_KEPT: dict[Hashable, object] = {}


def kept(key: Hashable, build: Callable[[], object]):
    """The worker's model of that name; another one that it kept is let go first."""
    if key not in _KEPT:
        release()
        _KEPT[key] = build()
    return _KEPT[key]


def release() -> None:
    """Lets go of what the worker keeps and hands free memory back to the system.

    Workers are reused from stage to stage; a step that needs much memory itself
    begins with this, so that the stores of an earlier stage do not add to it.
    """
    _KEPT.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def fresh(step: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The step of a task, begun with :func:`release`."""

    def run(source: Iterator) -> Iterator:
        release()
        yield from step(source)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def require(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` if it has the named columns, else a ValueError that names what is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")
    return df


def third(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 3


def map_rows(
    df: DataFrame, rows: Callable[[Iterator[dict]], Iterable[dict]], schema: str, size: Callable[[dict], int] = lambda row: 64
) -> DataFrame:
    """``rows`` over the dictionaries of each partition, in output batches of bounded size."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, weight = [], 0
        for row in rows(row for batch in source for piece in _pieces(batch) for row in piece.to_pylist()):
            held.append(row)
            weight += size(row)
            if weight > BATCH_BYTES or len(held) >= 20_000:
                yield pa.RecordBatch.from_pylist(held, arrow)
                held, weight = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, arrow)

    arrow = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)
    return df.mapInArrow(fresh(batches), schema)


def _pieces(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def slices(source: Iterator[pa.RecordBatch], column: str = "text", limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Input batches cut so that the text of each is about ``limit`` bytes; a longer text stands alone."""
    for batch in source:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(lengths), 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
