"""Python tasks on Arrow batches of bounded size."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes of a batch, about; a longer row is a batch of its own.
BATCH_BYTES = 4 << 20
_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def tidy(run: Callable) -> Callable:
    """`run`, and at its end the worker gives back the memory it has freed.

    Workers stay for the tasks to come, beside the heap of their executor, also through steps without Python.
    """

    def ran(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim is not None:
                trim(0)

    return ran


def in_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """`mapInArrow` with batches that fit small executors, whatever the length of the texts.

    Spark takes the size of a batch from the session when the plan runs, so the
    session keeps the bound; a smaller one that is set there stays.
    """
    conf = df.sparkSession.conf
    if int(str(conf.get(_CONF)).rstrip("b")) > BATCH_BYTES:
        conf.set(_CONF, str(BATCH_BYTES))
    return df.mapInArrow(tidy(run), schema)
