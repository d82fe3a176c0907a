"""What Python workers, the executors that feed them and the driver hold beside what they need.

Spark keeps its workers for later tasks, and the allocators of C and Arrow keep what
was freed: a worker that took 250 MB for some arrays would hold most of it, unused, while
the executor's JVM joins and sorts. The JVM's own buffers of rows for the workers are kept
likewise, so rows go over a megabyte at a time. The driver's heap grows with the plans, task
reports and results of many small jobs, until something collects them.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import SparkSession

from lustra.llm.symbols import chunks, drop_powers

Batches = Iterator[pa.RecordBatch]
#: Spark's limit on a batch of rows for a Python worker; by default 64 MB, so that 10,000 rows of text go over at once.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession, size: int = 1 << 20) -> None:
    """Rows go to Python workers about ``size`` bytes at a time, for the rest of the session; a limit set before stays."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, f"{size}b")


def give_back() -> None:
    """Return freed memory to the system, and the tables that any chunk makes anew."""
    drop_powers()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim is not None:
        trim(0)


def settle(spark: SparkSession) -> None:
    """Have the driver collect what is done: its heap shrinks, and Spark removes shuffles and broadcasts nothing refers to."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    spark.sparkContext._jvm.System.gc()


def returning(of: Callable[[Batches], Batches], forget: Callable[[], None] | None = None) -> Callable[[Batches], Batches]:
    """``of``, for ``mapInArrow`` and by its name; at a partition's end the worker calls ``forget`` and gives memory back.

    ``forget`` drops tables of the worker's own module, so it has to be a function there, not a table.
    """

    @wraps(of)
    def held(batches):
        try:
            yield from of(batches)
        finally:
            if forget is not None:
                forget()
            give_back()

    return held


def portions(batch: pa.RecordBatch, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in groups of about ``size`` bytes of text, so that what is made of a batch is never held whole."""
    for chunk in chunks(batch.column("text"), size):
        yield batch.slice(chunk.first, len(chunk))
