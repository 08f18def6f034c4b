"""Memory of Python workers, which Spark keeps from task to task."""

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import SparkSession

_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession, size: str = "4m") -> None:
    """From now on a Python task of this session gets batches of whole rows with about `size` of data.

    Spark's own bound of 64 MB lets a batch of 10,000 texts, and all that is made from it, stand in every
    worker and in the JVM at once. A bound that the session was given is left as it is. Results don't
    depend on it.
    """
    if _BATCH_BYTES not in spark.conf.getAll:
        spark.conf.set(_BATCH_BYTES, size)


def give_back(generation: int = 0) -> None:
    """Return free memory to the system: else a worker keeps the most that any batch has needed.

    Objects that refer to each other are looked for up to that generation; 2 has all of them.
    """
    gc.collect(generation)
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)
