"""What Python workers keep in memory from one task to the next."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import SparkSession

#: Blocks from 4 MB on go back to the system once they are free, as does free memory beyond that at the end of the heap.
THRIFTY = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "1",
    "MALLOC_MMAP_THRESHOLD_": str(4 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(4 << 20),
}

_forget: Callable[[], None] | None = None


def thrifty_workers(spark: SparkSession) -> None:
    """Lets Python workers that start from now on hold on to less free memory; what the environment has set stays.

    They share an executor's memory with the JVM, and wait there through stages that need none of them.
    """
    for name, value in THRIFTY.items():
        spark.sparkContext.environment.setdefault(name, value)


def remember_only(forget: Callable[[], None] | None = None) -> None:
    """Called where a task begins that remembers what ``forget`` drops, or nothing: what other operators have left here goes.

    A worker serves all stages of a session, and would else hold what each of them has learnt. No result depends on it.
    """
    global _forget
    if _forget is not None and _forget != forget:
        _forget()
        gc.collect()
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)
    _forget = forget
