"""Giving memory back: a Python worker lives on after its task, and whatever it still holds is lost to the executor's next stage."""

from __future__ import annotations

import ctypes
import ctypes.util
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

LARGE = 8 << 20  # bytes of a group from which it is worth tidying up after


@functools.lru_cache(maxsize=1)
def _trim() -> Callable[[int], int] | None:
    """The C library's malloc_trim, where it has one."""
    try:
        return ctypes.CDLL(ctypes.util.find_library("c") or "libc.so.6").malloc_trim
    except (OSError, AttributeError):
        return None


def give_back() -> None:
    """Free pages of this process go back to the system: Arrow's pool and the C library keep them otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def tidy(run: Callable[..., Iterator], at_end: Callable[[], None] | None = None) -> Callable[..., Iterator]:
    """`run`, a generator over the batches of a task, followed by `at_end` and `give_back` however it ends."""

    def tidied(*args: object) -> Iterator:
        try:
            yield from run(*args)
        finally:
            if at_end:
                at_end()
            give_back()

    return tidied


def tidy_group(run: Callable, size: Callable[..., int]) -> Callable:
    """`run`, a function of one group's rows, followed by `give_back` where the group was large."""

    def tidied(rows):
        large = size(rows) > LARGE
        out = run(rows)
        if large:
            give_back()
        return out

    return tidied


def settle(spark: SparkSession) -> None:
    """Every executor collects its garbage once, which also gives heap that an earlier stage grew into back to the system.

    One small task an executor; it is worth its fraction of a second between stages of different needs, not within one.
    """
    executors = max(1, len(spark.sparkContext._jsc.sc().statusTracker().getExecutorInfos()) - 1)
    spark.range(0, executors, 1, executors).selectExpr("java_method('java.lang.System', 'gc') AS done").write.format("noop").mode("overwrite").save()
