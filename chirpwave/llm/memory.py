"""Memory that a Python worker keeps between its tasks.

Spark reuses Python workers, and a worker's allocator keeps what a large step
has freed: executors that run stage after stage then hold the largest step of
all stages in every worker.  ``releasing`` gives it back after each step of a
grouped map, ``releasing_map`` around a map over batches.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import pyarrow as pa

MMAP_THRESHOLD = -3  # glibc's M_MMAP_THRESHOLD
LARGE = 1 << 20


def release() -> None:
    """Return freed memory to the system, now and, for large arrays, as they are freed."""
    pa.default_memory_pool().release_unused()
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.mallopt(MMAP_THRESHOLD, LARGE)
        libc.malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library keeps its own rules


def releasing(step: Callable) -> Callable:
    """``step`` of a grouped map, with its memory released when it returns
    (the number of arguments tells Spark whether it takes the key)."""
    if step.__code__.co_argcount == 1:
        def run(table):
            try:
                return step(table)
            finally:
                release()
    elif step.__code__.co_argcount == 2:
        def run(key, table):
            try:
                return step(key, table)
            finally:
                release()
    else:
        def run(key, left, right):
            try:
                return step(key, left, right)
            finally:
                release()
    return run


def releasing_map(step: Callable) -> Callable:
    """``step`` of a ``mapInArrow``, with memory released before it starts
    (what the worker kept of an earlier stage) and when it ends."""
    def run(batches):
        release()
        try:
            yield from step(batches)
        finally:
            release()
    return run
