"""Hands memory back when a Python task ends: workers are kept for later tasks, and idle ones would hold on to it."""

from __future__ import annotations

import ctypes
import gc
from functools import wraps

import pyarrow as pa


def give_back() -> None:
    """Returns freed memory of Python, Arrow and, where it is glibc, of the C library to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def lean(task):
    """``task``, a function from batches to batches, that gives memory back once its input has ended."""

    @wraps(task)
    def run(batches):
        try:
            yield from task(batches)
        finally:
            give_back()

    return run
