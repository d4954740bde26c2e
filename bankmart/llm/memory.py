"""Tasks that give their memory back.

Spark's Python workers live on from task to task and stage to stage, and what an allocator keeps
for later is the next stage's loss: of a task's texts and tables Arrow's pool and the C library
hold 50 to 100 MB in a worker that has nothing to do any more.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa


def release() -> None:
    """Return free memory to the system, as far as the allocators can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # Another C library keeps it.


def tidy(step: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """A step over record batches that returns its memory when its task ends, also if it fails."""

    @wraps(step)
    def run(*args, **options) -> Iterator[pa.RecordBatch]:
        try:
            yield from step(*args, **options)
        finally:
            release()

    return run
