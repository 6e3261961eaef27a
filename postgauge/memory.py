"""Memory of the Python workers."""

from __future__ import annotations

import ctypes

import pyarrow as pa


def give_back() -> None:
    """Return memory that was freed in this Python worker to the system.

    A worker waits for further tasks, of other operators too, and the allocators keep what it
    freed beside the memory of the executor.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
