"""Memory of Python workers, which go on from task to task."""

from __future__ import annotations

import contextlib
import ctypes

import pyarrow as pa


def release() -> None:
    """Give back what freed arrays of this and of earlier tasks still hold of the machine's memory."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)
