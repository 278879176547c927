"""What a worker process remembers between tasks: one operator's memory at a time."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa

_clear: dict[str, Callable[[], None]] = {}


def remember(owner: str, clear: Callable[[], None]) -> None:
    """Name what empties an operator's memory."""
    _clear[owner] = clear


def only(owner: str) -> None:
    """A task of ``owner`` begins in this process: the others' memories go, back to the system."""
    for other, clear in _clear.items():
        if other != owner:
            clear()
    give_back()


def give_back() -> None:
    """What this process has freed goes back to the system: C's allocator, which numpy uses, would keep it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
    if trim is not None:
        trim(0)
