"""What a Python worker remembers between tasks: for one operator at a time.

Spark keeps workers between stages. An operator that begins in a worker releases what the
others had remembered there, so a chain of operators needs no more memory than the largest.
Steps of one operator have names of their own where they hold much: what one has freed goes back
to the system before the next begins.
"""

from __future__ import annotations

import ctypes
import ctypes.util
from collections.abc import Callable

import pyarrow as pa

_OWNER: list[str] = [""]
_RELEASE: dict[str, Callable[[], None]] = {}


def register(name: str, release: Callable[[], None]) -> None:
    _RELEASE[name] = release


def claim(name: str) -> None:
    """``name`` goes on in this worker, all others are released."""
    if _OWNER[0] != name:
        for other, release in _RELEASE.items():
            if other != name:
                release()
        _OWNER[0] = name
        _give_back()


def _give_back() -> None:
    """Return freed memory to the system, where the allocators can."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.util.find_library("c")
    trim = getattr(ctypes.CDLL(libc), "malloc_trim", None) if libc else None
    if trim is not None:
        trim(0)
